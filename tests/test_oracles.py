"""Queries next to DuckDB on the smallest tables. OPSMILL_ALL=1 runs them all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from opsmill.plans import catalogue, check, fixtures

ROOT = "/root/testdata/sf0.001"
SAMPLE = ("cln_clean_orders", "cln_13_orphan_keys", "fea_5_customer_features", "fea_11_restock_flag", "sum_5_cleaning_report",
          "qry_7_last_order", "qry_12_restock_plan", "pol_3_return_window", "pol_6_return_abuse", "pol_19_damage_cost",
          "pol_24_promised_range", "pol_27_carrier_scorecard", "pol_33_decision_trace", "cat_2_customer_conflicts",
          "cat_5_routine_gaps", "doc_4_recursive_chunks", "doc_5_semantic_percentile", "ret_3_hybrid_search", "evl_12_precision_recall")

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in fixtures.BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.ORACLES) if os.environ.get("OPSMILL_ALL") else SAMPLE)
def test_query_equals_oracle(spark, con, name):
    text, ok = check.compare(spark, con, name, ROOT)
    assert ok, text


def test_entry_contract(spark):
    assert entry.entry(spark).count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())
