"""The registered queries next to their SQL, and the pipeline next to its parts."""

import os

import duckdb
import pytest

import corpus_pipeline
from opsmill.llm import catalogue
from opsmill.plans import check, fixtures

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.mark.parametrize("name", list(catalogue.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in fixtures.BASE_TABLES + tuple(x for x in ("pages", "benchmark", "conversations", "documents") if x not in fixtures.BASE_TABLES):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, ROOT)
    cur = con.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, cur.fetchall())


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in catalogue.QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}


def test_pipeline_keeps_what_each_stage_should(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    verdicts = {r.doc_id: r.kept for r in catalogue.QUERIES["op4_quality_rules"](spark, ROOT).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, ROOT)
        assert made.columns == columns
        docs = spark.createDataFrame(made.collect(), made.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert set(after) == {i for i, kept in verdicts.items() if kept}
        if name == "pii":
            assert set(after) == set(before)
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT).collect()
    assert {r.doc_id for r in final} == set(before) and all(r.lossless for r in final)
    whole = corpus_pipeline.run(spark, ROOT).collect()
    assert {(r.doc_id, tuple(r.pieces)) for r in whole} == {(r.doc_id, tuple(r.pieces)) for r in final}
