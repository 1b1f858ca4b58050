import json

import pytest
from pyspark.sql import functions as F

from opsmill.operators import clean, features
from opsmill.sources import tables

AS_OF = "2025-03-31 00:00:00"


def test_corpus_is_one_row_per_file(spark, tmp_path):
    (tmp_path / "a.md").write_text("# A\nline one\n\nline two")
    (tmp_path / "b.md").write_text("b")
    got = {r.source: r.text for r in tables.load_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.md": "# A\nline one\n\nline two", "b.md": "b"}


def test_cases_keep_ragged_data_as_json(spark, tmp_path):
    cases = [{"id": "x", "category": "c", "difficulty": "easy", "query": "q", "expected_sources": ["a", "b"],
              "expected_data": {"n": 1, "l": [1, 2]}, "expected_decision": "d", "reasoning": "r"},
             {"id": "y", "expected_data": {"other": "z"}}]
    (tmp_path / "cases.json").write_text(json.dumps(cases, indent=1))
    rows = {r.id: r for r in tables.load_cases(spark, str(tmp_path / "cases.json")).collect()}
    assert rows["x"].expected_sources == ["a", "b"] and json.loads(rows["x"].expected_data) == {"n": 1, "l": [1, 2]}
    assert json.loads(rows["y"].expected_data) == {"other": "z"} and rows["y"].query is None


def test_raw_to_clean_round_trip(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, " Serum ", "serum", 48.0, 14.0, 63, 100)], tables.PRODUCT_SCHEMA).write.parquet(f"{root}/products")
    spark.createDataFrame([(1, "C1", " A@B.C", "Austin", "Texas", None, "2024-01-01")], tables.CUSTOMER_SCHEMA).write.parquet(f"{root}/customers")
    row = (1, 1, "a@b.c", "01/05/2025", 1, 2, 48.0, 1, 0, None, 0, None)
    spark.createDataFrame([row, row], tables.ORDER_SCHEMA).write.parquet(f"{root}/orders")
    p, c, o = tables.load_raw(spark, root)
    p, c, o = features.engineer(clean.clean_products(p), clean.clean_customers(c, AS_OF), clean.clean_orders(o, AS_OF), AS_OF)
    for _ in range(2):  # the second run replaces the first
        tables.save_clean(p, c, o, f"{root}/clean")
    product = tables.read_published(spark, f"{root}/clean/products").first()
    assert (product.name, product.category, product.units_sold, product.needs_restock) == ("Serum", "Serum", 2, True)
    customer = tables.read_published(spark, f"{root}/clean/customers").first()
    assert (customer.state, customer.acquisition_channel, customer.total_orders) == ("TX", "unknown", 1)
    orders = tables.read_published(spark, f"{root}/clean/orders").collect()
    assert [(o.order_month, o.order_status, round(o.order_value, 2)) for o in orders] == [("2025-01", "delivered", 86.4)]


def test_failed_writes_leave_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, path)
    assert tables.read_published(spark, path, "a INT").count() == 0
    tables.replace_table(spark.range(5), path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, path)
    assert tables.read_published(spark, path).count() == 5
    # A job may read what it replaces, and an older reader still has its files.
    old = tables.read_published(spark, path)
    tables.replace_table(old.where("id > 2"), path)
    assert old.count() == 5 and sorted(r.id for r in tables.read_published(spark, path).collect()) == [3, 4]
    tables.publish(spark.range(2), path, keep=True)
    assert sorted(r.id for r in tables.read_published(spark, path).collect()) == [0, 1, 3, 4] and len(tables.published_folders(spark, path)) == 2
    tables.replace_table(spark.range(0).withColumn("p", F.lit("x")), path, "p")
    assert tables.read_published(spark, path).columns == ["id", "p"] and tables.read_published(spark, path).count() == 0


def test_rows_that_do_not_fit_are_reported(spark, tmp_path):
    (tmp_path / "rows.json").write_text('{"a": 1, "b": "x"}\n{"a": "one", "b": "y"}\nnot json\n{"b": "z"}\n{"a": 3.5}\n')
    rows = tables.load_rows(spark, str(tmp_path), "a INT, b STRING")
    got = [(r.a, r.b, r.corrupt) for r in rows.collect()]
    assert got[0] == (1, "x", None) and got[3] == (None, "z", None)
    assert [g[2] is not None for g in got] == [False, True, True, False, True]
    report = tables.corrupt_report(rows, "t").first()
    assert (report.rows_read, report.corrupt_rows, report.example) == (5, 3, "not json")


def test_corpus_in_folders_and_large_files(spark, tmp_path):
    (tmp_path / "lang=en").mkdir()
    (tmp_path / "lang=en" / "a.txt").write_text("x\n" * 200_000)
    (tmp_path / "b.txt").write_text("")
    got = {r.source: r for r in tables.load_corpus(spark, str(tmp_path)).collect()}
    assert len(got["a.txt"].text) == 400_000 and "lang=en" in got["a.txt"].path
    assert set(got) <= {"a.txt", "b.txt"}
