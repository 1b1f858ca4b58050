from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import elapsed_days, parse_date, season
from opsmill.operators import clean, features
from opsmill.sources import tables

AS_OF = "2025-03-31 12:00:00"
ORDER = ("order_id INT, customer_id INT, customer_email STRING, order_date STRING, product_id INT, quantity INT, "
         "price DOUBLE, discount_applied INT, is_subscription INT, order_status STRING, returned INT, return_reason STRING")


def line(order_id=1, customer_id=1, date="2025-01-01", product=1, quantity=1, price=10.0, discount=0, sub=0,
         status="delivered", returned=0):
    return (order_id, customer_id, "a@b.c", date, product, quantity, price, discount, sub, status, returned, None)


def test_dates_first_fitting_format_wins(spark):
    texts = ["2025-01-05", "2025-1-5", "1/5/2025", "01/05/2025", "2025-01-05T10:11:12", "2025-02-30", "", "unknown",
             " 2025-01-05", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = [r.d for r in df.select("i", parse_date(F.col("t")).alias("d")).orderBy("i").collect()]
    day = datetime(2025, 1, 5)
    assert got == [day, day, day, day, datetime(2025, 1, 5, 10, 11, 12), None, None, None, None, None]


def test_age_rules_leave_the_youngest_null(spark):
    ages = [31, 30, 8, 7, 1, 0, -1]
    rows = [(a, None) for a in ages] + [(31, "cancelled")]
    df = spark.createDataFrame(rows, "age INT, order_status STRING")
    df = df.withColumn("order_date", F.expr(f"timestamp'{AS_OF}' - make_interval(0, 0, 0, age)"))
    got = [r.order_status for r in clean.impute_status(df, AS_OF).collect()]
    assert got == ["delivered", "shipped", "shipped", "processing", "processing", None, None, "cancelled"]


def test_elapsed_days_round_down_before_the_clock(spark):
    df = spark.createDataFrame([("2025-03-31 13:00:00",), ("2025-03-30 12:00:00",)], "t STRING")
    got = [r[0] for r in df.select(elapsed_days(AS_OF, F.col("t").cast("timestamp"))).collect()]
    assert got == [-1, 1]


def test_email_dedupe_runs_after_normalising_and_keeps_one_null(spark):
    rows = [(2, " A@B.C "), (1, "a@b.c"), (3, None), (4, None), (5, "x@y.z\t")]
    df = spark.createDataFrame(rows, "customer_id INT, email STRING")
    df = clean.lower_case(clean.strip_columns(df, "email"), "email")
    assert sorted(r.customer_id for r in clean.dedupe_by_key(df, ["email"], ["customer_id"]).collect()) == [1, 3, 5]
    assert sorted(r.customer_id for r in clean.dedupe_by_key(df, ["email"], ["customer_id"], "last").collect()) == [2, 4, 5]
    with pytest.raises(ValueError):
        clean.dedupe_by_key(df, ["email"], ["customer_id"], "any")


def test_margin_of_a_free_product_is_null(spark):
    df = spark.createDataFrame([(24.0, 8.5), (0.0, 1.0)], "price DOUBLE, cost DOUBLE")
    assert [r[0] for r in df.select(clean.margin_pct(F.col("price"), F.col("cost"))).collect()] == [64.58, None]


def test_states_match_in_any_case_unless_exact(spark):
    df = spark.createDataFrame([("New York",), ("NY",), (" texas ",), (None,)], "state STRING")
    got = [r.state for r in clean.map_values(df, "state", config.STATE_ABBREVIATIONS).collect()]
    assert got == ["NY", "NY", "TX", None]
    got = [r.state for r in clean.map_values(df, "state", config.STATE_ABBREVIATIONS, exact=True).collect()]
    assert got == ["New York", "NY", " texas ", None]


def test_same_day_in_two_formats_is_no_copy(spark):
    df = spark.createDataFrame([line(date="2025-01-05"), line(date="01/05/2025"), line(date="2025-01-05")], ORDER)
    assert clean.clean_orders(df, AS_OF).count() == 2


def test_cleaning_twice_changes_nothing(spark):
    raw = spark.createDataFrame([line(), line(), line(2, None, "3/4/2025", status=None), line(3, 5, "bad")], ORDER)
    once = clean.clean_orders(raw, AS_OF)
    again = once.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss"))
    assert sorted(map(str, clean.clean_orders(again, AS_OF).collect())) == sorted(map(str, once.collect()))


def test_features_of_a_small_shop(spark):
    raw = spark.createDataFrame([
        line(1, 1, price=10.0, quantity=2, discount=1), line(1, 1, product=2, price=5.0),
        line(2, 1, "2025-03-01", quantity=-1, price=10.0), line(3, None)], ORDER)
    lines = features.order_features(clean.clean_orders(raw, AS_OF))
    history = features.customer_history(lines, AS_OF).collect()
    assert [(r.customer_id, r.total_orders, r.total_revenue, r.is_repeat_customer, r.days_since_last_order)
            for r in history] == [(1, 2, 25.0, True, 30)]
    sales = {r.product_id: r for r in features.product_sales(lines).collect()}
    assert (sales[1].num_orders, sales[1].units_sold, sales[1].total_revenue) == (2, 3, 28.0)


def test_season_of_every_month(spark):
    df = spark.range(1, 13).select("id", season(F.col("id").cast("int")).alias("s")).orderBy("id")
    assert [r.s for r in df.collect()] == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]


def report_tables(spark, save):
    rows = [(1, 1, "a@b.c", "01/05/2025", 1, 2, 48.0, 1, 0, None, 0, None)] * 3 + [
        (2, None, None, "2025-01-06", 1, 1, 9.0, 0, 0, "shipped", 0, None), (3, 2, "x@y.z", "soon", 1, 1, 9.0, 0, 0, None, 0, None),
        (4, 2, "x@y.z", "2099-01-01", 1, 1, 9.0, 0, 0, None, 0, None)]
    orders = spark.createDataFrame(rows, tables.ORDER_SCHEMA)
    customers = spark.createDataFrame([(1, "C1", " A@B.C", "c", "TX", None, "2024-01-01"), (2, "C2", "a@b.c ", "c", "TX", None, "2024-01-01")], tables.CUSTOMER_SCHEMA)
    goods = spark.createDataFrame([(1, " Serum ", "serum", 48.0, 14.0, 63, 100)], tables.PRODUCT_SCHEMA)
    return {(r.table_name, r.figure): r.n for r in clean.cleaning_report(orders, customers, goods, AS_OF, save).collect()}


def test_report_counts_the_job_that_ran(spark, monkeypatch):
    written = {}

    def save(products, customers, lines):
        for name, df in (("products", products), ("customers", customers), ("orders", lines)):
            written[name] = len(df.collect())

    got = report_tables(spark, save)
    assert got == {("orders", "rows_in"): 6, ("orders", "duplicates_removed"): 2, ("orders", "unparsed_dates_removed"): 1, ("orders", "rows_out"): 3,
                   ("orders", "guests_marked"): 1, ("orders", "statuses_imputed"): 1, ("customers", "rows_in"): 2, ("customers", "duplicates_removed"): 1,
                   ("customers", "rows_out"): 1, ("products", "rows_in"): 1, ("products", "rows_out"): 1}
    assert written == {"products": 1, "customers": 1, "orders": 3}
    # A changed stage changes the figures, as they are not computed apart from it.
    monkeypatch.setattr(clean, "drop_unparsed_dates", lambda df, name: df.filter(F.col(name) < "2030-01-01"))
    changed = report_tables(spark, save)
    assert (changed["orders", "unparsed_dates_removed"], changed["orders", "rows_out"], written["orders"]) == (2, 2, 2)
