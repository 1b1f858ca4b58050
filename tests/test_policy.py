import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from opsmill.functions.columns import elapsed_business_hours
from opsmill.operators import damage, products, returns, shipping
from opsmill.operators.trailing import earlier_counts, trailing_counts


def windows(spark, rows):
    df = spark.createDataFrame(rows, "ordered_at DATE, delivered_on DATE, requested_on DATE, is_vip BOOLEAN")
    return [(r.window_rule, r.days_left, r.eligible) for r in returns.return_window(df).collect()]


def test_return_window_edges(spark):
    d = date(2025, 6, 1)
    rows = [(d, d, d + timedelta(n), vip) for n, vip in ((30, False), (31, False), (45, True), (46, True))]
    assert windows(spark, rows) == [("standard", 0, True), ("standard", -1, False), ("vip", 0, True), ("vip", -1, False)]


def test_holiday_window_wraps_over_new_year(spark):
    days = [date(2024, 11, 14), date(2024, 11, 15), date(2025, 1, 15), date(2025, 1, 16)]
    rows = [(d, d, d + timedelta(45), False) for d in days]
    assert [w for w, _, _ in windows(spark, rows)] == ["standard", "holiday", "holiday", "standard"]


def test_refund_tiers(spark):
    df = spark.createDataFrame([(49.99,), (50.0,), (200.0,), (200.01,)], "a DOUBLE")
    got = df.select(returns.approval_tier(F.col("a")).alias("t"), returns.response_hours(F.col("a")).alias("h")).collect()
    assert [(r.t, r.h) for r in got] == [("auto", None), ("manager", 4), ("manager", 4), ("director", 24)]


def test_six_months_count_by_calendar(spark):
    rows = [(1, d) for d in (date(2025, 1, 31), date(2025, 3, 1), date(2025, 5, 1), date(2025, 7, 31))]
    rows += [(2, d) for d in (date(2025, 1, 30), date(2025, 3, 1), date(2025, 5, 1), date(2025, 7, 31))]
    df = spark.createDataFrame(rows, "k INT, d DATE")
    got = {(r.k, r.day): r.n6 for r in trailing_counts(df, "k", "d", 6, "n6").collect()}
    assert got[1, date(2025, 7, 31)] == 4 and got[2, date(2025, 7, 31)] == 3
    before = {(r.k, r.day): r.b for r in earlier_counts(df, "k", "d", "b").collect()}
    assert before[1, date(2025, 1, 31)] == 0 and before[1, date(2025, 7, 31)] == 3


def test_busy_customer_shrinks_to_days(spark):
    df = spark.range(20_000).select(F.lit(7).alias("k"), F.expr("date_add(date'2025-01-01', int(id % 3))").alias("d"))
    rows = trailing_counts(df, "k", "d", 6, "n").orderBy("day").collect()
    assert [r.n for r in rows] == [6667, 13334, 20000]


PURCHASES = "order_id LONG, customer_id LONG, product_id LONG, units INT, ordered_at DATE"
RETURNED = "order_id LONG, line_no INT, customer_id LONG, product_id LONG, units INT, requested_on DATE"
PARTS = "set_id LONG, product_id LONG, sold_separately BOOLEAN"


def plain_allocation(returned, purchases, components):
    """Unit by unit: each returned unit takes the oldest unit left that was bought by then."""
    stock = {}
    for order, customer, product, units, day in purchases:
        if None in (customer, product, day) or units <= 0:
            continue
        stock.setdefault((customer, product), []).append((day, 0, order, None, units))
        for s, part, _ in components:
            if s == product:
                stock.setdefault((customer, part), []).append((day, 1, order, s, units))
    out = {}
    for key, rows in stock.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2], r[3] is not None, r[3] or 0))
        stock[key] = [list(r) for r in rows]
    for order, line, customer, product, units, day in sorted(returned, key=lambda r: (str(r[5]), r[0], r[1])):
        if None in (customer, product, day):
            continue
        for _ in range(units):
            left = next((r for r in stock.get((customer, product), []) if r[4] and r[0] <= day), None)
            if left:
                left[4] -= 1
            k = (customer, product, order, line, left and left[2], left and left[3])
            out[k] = out.get(k, 0) + 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_returned_units_are_allocated_like_the_plain_version(spark, seed):
    rng = random.Random(seed)
    start = date(2025, 1, 1)
    components = [(10, 11, True), (10, 12, True), (10, 13, False), (20, 12, True), (20, 14, True), (20, 15, True)]
    products = [10, 11, 12, 13, 14, 15, 20]
    purchases = [(i, rng.choice([1, 2, None]) if rng.random() < 0.1 else rng.choice([1, 2, 3]), rng.choice(products), rng.randint(0, 4), start + timedelta(rng.randint(0, 40)))
                 for i in range(150)]
    returned = [(i, rng.randint(1, 2), rng.choice([1, 2, 3]), rng.choice(products[1:6]), rng.randint(0, 6), rng.choice([None, start + timedelta(rng.randint(0, 60))]) if rng.random() < 0.1
                 else start + timedelta(rng.randint(0, 60))) for i in range(200)]
    made = returns.allocate_returns(spark.createDataFrame(returned, RETURNED), spark.createDataFrame(purchases, PURCHASES), spark.createDataFrame(components, PARTS))
    rows = made.collect()
    got = {(r.customer_id, r.product_id, r.order_id, r.line_no, r.source_order, r.source_set): r.units for r in rows}
    assert len(got) == len(rows) and got == plain_allocation(returned, purchases, components)
    assert any(k[4] is None for k in got) and any(k[5] for k in got)


def test_bundles_know_the_set_bought(spark):
    d = date(2025, 3, 1)
    purchases = [(1, 1, 10, 2, d), (2, 1, 11, 1, d - timedelta(5)), (3, 2, 11, 1, d), (4, 3, 10, 1, d)]
    returned = [(9, 1, 1, 11, 3, d + timedelta(9)), (9, 2, 1, 12, 1, d + timedelta(9)), (9, 3, 1, 13, 2, d + timedelta(9)),
                (9, 4, 2, 11, 1, d + timedelta(9)), (9, 5, 3, 11, 1, d - timedelta(1)), (9, 6, 3, 12, 1, d)]
    parts = [(10, 11, True), (10, 12, True), (10, 13, False)]
    prices = spark.createDataFrame([(10, 80.0), (11, 50.0), (12, 60.0), (13, 7.0)], "product_id LONG, price DOUBLE")
    got = {r.customer_id: r for r in returns.bundle_returns(
        spark.createDataFrame(returned, RETURNED), spark.createDataFrame(purchases, PURCHASES), spark.createDataFrame(parts, PARTS), prices).collect()}
    # Customer 2 bought the part alone; customer 3 asked for one part before it was bought.
    assert set(got) == {1, 3}
    r = got[1]
    # Of three units one was bought alone; one whole set, one more part, and one that is not sold separately.
    assert (r.sets_bought, r.full_sets, r.returned_units, r.single_units, r.refused_units, r.refund_value) == (2, 1, 5, 1, 1, 130.0)
    assert (got[3].full_sets, got[3].n_returned, got[3].refund_value) == (0, 1, 60.0)


FACTS = "product_id LONG, ingredients ARRAY<STRUCT<ingredient: INT, concentration: DOUBLE>>"


def test_ingredients_of_any_number(spark):
    many = [(i, float(i)) for i in range(7)]
    facts = spark.createDataFrame([(1, None), (2, []), (3, [(4, 0.5)]), (4, many), (5, [(4, 9.0), (4, 2.0), (50, None)])], FACTS)
    lines = spark.createDataFrame([(3, 2, True), (3, -1, False), (4, 5, False)], "product_id LONG, quantity INT, returned BOOLEAN")
    got = {(r.ingredient, r.product_id): (r.concentration, r.strength_rank, r.units_sold, r.return_rate) for r in products.ingredient_products(facts, lines).collect()}
    assert len(got) == 1 + 7 + 2
    assert [got[4, p] for p in (5, 4, 3)] == [(9.0, 1, 0, None), (4.0, 2, 5, 0.0), (0.5, 3, 2, 0.5)]
    total = {r.ingredient: r for r in products.ingredient_report(facts, lines).collect()}
    assert (total[4].n_products, total[4].units_sold, total[4].min_concentration, total[4].max_concentration) == (3, 7, 0.5, 9.0)
    assert abs(total[4].return_rate - 1 / 3) < 1e-9 and total[50].max_concentration is None


def test_several_required_attributes(spark):
    goods = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "a", 9), (4, "a", 0), (5, "b", 3)], "product_id LONG, category STRING, stock_level INT")
    relation = [(1, "free"), (1, "safe"), (1, "safe"), (2, "free"), (2, "safe"), (3, "safe"), (4, "free"), (4, "safe"), (5, "other"), (9, "free")]
    attributes = spark.createDataFrame(relation, "product_id LONG, attribute STRING")
    lines = spark.createDataFrame([(7, p) for p in (1, 3, 4, 5)], "order_id LONG, product_id LONG")
    got = {r.product_id: (r.missing, r.n_substitutes, r.best_substitute) for r in products.lacking_lines(lines, goods, attributes, ["free", "safe"]).collect()}
    assert got == {3: (["free"], 2, 2), 5: (["free", "safe"], 0, None)}
    assert {r.product_id: r.has_all for r in products.attribute_products(goods, attributes, [f"x{i}" for i in range(62)] + ["safe"]).collect()} == dict.fromkeys(range(1, 6), False)


def test_adverse_reaction_overrides_window_and_approval(spark):
    d = date(2025, 6, 1)
    rows = [(1, 1, 1, 1, 500.0, d, d, d + timedelta(90), "adverse_reaction", False),
            (2, 1, 1, 1, 500.0, d, d, d + timedelta(90), "unopened", False)]
    df = spark.createDataFrame(rows, "order_id INT, line_no INT, product_id INT, customer_id INT, amount DOUBLE, "
                               "ordered_at DATE, delivered_on DATE, requested_on DATE, item_condition STRING, is_vip BOOLEAN")
    products = spark.createDataFrame([(1, False)], "product_id INT, discontinued BOOLEAN")
    got = {r.order_id: r for r in returns.decide(returns.return_window(df), products).collect()}
    assert (got[1].decision, got[1].approval) == ("approve", "auto") and "adverse_override" in got[1].rules
    # A denied request carries neither approval nor refund form.
    assert (got[2].decision, got[2].approval, got[2].refund_form) == ("deny", None, None)


def test_decisions_do_not_contradict_themselves(spark):
    d = date(2025, 6, 1)
    rows = [(1, 2, 20.0, 5, "damaged", False), (2, 1, 20.0, 5, "damaged", False), (3, 1, 20.0, 5, "opened", True), (4, 1, 20.0, 40, "unopened", True),
            (5, 99, 20.0, 5, "unopened", False), (6, 1, 300.0, 5, "opened", True), (7, 1, 20.0, 31, "opened", False)]
    rows = [(i, 1, p, 1, a, d, d, d + timedelta(n), c, v) for i, p, a, n, c, v in rows]
    df = spark.createDataFrame(rows, "order_id INT, line_no INT, product_id INT, customer_id INT, amount DOUBLE, "
                               "ordered_at DATE, delivered_on DATE, requested_on DATE, item_condition STRING, is_vip BOOLEAN")
    products = spark.createDataFrame([(1, False), (2, True)], "product_id INT, discontinued BOOLEAN")
    got = {r.order_id: (r.decision, r.refund_form, r.approval, r.rules) for r in returns.decide(returns.return_window(df), products).collect()}
    assert got == {
        1: ("approve", "refund_only", "auto", ["inside_window", "discontinued_refund_only"]),
        2: ("approve", "refund_or_replacement_plus_10pct", "auto", ["inside_window", "damage_sop"]),
        3: ("approve", "full_refund_manager_discretion", "manager", ["inside_window", "vip_window", "vip_opened_refund", "manager_discretion", "manager_approval"]),
        4: ("approve", "full_refund", "manager", ["inside_window", "vip_window", "manager_discretion", "manager_approval"]),
        5: ("approve", "full_refund", "auto", ["inside_window", "unknown_product"]),
        6: ("approve", "full_refund_manager_discretion", "director", ["inside_window", "vip_window", "vip_opened_refund", "manager_discretion", "director_approval"]),
        7: ("deny", None, None, ["outside_window"])}


def test_business_hours_skip_the_weekend(spark):
    times = [("2025-06-06 12:00:00", "2025-06-09 12:00:00", 24), ("2025-06-07 10:00:00", "2025-06-08 10:00:00", 0), ("2025-06-02 00:00:00", "2025-06-16 01:30:00", 241),
             ("2025-06-09 00:00:00", "2025-06-06 00:00:00", 0), ("1969-12-30 00:00:00", "1970-01-02 00:00:00", 72)]
    df = spark.createDataFrame(times, "a STRING, b STRING, n INT")
    assert [(r.h, r.n) for r in df.select(elapsed_business_hours(F.to_timestamp("b"), F.to_timestamp("a")).alias("h"), "n").collect()] == [(n, n) for *_, n in times]


def test_unknown_keys_keep_their_rows(spark):
    d = date(2025, 6, 2)
    ships = spark.createDataFrame([(1, "US", "standard", 10.0, d), (2, "MARS", "standard", 10.0, d)], "order_id INT, zone STRING, method STRING, order_value DOUBLE, ordered_at DATE")
    assert {r.order_id: (r.charge, r.unknown_rate) for r in shipping.quote(ships).collect()} == {1: (5.95, False), 2: (None, True)}
    assert {r.order_id: r.promised_from for r in shipping.promised_range(ships).collect()}[2] is None
    lines = spark.createDataFrame([(1, -1, 1, 5.0), (1, -1, 9, 5.0), (2, 7, 1, 5.0)], "order_id INT, customer_id INT, product_id INT, price DOUBLE")
    stock = spark.createDataFrame([(1, 50)], "product_id INT, stock INT")
    vips = spark.createDataFrame([(7, True)], "customer_id INT, is_vip BOOLEAN")
    assert {r.order_id: r.action for r in shipping.stock_check(lines, stock, vips).collect()} == {1: "check_product", 2: "ship"}


def test_photos_are_waived_for_orders_up_to_the_claim_only(spark):
    day = [date(2025, 1, 1) + timedelta(30 * i) for i in range(6)]
    orders = spark.createDataFrame([(1, i, d) for i, d in enumerate(day)] + [(1, 0, day[0])], "customer_id INT, order_id INT, ordered_at DATE")
    claims = spark.createDataFrame([(1, 1, day[3], 20.0)], "claim_id INT, customer_id INT, claimed_on DATE, order_value DOUBLE")
    later = spark.createDataFrame([(2, 1, day[4], 20.0)], "claim_id INT, customer_id INT, claimed_on DATE, order_value DOUBLE")
    assert [damage.photo_requirement(c, orders).first().photos for c in (claims, later)] == ["required", "waived"]


def test_carriers_are_watched_together_and_alone(spark):
    d = date(2025, 6, 3)
    claims = spark.createDataFrame([(d, "A")] * 2 + [(d, "B")] * 4, "claimed_on DATE, carrier STRING")
    ships = spark.createDataFrame([(d, "A", d, d, "US")] * 400, "shipped_on DATE, carrier STRING, expected_on DATE, delivered_on DATE, zone STRING")
    got = {r.carrier: (r.damages, r.month_damages, r.triggers) for r in damage.carrier_monitor(claims, ships).collect()}
    assert got == {"A": (2, 6, ["five_any_carrier"]), "B": (4, 6, ["three_same_carrier", "five_any_carrier"])}
    card = {r.carrier: (r.shipments, r.damages, r.failing, r.switch_carrier) for r in shipping.carrier_scorecard(ships, claims, "2025-08-01").collect()}
    assert card == {"A": (400, 2, True, False), "B": (0, 4, False, True)}


def test_compensation_levels(spark):
    rows = [("A", False, 50.0), ("B", False, 50.0), ("C", False, 50.0), ("C", True, 50.0), ("B", False, 150.0)]
    df = spark.createDataFrame(rows, "final_grade STRING, multiple BOOLEAN, order_value DOUBLE")
    got = [(r.discount_pct, r.store_credit, r.approval) for r in damage.compensation(df).collect()]
    assert got == [(0, 10.0, "auto"), (10, 0.0, "auto"), (15, 0.0, "manager"), (20, 0.0, "manager"), (15, 0.0, "manager")]


def test_stock_bands(spark):
    df = spark.createDataFrame([(11, False), (10, False), (1, False), (0, False), (50, True)], "s INT, d BOOLEAN")
    got = [r[0] for r in df.select(damage.availability(F.col("s"), F.col("d"))).collect()]
    assert got == ["replacement_or_refund", "replacement_or_refund_restock", "replacement_or_refund_restock",
                   "refund_or_wait", "refund_only_plus_credit"]


def test_business_days_against_counting(spark):
    start = date(2024, 2, 1)
    rows = [(start + timedelta(i), n) for i in range(14) for n in range(0, 13)]
    df = spark.createDataFrame(rows, "d DATE, n INT")

    def count_on(d, n):
        while d.weekday() > 4:
            d -= timedelta(1)
        while n:
            d += timedelta(1)
            n -= d.weekday() < 5
        return d

    for r in df.withColumn("x", shipping.add_business_days(F.col("d"), F.col("n"))).collect():
        assert r.x == count_on(r.d, r.n), r


def test_failing_months_break_over_a_gap(spark):
    rows = [(i, "A", date(2025, m, 5)) for i, m in enumerate((1, 2, 4, 5, 6))]
    ships = spark.createDataFrame(rows, "order_id INT, carrier STRING, shipped_on DATE")
    ships = ships.withColumns({"zone": F.lit("US"), "expected_on": F.date_add("shipped_on", 5),
                               "delivered_on": F.when(F.month("shipped_on") != 5, F.date_add("shipped_on", 5))})
    claims = spark.createDataFrame([("A", date(2025, m, 9)) for m in (1, 2, 4)], "carrier STRING, claimed_on DATE")
    got = shipping.carrier_scorecard(ships, claims, "2025-12-01 00:00:00").orderBy("month").collect()
    assert [r.failing_months for r in got] == [1, 2, 1, 2, 0]


def test_evidence_is_looked_up_once_per_text(spark):
    d = date(2025, 6, 1)
    rows = [(i, 1, 100 + i % 2, 7 if i else 8, 20.0, d, d, d + timedelta(3), "opened", False) for i in range(6)]
    requests = spark.createDataFrame(rows, "order_id LONG, line_no INT, product_id LONG, customer_id LONG, amount DOUBLE, ordered_at DATE, delivered_on DATE, requested_on DATE, "
                                           "item_condition STRING, is_vip BOOLEAN")
    goods = spark.createDataFrame([(100, "Mask", "Care x", 9.0, 4, False)], "product_id LONG, name STRING, category STRING, price DOUBLE, stock_level INT, discontinued BOOLEAN")
    people = spark.createDataFrame([(7, "TX", 3)], "customer_id LONG, state STRING, total_orders LONG")
    orders = spark.createDataFrame([(i, 30.0, "UPS", d, d) for i in range(1, 6)], "order_id LONG, order_value DOUBLE, carrier STRING, ordered_at DATE, delivered_on DATE")
    asked = []

    def retrieve(texts):
        asked.extend(r.text for r in texts.collect())
        return texts.select("query_id", F.lit(1).alias("rank"), F.lit(5).alias("id"), F.lit(0.5).alias("distance"), F.lit("faq").alias("source"),
                            F.col("text").alias("text_preview"))

    decided = returns.decide(returns.return_window(requests), goods.select("product_id", "discontinued"))
    got = {r.order_id: r for r in returns.evidence_pack(decided, goods, people, orders, retrieve, "id").collect()}
    assert sorted(asked) == ["opened return of care product standard window approve store credit", "opened return of unknown product standard window approve store credit"]
    assert len(got) == 6 and all(len(r.evidence) == 1 and r.evidence[0].text_preview == r.request_text for r in got.values())
    assert got[0].order is None and got[0].customer is None and got[0].product.name == "Mask"
    assert got[1].product is None and got[1].customer.state == "TX" and got[1].order.carrier == "UPS" and got[1].decision == "approve"


def test_order_conflicts_read_the_lines_once(spark, tmp_path, capsys):
    spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3), (2, 1), (3, 2), (None, 1), (None, 2)], "order_id LONG, product_id LONG").write.parquet(str(tmp_path / "lines"))
    facts = spark.createDataFrame([(1, [("a", 1.0), ("x", 1.0)]), (2, [("b", 1.0), (None, 1.0)]), (3, [("b", 2.0), ("a", 1.0)])],
                                  "product_id LONG, ingredients ARRAY<STRUCT<ingredient: STRING, concentration: DOUBLE>>")
    pairs = spark.createDataFrame([("a", "b", "high"), ("b", "a", "low"), ("a", "c", "low")], "first STRING, second STRING, severity STRING")
    df = products.order_conflicts(spark.read.parquet(str(tmp_path / "lines")), facts, pairs)
    assert sorted(map(tuple, df.collect())) == [(1, "a", "b", "high", 2, 2), (1, "b", "a", "low", 2, 2)]
    capsys.readouterr()
    df.explain("simple")
    assert capsys.readouterr().out.split("== Initial Plan ==")[-1].count("FileScan parquet") == 1


def test_order_lines_go_to_tasks_of_bounded_size(spark, monkeypatch):
    """Merged partitions of 64 MB would put all of them into one task."""
    from opsmill.plans import registry
    lines = spark.range(1000).selectExpr("if(id % 50 = 0, null, id div 4) AS l_orderkey", "id AS l_linenumber")
    assert registry.dealt(lines, "l_orderkey") is None
    monkeypatch.setattr(registry, "LINES_PER_TASK", 20)
    parts = registry.dealt(lines, "l_orderkey")
    joined = parts.join(spark.range(250).withColumnRenamed("id", "l_orderkey").hint("merge"), "l_orderkey")
    rows = joined.dropDuplicates().groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 980 and len(rows) > 40 and max(r["count"] for r in rows) < 100


def test_products_are_not_sent_through_the_driver(spark, tmp_path, capsys):
    """Files of a few MB may hold millions of products; their size says little."""
    from types import SimpleNamespace

    from opsmill.plans import text_queries
    spark.createDataFrame([(1, "Mask", "Care x", 9.0, 4, False)], "product_id LONG, name STRING, category STRING, price DOUBLE, stock_level INT, discontinued BOOLEAN").write.parquet(str(tmp_path / "goods"))
    goods = spark.read.parquet(str(tmp_path / "goods"))
    requests = spark.createDataFrame([(7, 1), (8, None), (9, 2)], "order_id LONG, product_id LONG")
    found = returns._with_product(requests, goods, "discontinued")
    assert {r.order_id: (r.discontinued, r.unknown_product) for r in found.collect()} == {7: (False, False), 8: (None, True), 9: (None, True)}
    facts = text_queries.product_facts(SimpleNamespace(products=goods, raw_products=goods))
    assert facts.count() == 1
    for df in (found, facts):
        capsys.readouterr()
        df.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
