"""Shipping rules over whole tables of shipments.

A shipment has order_id, customer_id, order_value, ordered_at, carrier, zone,
method, po_box, missing_unit, shipped_on, expected_on, delivered_on."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import elapsed_business_hours, flags, in_yearly_period, lookup, ratio, timestamp


def rate_table(spark: SparkSession) -> DataFrame:
    """The fixed rate card as an inline relation of known, tiny size."""
    def sql(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)

    rows = ", ".join("(" + ", ".join(sql(v) for v in r) + ")" for r in config.SHIPPING_RATES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(zone, method, rate, free_from, min_days, max_days)")


def is_domestic(zone: Column) -> Column:
    return zone.isin(*config.DOMESTIC_ZONES)


def _rated(shipments: DataFrame) -> DataFrame:
    """Every shipment with its rate; ``unknown_rate`` where the card has none."""
    df = shipments.join(rate_table(shipments.sparkSession), ["zone", "method"], "left")
    return df.withColumn("unknown_rate", F.col("rate").isNull())


def quote(shipments: DataFrame) -> DataFrame:
    """The charge, null where the zone or method is unknown."""
    df = _rated(shipments)
    free = F.coalesce(F.col("order_value") >= F.col("free_from"), F.lit(False))
    return df.withColumn("charge", F.when(free, 0.0).otherwise(F.col("rate")))


def holds(shipments: DataFrame) -> DataFrame:
    express = F.col("method") == "express"
    df = shipments.withColumn("hold_reasons", flags(
        (express & F.col("po_box"), "express_to_po_box"),
        (express & (F.col("zone") == "APO"), "express_to_military"),
        (F.col("missing_unit"), "missing_unit")))
    return df.withColumn("hold", F.size("hold_reasons") > 0)


def add_business_days(day: Column, n: Column) -> Column:
    """Monday-to-Friday arithmetic without a calendar join; a start on a
    weekend counts from the Friday before."""
    wd = F.weekday(day)
    back = F.greatest(wd - 4, F.lit(0))
    wd = F.least(wd, F.lit(4))
    return F.date_add(F.date_sub(day, back), (n + F.floor((wd + n) / 5) * 2).cast("int"))


def promised_range(shipments: DataFrame) -> DataFrame:
    df = _rated(shipments)
    day = F.col("ordered_at").cast("date")
    return df.withColumns({"promised_from": add_business_days(day, F.col("min_days")),
                           "promised_to": add_business_days(day, F.col("max_days"))})


def days_overdue(as_of) -> Column:
    return F.datediff(timestamp(as_of).cast("date"), F.col("expected_on"))


def is_lost(as_of) -> Column:
    limit = F.when(is_domestic(F.col("zone")), config.LOST_AFTER_DAYS["domestic"]).otherwise(config.LOST_AFTER_DAYS["international"])
    return F.col("delivered_on").isNull() & (days_overdue(as_of) > limit)


def lost_packages(shipments: DataFrame, as_of) -> DataFrame:
    return (shipments.filter(is_lost(as_of)).withColumn("days_overdue", days_overdue(as_of))
            .select("order_id", "carrier", "zone", "days_overdue"))


def delay_credits(shipments: DataFrame, as_of) -> DataFrame:
    """Domestic delays count from the order, international ones from the
    expected day; only domestic ones earn credit."""
    end = F.coalesce(F.col("delivered_on"), timestamp(as_of).cast("date"))
    domestic = is_domestic(F.col("zone"))
    days = F.when(domestic, F.datediff(end, F.col("ordered_at").cast("date"))).otherwise(F.datediff(end, F.col("expected_on")))
    df = shipments.withColumn("days_late", days)
    credit, reship = F.lit(0.0), F.lit(False)
    for over, amount, again in config.DELAY_CREDITS:
        hit = domestic & (F.col("days_late") > over)
        credit = F.when(hit, F.lit(amount)).otherwise(credit)
        reship = F.when(hit, F.lit(again)).otherwise(reship)
    limit = F.when(domestic, config.CONTACT_CARRIER_DAYS["domestic"]).otherwise(config.CONTACT_CARRIER_DAYS["international"])
    return df.select("order_id", "zone", "days_late", credit.alias("credit"), reship.alias("consider_reship"),
                     (F.col("days_late") > limit).alias("contact_carrier"))


def carrier_scorecard(shipments: DataFrame, claims: DataFrame, as_of) -> DataFrame:
    """Monthly figures per carrier and runs of failing months. A month fails on
    any target, and when deliveries take longer than promised on average. A
    carrier is switched after failing months in a row or for more damages in a
    month than tolerated. Months with claims but no shipment are kept. The
    window runs over one row per carrier and month."""
    damaged = (claims.groupBy(F.trunc("claimed_on", "month").alias("month"), "carrier")
               .agg(F.count("*").alias("damages")))
    df = (shipments.groupBy(F.trunc("shipped_on", "month").alias("month"), "carrier")
          .agg(F.count("*").alias("shipments"), F.count("delivered_on").alias("delivered"),
               F.avg(F.datediff("delivered_on", "shipped_on")).alias("avg_days"),
               F.avg(F.datediff("expected_on", "shipped_on")).alias("avg_promised_days"),
               F.count_if(is_lost(as_of)).alias("lost"))
          .join(damaged, ["month", "carrier"], "full"))
    df = df.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("shipments", "delivered", "lost", "damages")})
    df = df.withColumns({
        "success_rate": ratio(F.col("delivered"), F.col("shipments")),
        "damage_rate": ratio(F.col("damages"), F.col("shipments")),
        "loss_rate": ratio(F.col("lost"), F.col("shipments")),
    })
    failing = [F.col("success_rate") <= config.SUCCESS_TARGET, F.col("damage_rate") >= config.DAMAGE_RATE_TARGET,
               F.col("loss_rate") >= config.LOSS_TARGET, F.col("avg_days") > F.col("avg_promised_days")]
    df = df.withColumn("failing", reduce(or_, [F.coalesce(c, F.lit(False)) for c in failing]))
    by_month = Window.partitionBy("carrier").orderBy("month")
    gap = F.months_between("month", F.lag("month").over(by_month)) != 1
    df = df.withColumn("_new", F.when(~F.col("failing") | F.coalesce(gap, F.lit(False)), 1).otherwise(0))
    df = df.withColumn("_run", F.sum("_new").over(by_month))
    in_run = Window.partitionBy("carrier", "_run").orderBy("month")
    df = df.withColumn("failing_months", F.when(F.col("failing"), F.sum(F.col("failing").cast("int")).over(in_run)).otherwise(0))
    switch = (F.col("failing_months") >= config.FAILING_MONTHS) | (F.col("damages") > config.DAMAGES_IN_A_MONTH)
    return df.withColumn("switch_carrier", switch).drop("_new", "_run")


def shipping_margin(shipments: DataFrame) -> DataFrame:
    df = quote(shipments.filter(is_domestic(F.col("zone"))))
    cost = lookup(F.col("method"), config.SHIPPING_COST)
    return df.groupBy("method").agg(F.count("*").alias("n_orders"), F.sum("charge").alias("charged"),
                                    F.sum(cost).alias("cost"), F.sum(F.col("charge") - cost).alias("margin"))


def stock_check(lines: DataFrame, stock: DataFrame, vips: DataFrame) -> DataFrame:
    """Ship, hold for quality check, or offer the out-of-stock options. A VIP
    with the dearer items in stock may get a partial shipment. An order with a
    product that has no stock row waits for a look at it. Guests are no VIPs and
    stay out of the join."""
    df = (lines.join(stock.select("product_id", "stock"), "product_id", "left")
          .groupBy("order_id", "customer_id")
          .agg(F.min("stock").alias("min_stock"), F.count_if(F.col("stock").isNull()).alias("unknown"),
               F.max(F.when(F.col("stock") > 0, F.col("price"))).alias("top_in_stock"),
               F.max(F.when(F.col("stock") <= 0, F.col("price"))).alias("top_out_of_stock")))
    known = df.filter("customer_id > 0").join(vips.select("customer_id", "is_vip"), "customer_id", "left")
    df = known.unionByName(df.filter("customer_id <= 0 or customer_id is null"), allowMissingColumns=True)
    vip = F.coalesce("is_vip", F.lit(False))
    partial = vip & (F.col("top_in_stock") > F.col("top_out_of_stock"))
    action = (F.when(F.col("unknown") > 0, "check_product").when(F.col("min_stock") >= config.QA_HOLD_UNITS, "ship").when(F.col("min_stock") > 0, "qa_hold")
              .when(partial, "partial_shipment").otherwise("wait_substitute_or_refund"))
    return df.select("order_id", "min_stock", action.alias("action"), (action == "partial_shipment").alias("manager_approval"))


def processing_sla(shipments: DataFrame, busy_factor: float = 1.5) -> DataFrame:
    """Business hours from order to shipment against the promise of its season. A day
    is busy when its orders exceed ``busy_factor`` times the daily mean."""
    daily = shipments.groupBy(F.col("ordered_at").alias("day")).agg(F.count("*").alias("n"))
    mean = daily.agg(F.avg("n")).scalar()
    busy = (daily.filter(F.col("n") > busy_factor * mean)
            .select(F.col("day").alias("ordered_at"), F.lit(True).alias("busy")))
    df = shipments.join(busy, "ordered_at", "left")
    allowed = (F.when(in_yearly_period(F.col("ordered_at"), config.SHIPPING_PEAK), config.PEAK_PROCESSING_HOURS)
               .when(F.col("busy"), config.BUSY_PROCESSING_HOURS).otherwise(config.PROCESSING_HOURS))
    df = df.withColumns({"hours": elapsed_business_hours(F.col("shipped_on"), F.col("ordered_at")), "allowed_hours": allowed})
    return df.withColumn("breach", F.col("hours") > F.col("allowed_hours"))


def free_upgrade(shipments: DataFrame, vips: DataFrame, claims: DataFrame, as_of) -> DataFrame:
    """Why a shipment is upgraded free of charge. A customer's address error
    excludes it. A carrier's delay alone justifies one beyond fifteen days only,
    and a request without any of the reasons gets none."""
    late = F.datediff(F.coalesce("delivered_on", timestamp(as_of).cast("date")), F.col("expected_on"))
    reship = claims.select("order_id", F.lit(True).alias("reship")).distinct()
    df = (shipments.join(vips.select("customer_id", "is_vip"), "customer_id", "left")
          .join(reship, "order_id", "left"))
    reason = (F.when(F.col("address_error"), F.lit(None)).when(F.col("our_error"), "our_error")
              .when(F.coalesce("is_vip", F.lit(False)) & F.col("complaint"), "vip_complaint")
              .when(F.col("order_value") > config.NOTIFY_VALUE, "high_value")
              .when(F.col("reship"), "damage_reship")
              .when(late > config.UPGRADE_DELAY_DAYS, "long_delay"))
    return df.select("order_id", reason.alias("reason"), reason.isNotNull().alias("free_upgrade"))


def failed_subscriptions(attempts: DataFrame) -> DataFrame:
    """Accounts whose latest attempt failed, with reason and next attempt."""
    w = Window.partitionBy("account_id").orderBy(F.desc("attempted_at"), F.desc("attempt_id"))
    latest = attempts.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return latest.filter("failed").select(
        "account_id", "attempt_id", "reason",
        F.date_add(F.col("attempted_at").cast("date"), config.RETRY_DAYS).alias("next_attempt"))
