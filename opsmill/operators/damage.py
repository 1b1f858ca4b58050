"""Damaged-shipment rules over whole tables of claims.

A claim has claim_id, order_id, customer_id, order_value, carrier,
delivered_on, claimed_on, grade, damaged_items, has_photos, carrier_paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import flags, lookup, ratio
from opsmill.operators.trailing import earlier_counts, running_counts, trailing_counts


def _on_claim_day(claims: DataFrame, counts: DataFrame) -> DataFrame:
    counts = counts.withColumnRenamed("day", "_day")
    return (claims.withColumn("_day", F.col("claimed_on").cast("date"))
            .join(counts, ["customer_id", "_day"]).drop("_day"))


def red_flags(claims: DataFrame) -> DataFrame:
    counts = trailing_counts(claims, "customer_id", "claimed_on", 6, "claims_6m")
    df = _on_claim_day(claims, counts).withColumn("red_flags", flags(
        (F.col("claims_6m") > config.CLAIMS_IN_SIX_MONTHS, "many_claims"),
        (F.col("order_value") > config.HIGH_VALUE, "high_value"),
        (F.datediff("claimed_on", "delivered_on") > config.LATE_CLAIM_DAYS, "late_claim")))
    return df.withColumn("escalate", F.size("red_flags") > 0)


def photo_requirement(claims: DataFrame, orders: DataFrame) -> DataFrame:
    """Mandatory above the high value; waived for customers who are loyal as of
    the claim (distinct orders up to its day) and have no earlier claim;
    required otherwise."""
    placed = orders.select("customer_id", "order_id", F.col("ordered_at").cast("date").alias("day"))
    placed = placed.groupBy("customer_id", "order_id").agg(F.min("day").alias("day"))
    placed = running_counts(placed, "customer_id", "day", "total_orders", claims, "claimed_on")
    df = _on_claim_day(claims, earlier_counts(claims, "customer_id", "claimed_on", "prior_claims"))
    df = _on_claim_day(df, placed)
    loyal = (F.coalesce("total_orders", F.lit(0)) >= config.VIP_MIN_ORDERS) & (F.col("prior_claims") == 0)
    return df.withColumn("photos", F.when(F.col("order_value") > config.HIGH_VALUE, "mandatory")
                         .when(loyal, "waived").otherwise("required"))


def final_grade(claims: DataFrame) -> DataFrame:
    """More than one damaged item in the order upgrades to the top grade."""
    items = claims.groupBy("order_id").agg(F.sum("damaged_items").alias("order_damaged_items"))
    df = claims.join(items, "order_id")
    multiple = F.col("order_damaged_items") > 1
    return df.withColumns({"multiple": multiple,
                           "final_grade": F.when(multiple, "C").otherwise(F.col("grade"))})


def availability(stock: Column, discontinued: Column) -> Column:
    return (F.when(discontinued, "refund_only_plus_credit")
            .when(stock > config.LOW_STOCK_UNITS, "replacement_or_refund")
            .when(stock >= 1, "replacement_or_refund_restock")
            .otherwise("refund_or_wait"))


def replacement_availability(requests: DataFrame, stock: DataFrame) -> DataFrame:
    """Offers for damaged items; a product without a stock row is looked up by hand."""
    unknown = F.col("known").isNull()
    offer = F.when(unknown, "check_product").otherwise(availability(F.col("stock"), F.col("discontinued")))
    return (requests.filter(F.col("item_condition") == "damaged")
            .join(stock.select("product_id", "stock", "discontinued", F.lit(True).alias("known")), "product_id", "left")
            .select("order_id", "line_no", "product_id", "stock", offer.alias("offer"), unknown.alias("unknown_product")))


def compensation(graded: DataFrame) -> DataFrame:
    """Needs ``final_grade`` and ``multiple``. 15 % and more needs a manager."""
    base = F.when(F.col("multiple"), config.MULTIPLE_DAMAGE_DISCOUNT).otherwise(
        lookup(F.col("final_grade"), config.DISCOUNT_BY_GRADE))
    floor = F.when(F.col("order_value") > config.HIGH_VALUE, config.HIGH_VALUE_DISCOUNT).otherwise(0)
    df = graded.withColumns({
        "discount_pct": F.greatest(base, floor),
        "store_credit": F.when(F.col("final_grade") == "A", config.GRADE_A_CREDIT).otherwise(0.0),
    })
    return df.withColumns({
        "approval": F.when(F.col("discount_pct") >= config.HIGH_VALUE_DISCOUNT, "manager").otherwise("auto"),
        "notify_manager": F.col("order_value") > config.NOTIFY_VALUE,
    })


def carrier_filings(graded: DataFrame) -> DataFrame:
    file = ((F.col("order_value") > config.CARRIER_CLAIM_MIN_VALUE)
            & F.col("final_grade").isin("B", "C") & F.col("has_photos"))
    return graded.groupBy("carrier").agg(
        F.count("*").alias("claims"), F.count_if(file).alias("filed"),
        F.sum(F.when(file, F.col("order_value")).otherwise(0.0)).alias("recoverable"))


def _monthly(df: DataFrame, day: str, name: str) -> DataFrame:
    return df.groupBy(F.trunc(day, "month").alias("month"), "carrier").agg(F.count("*").alias(name))


def carrier_monitor(claims: DataFrame, shipments: DataFrame) -> DataFrame:
    """Months with damages per carrier. Five damages in a month count over all
    carriers, three over one."""
    damages = _monthly(claims, "claimed_on", "damages")
    shipped = _monthly(shipments, "shipped_on", "shipments")
    total = damages.groupBy("month").agg(F.sum("damages").alias("month_damages"))
    df = damages.join(shipped, ["month", "carrier"], "left").join(total, "month")
    df = df.withColumn("damage_rate", ratio(F.col("damages"), F.col("shipments")))
    return df.withColumn("triggers", flags(
        (F.col("damages") >= config.CARRIER_MONTHLY_REVIEW, "three_same_carrier"),
        (F.col("month_damages") >= config.CARRIER_MONTHLY_ESCALATE, "five_any_carrier"),
        (F.col("damage_rate") > config.CARRIER_DAMAGE_RATE, "rate_over_1pct")))


def damage_cost_report(claims: DataFrame, shipments: DataFrame) -> DataFrame:
    """Totals by month and carrier with subtotals. Both inputs shrink to one
    row per (month, carrier) before the rollup expands them."""
    paid = F.when(F.col("carrier_paid"), F.col("order_value")).otherwise(0.0)
    cost = claims.groupBy(F.trunc("claimed_on", "month").alias("month"), "carrier").agg(
        F.count("*").alias("claims"), F.sum("order_value").alias("cost"), F.sum(paid).alias("recovered"))
    cost = cost.withColumn("shipments", F.lit(0).cast("bigint"))
    shipped = _monthly(shipments, "shipped_on", "shipments").select(
        "month", "carrier", F.lit(0).cast("bigint").alias("claims"), F.lit(0.0).alias("cost"),
        F.lit(0.0).alias("recovered"), "shipments")
    df = cost.unionByName(shipped).rollup("month", "carrier").agg(
        *[F.sum(c).alias(c) for c in ("claims", "cost", "recovered", "shipments")])
    return df.withColumns({
        "recovery_rate": ratio(F.col("recovered"), F.col("cost")),
        "mean_cost": ratio(F.col("cost"), F.col("claims")),
        "damage_rate": ratio(F.col("claims"), F.col("shipments")),
    }).withColumns({
        "recovery_ok": F.col("recovery_rate") > config.RECOVERY_TARGET,
        "damage_ok": F.col("damage_rate") < config.DAMAGE_RATE_TARGET,
    })


def contents_check(ordered: DataFrame, received: DataFrame) -> DataFrame:
    """Items received but not ordered, and ordered but not received."""
    keys = ["order_id", "product_id"]
    a, b = ordered.select(*keys).distinct(), received.select(*keys).distinct()

    def issue(df, name, pct):
        return df.withColumns({"issue": F.lit(name), "discount_pct": F.lit(pct)})

    return issue(b.join(a, keys, "left_anti"), "wrong_item", config.WRONG_ITEM_DISCOUNT).unionByName(
        issue(a.join(b, keys, "left_anti"), "missing_item", config.MISSING_ITEM_DISCOUNT))


def photo_follow_up(claims: DataFrame) -> DataFrame:
    h = F.col("hours_since_request")
    return claims.filter(~F.col("has_photos")).select(
        "claim_id", h, F.when(h > config.PHOTO_CLOSE_HOURS, "close").when(h > config.PHOTO_REMINDER_HOURS, "remind")
        .otherwise("wait").alias("action"))
