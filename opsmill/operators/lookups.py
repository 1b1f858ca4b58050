"""Operational questions over the clean and engineered tables.

Each works on the whole table; filter the result for one product, customer
or order and Catalyst pushes the predicate down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import elapsed_business_hours, elapsed_days, ratio, timestamp
from opsmill.operators.features import order_value


def stock_position(products: DataFrame) -> DataFrame:
    gap = F.col("stock_level") - F.col("restock_threshold")
    return products.select("product_id", "name", "stock_level", "restock_threshold",
                           gap.alias("above_threshold"), (gap < 0).alias("needs_restock"))


def customer_orders(lines: DataFrame) -> DataFrame:
    orders = lines.filter(F.col("customer_id") > 0).select("customer_id", "order_id").distinct()
    df = orders.groupBy("customer_id").agg(F.count("*").alias("total_orders"))
    return df.withColumn("is_vip", F.col("total_orders") >= config.VIP_MIN_ORDERS)


def restock_queue(products: DataFrame) -> DataFrame:
    return (products.filter(F.col("stock_level") < F.col("restock_threshold"))
            .select("product_id", "name", "stock_level", "restock_threshold")
            .orderBy("stock_level", "product_id"))


def order_status(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.max("order_status").alias("order_status"),
        F.max("returned").alias("returned"),
        F.max("order_date").alias("order_date"),
        F.count("*").alias("n_lines"))


def return_rates(lines: DataFrame, baseline: float = config.RETURN_RATE_BASELINE) -> DataFrame:
    orders = lines.groupBy("product_id", "order_id").agg(F.max(F.col("returned").cast("int")).alias("r"))
    df = orders.groupBy("product_id").agg(F.count("*").alias("total_orders"),
                                          F.sum("r").alias("returned_orders"))
    rate = ratio(F.col("returned_orders"), F.col("total_orders"))
    return df.withColumn("return_rate", rate).withColumn("above_baseline", F.col("return_rate") > baseline)


def channel_customers(customers: DataFrame) -> DataFrame:
    return customers.groupBy("acquisition_channel").agg(F.count("*").alias("n_customers"))


def last_order_contents(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product of each customer's latest order. Lines are summed
    per (customer, order, product) first; only the latest order id per
    customer meets them again."""
    items = (lines.filter(F.col("customer_id") > 0)
             .groupBy("customer_id", "order_id", "product_id")
             .agg(F.max("order_date").alias("order_date"), F.sum("quantity").alias("units")))
    orders = items.groupBy("customer_id", "order_id").agg(F.max("order_date").alias("last_date"))
    w = Window.partitionBy("customer_id").orderBy(F.desc("last_date"), F.desc("order_id"))
    last = orders.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return (items.join(last, ["customer_id", "order_id"])
            .join(customers.select("customer_id", "customer_ref"), "customer_id")
            .join(products.select("product_id", "name"), "product_id")
            .select("customer_ref", "order_id", F.col("last_date").alias("order_date"),
                    "product_id", "name", "units"))


def recent_subscriptions(lines: DataFrame, as_of, days: int = 30) -> DataFrame:
    age = elapsed_days(as_of, F.col("order_date"))
    orders = (lines.filter((age >= 0) & (age < days)).groupBy("order_id")
              .agg(F.max(F.col("is_subscription").cast("int")).alias("s")))
    df = orders.agg(F.count("*").alias("all_orders"),
                    F.coalesce(F.sum("s"), F.lit(0)).alias("subscription_orders"))
    return df.withColumn("subscription_share", ratio(F.col("subscription_orders"), F.col("all_orders")))


def never_returned(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with orders but no returned line. Both sides are reduced to
    distinct keys, so the joins see each customer once."""
    real = lines.filter(F.col("customer_id") > 0)
    buyers = real.select("customer_id").distinct()
    returners = real.filter("returned").select("customer_id").distinct()
    return (customers.select("customer_id", "customer_ref")
            .join(buyers, "customer_id", "left_semi")
            .join(returners, "customer_id", "left_anti"))


def order_value_by_tier(lines: DataFrame) -> DataFrame:
    orders = (order_value(lines).filter(F.col("customer_id") > 0)
              .groupBy("customer_id", "order_id").agg(F.sum("order_value").alias("v")))
    per_customer = orders.groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    vip = F.col("n") >= config.VIP_MIN_ORDERS
    df = per_customer.agg(
        *[F.sum(F.when(c, F.col(x)).otherwise(0)).alias(a)
          for a, c, x in (("vip_n", vip, "n"), ("vip_v", vip, "v"), ("std_n", ~vip, "n"), ("std_v", ~vip, "v"))])
    df = df.select(ratio(F.col("vip_v"), F.col("vip_n")).alias("vip_avg_order_value"),
                   ratio(F.col("std_v"), F.col("std_n")).alias("non_vip_avg_order_value"))
    lift = (ratio(F.col("vip_avg_order_value"), F.col("non_vip_avg_order_value")) - 1) * 100
    return df.withColumn("lift_pct", lift)


def sales_velocity(products: DataFrame, lines: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Weekly units over the last ``days`` days, weeks of stock left, priority."""
    age = elapsed_days(as_of, F.col("order_date"))
    recent = (lines.filter((F.col("quantity") > 0) & (age >= 0) & (age < days))
              .groupBy("product_id").agg(F.sum("quantity").alias("recent_units")))
    df = (products.select("product_id", "name", "stock_level", "restock_threshold")
          .join(recent, "product_id", "left")
          .withColumn("recent_units", F.coalesce("recent_units", F.lit(0)))
          .withColumn("weekly_units", F.col("recent_units") * 7.0 / days))
    df = df.withColumn("weeks_to_stockout", F.try_divide("stock_level", "weekly_units"))
    low = F.col("stock_level") < F.col("restock_threshold")
    soon = F.col("weeks_to_stockout") < 4
    return df.withColumn("priority", F.when(low & soon, "high").when(low, "medium")
                         .when(soon, "watch").otherwise("none"))


def restock_plan(products: DataFrame, lines: DataFrame, as_of, days: int = 30, cover_weeks: int = 8) -> DataFrame:
    """Velocity net of returns and the units that refill stock to the
    threshold plus ``cover_weeks`` of net sales."""
    rates = return_rates(lines).select("product_id", "return_rate")
    df = sales_velocity(products, lines, as_of, days).join(rates, "product_id", "left")
    df = df.withColumn("return_rate", F.coalesce("return_rate", F.lit(0.0)))
    df = df.withColumn("net_weekly_units", F.col("weekly_units") * (1 - F.col("return_rate")))
    need = F.col("restock_threshold") + cover_weeks * F.col("net_weekly_units") - F.col("stock_level")
    return df.select("product_id", "name", "stock_level", "return_rate", "net_weekly_units",
                     F.try_divide("stock_level", "net_weekly_units").alias("net_weeks_to_stockout"),
                     F.greatest(need, F.lit(0.0)).alias("restock_units"))


def late_processing(lines: DataFrame, customers: DataFrame, as_of,
                    sla_hours: int = config.PROCESSING_HOURS) -> DataFrame:
    """Open orders older than the processing promise, with the customer's place.
    Only hours of business days count. Guests have no customer row, so they
    stay out of the join."""
    open_orders = (lines.filter(F.col("order_status").isin("pending", "processing"))
                   .groupBy("order_id", "customer_id").agg(F.max("order_date").alias("order_date")))
    hours = elapsed_business_hours(timestamp(as_of), F.col("order_date"))
    late = open_orders.withColumn("hours_open", hours).filter(F.col("hours_open") > sla_hours)
    places = customers.select("customer_id", "customer_ref", "city", "state")
    known = late.filter("customer_id > 0").join(places, "customer_id", "left")
    guests = late.filter("customer_id <= 0 or customer_id is null")
    return (known.unionByName(guests, allowMissingColumns=True)
            .select("order_id", "customer_ref", "city", "state", "order_date", "hours_open"))
