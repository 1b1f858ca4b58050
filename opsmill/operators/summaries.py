"""Summary figures of the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill import config


def product_summary(products: DataFrame) -> DataFrame:
    return products.agg(F.count("*").alias("total_products"),
                        F.count_if("needs_restock").alias("needing_restock"))


def customer_summary(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count("*").alias("total_customers"),
                         F.count_if("is_repeat_customer").alias("repeat_customers"),
                         F.avg("total_orders").alias("avg_orders"))


def channel_counts(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("acquisition_channel").agg(F.count("*").alias("n_customers"))
            .orderBy(F.desc("n_customers"), "acquisition_channel"))


def order_summary(lines: DataFrame) -> DataFrame:
    """Grouped by order first: the distinct count needs no expand and no hot key."""
    orders = lines.groupBy("order_id").agg(
        F.count("*").alias("n"),
        F.min("order_date").alias("lo"), F.max("order_date").alias("hi"),
        F.count_if(F.col("customer_id") == config.GUEST_CUSTOMER_ID).alias("guest"),
        F.count_if("is_subscription").alias("subscription"),
        F.count_if("returned").alias("returned"),
        F.count_if("is_weekend").alias("weekend"))
    return orders.agg(
        F.sum("n").alias("line_items"), F.count("*").alias("unique_orders"),
        F.min("lo").alias("first_date"), F.max("hi").alias("last_date"),
        F.sum("guest").alias("guest_lines"), F.sum("subscription").alias("subscription_lines"),
        F.sum("returned").alias("returned_lines"), F.sum("weekend").alias("weekend_lines"))
