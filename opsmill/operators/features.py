"""Feature engineering over the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import elapsed_days, season


def order_value(lines: DataFrame) -> DataFrame:
    gross = F.col("price") * F.col("quantity")
    return lines.withColumn(
        "order_value", F.when(F.col("discount_applied"), gross * config.DISCOUNT_FACTOR).otherwise(gross))


def calendar_features(lines: DataFrame) -> DataFrame:
    df = lines.withColumns({"day_of_week": F.weekday("order_date"), "month": F.month("order_date")})
    return df.withColumns({"is_weekend": F.col("day_of_week").isin(5, 6), "season": season(F.col("month"))})


def order_features(lines: DataFrame) -> DataFrame:
    return order_value(calendar_features(lines))


def per_order(lines: DataFrame, *keys: str, **sums: str) -> DataFrame:
    """One row per (keys, order). Grouping by order first spreads a hot
    customer or product over its orders and replaces a distinct count."""
    return lines.groupBy(*keys, "order_id").agg(
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
        *[F.sum(c).alias(a) for a, c in sums.items()])


def customer_history(lines: DataFrame, as_of) -> DataFrame:
    """``total_revenue`` adds unit prices: no quantity, no discount, returns in."""
    orders = per_order(lines.filter(F.col("customer_id") > 0), "customer_id", revenue="price")
    df = orders.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
        F.sum("revenue").alias("total_revenue"),
    )
    return df.withColumns({
        "is_repeat_customer": F.col("total_orders") > 1,
        "days_since_last_order": elapsed_days(as_of, F.col("last_order_date")),
    })


def add_customer_history(customers: DataFrame, history: DataFrame) -> DataFrame:
    return customers.join(history, "customer_id", "left").withColumns({
        "total_orders": F.coalesce("total_orders", F.lit(0)),
        "is_repeat_customer": F.coalesce("is_repeat_customer", F.lit(False)),
        "total_revenue": F.coalesce("total_revenue", F.lit(0.0)),
    })


def product_sales(lines: DataFrame) -> DataFrame:
    """``total_revenue`` adds discounted order values of positive quantities."""
    orders = per_order(lines.filter(F.col("quantity") > 0), "product_id",
                       units="quantity", revenue="order_value")
    return orders.groupBy("product_id").agg(
        F.count("*").alias("num_orders"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("total_revenue"),
    )


def add_product_sales(products: DataFrame, sales: DataFrame) -> DataFrame:
    return products.join(sales, "product_id", "left").withColumns({
        "num_orders": F.coalesce("num_orders", F.lit(0)),
        "units_sold": F.coalesce("units_sold", F.lit(0)),
        "total_revenue": F.coalesce("total_revenue", F.lit(0.0)),
    })


def restock_flag(products: DataFrame) -> DataFrame:
    return products.withColumn("needs_restock", F.col("stock_level") < F.col("restock_threshold"))


def engineer(products: DataFrame, customers: DataFrame, lines: DataFrame, as_of):
    """All features: returns (products, customers, order lines)."""
    lines = order_features(lines)
    products = restock_flag(add_product_sales(products, product_sales(lines)))
    customers = add_customer_history(customers, customer_history(lines, as_of))
    return products, customers, lines
