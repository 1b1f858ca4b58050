"""Catalogue knowledge as relations: ingredients, pairs, sets, routines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsmill.functions.columns import ratio


def product_ingredients(facts: DataFrame) -> DataFrame:
    """(product_id, ingredient, concentration) of products with a list of any
    length of (ingredient, concentration); one of several concentrations of an
    ingredient counts, the highest. Products without a list have no rows."""
    rows = facts.select("product_id", F.inline("ingredients"))
    return rows.groupBy("product_id", "ingredient").agg(F.max("concentration").alias("concentration"))


def _sold(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id").agg(
        F.sum(F.greatest("quantity", F.lit(0))).alias("units"), F.count("*").alias("n"),
        F.count_if("returned").alias("r"))


def ingredient_report(facts: DataFrame, lines: DataFrame) -> DataFrame:
    """Per ingredient. Lines shrink to one row per product before the
    ingredients multiply them."""
    return (product_ingredients(facts).join(_sold(lines), "product_id", "left").groupBy("ingredient")
            .agg(F.count("*").alias("n_products"), F.coalesce(F.sum("units"), F.lit(0)).alias("units_sold"),
                 ratio(F.sum("r"), F.sum("n")).alias("return_rate"),
                 F.min("concentration").alias("min_concentration"), F.max("concentration").alias("max_concentration")))


def ingredient_products(facts: DataFrame, lines: DataFrame) -> DataFrame:
    """Which products contain an ingredient: concentration, place by strength
    within the ingredient (ties share one), units sold and return rate."""
    strength = Window.partitionBy("ingredient").orderBy(F.desc_nulls_last("concentration"))
    rows = product_ingredients(facts).withColumn("strength_rank", F.rank().over(strength))
    return rows.join(_sold(lines), "product_id", "left").select(
        "ingredient", "product_id", "concentration", "strength_rank", F.coalesce("units", F.lit(0)).alias("units_sold"),
        ratio(F.col("r"), F.col("n")).alias("return_rate"))


def attribute_sets(attributes: DataFrame, required: Sequence[str]) -> DataFrame:
    """(product_id, held): which of the ``required`` attributes, at most 63, a product
    has, as bits in their order. Products with none of them have no row.
    ``attributes`` is a relation (product_id, attribute) of any number of attributes."""
    bits = F.create_map(*[x for i, name in enumerate(required) for x in (F.lit(name), F.lit(1 << i))])
    own = attributes.where(F.col("attribute").isin(list(required)))
    return own.groupBy("product_id").agg(F.bit_or(bits[F.col("attribute")]).alias("held"))


def attribute_products(products: DataFrame, attributes: DataFrame, required: Sequence[str]) -> DataFrame:
    """Every product of ``products`` with the required attributes it lacks."""
    held = F.coalesce("held", F.lit(0))
    lacks = F.array_compact(F.array(*[F.when(held.bitwiseAND(F.lit(1 << i)) == 0, name) for i, name in enumerate(required)]))
    return products.join(attribute_sets(attributes, required), "product_id", "left").withColumn("missing", lacks).withColumn(
        "has_all", F.size("missing") == 0).drop("held")


def order_conflicts(lines: DataFrame, facts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Ingredient pairs bought in one order. Each order shrinks to the number of
    products per ingredient that occurs in a pair, kept as a map, in which every first ingredient looks up its
    second: the lines are read once and no order is joined with itself.
    ``pairs`` is (first, second, severity)."""
    listed = pairs.select(F.explode(F.array("first", "second")).alias("ingredient")).distinct()
    used = (lines.select("order_id", "product_id").distinct()
            .join(product_ingredients(facts).join(F.broadcast(listed), "ingredient", "left_semi"), "product_id")
            .groupBy("order_id", "ingredient").agg(F.count("*").alias("n")))
    held = used.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.map_from_entries(F.collect_list(F.struct("ingredient", "n"))).alias("held"))
    first = held.select("order_id", "held", F.explode("held").alias("first", "n_first")).join(pairs, "first")
    return first.withColumn("n_second", F.try_element_at("held", F.col("second"))).filter(F.col("n_second").isNotNull()).select(
        "order_id", "first", "second", "severity", "n_first", "n_second")


def customer_conflicts(lines: DataFrame, facts: DataFrame, pairs: DataFrame, days: int = 30) -> DataFrame:
    """Both ingredients of a pair bought by one customer within ``days``.

    Lines shrink to (customer, ingredient, day); each day looks back to the
    latest day of the other ingredient, so no days are paired off."""
    day = F.col("order_date").cast("date")
    used = (lines.filter(F.col("customer_id") > 0).select("customer_id", "product_id", day.alias("day")).distinct()
            .join(product_ingredients(facts), "product_id").select("customer_id", "ingredient", "day").distinct())
    sides = pairs.select("severity", "first", "second", F.explode(F.array(
        F.struct(F.col("first").alias("ingredient"), F.lit(True).alias("is_first")),
        F.struct(F.col("second").alias("ingredient"), F.lit(False).alias("is_first")))).alias("s")
    ).select("severity", "first", "second", "s.*")
    seen = used.join(sides, "ingredient")
    look_back = ("max(CASE WHEN {} THEN day END) OVER (PARTITION BY customer_id, first, second ORDER BY day "
                 "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    seen = seen.withColumns({"_a": F.expr(look_back.format("is_first")), "_b": F.expr(look_back.format("NOT is_first"))})
    gap = F.datediff("day", F.when(F.col("is_first"), F.col("_b")).otherwise(F.col("_a")))
    return (seen.withColumn("gap", gap).filter(F.col("gap") <= days)
            .groupBy("customer_id", "first", "second", "severity")
            .agg(F.count("*").alias("n_days"), F.min("gap").alias("min_gap")))


def lacking_lines(lines: DataFrame, products: DataFrame, attributes: DataFrame, required: Sequence[str]) -> DataFrame:
    """Lines of products that lack any of the ``required`` attributes, with what
    they lack, the number of stocked substitutes of the category that have all
    of them, and the best stocked one."""
    info = attribute_products(products.select("product_id", "category", "stock_level"), attributes, required)
    best = F.max(F.struct(F.col("stock_level"), -F.col("product_id")))
    options = (info.filter("has_all AND stock_level > 0").groupBy("category")
               .agg(F.count("*").alias("n_substitutes"), best.alias("b"))
               .select("category", "n_substitutes", (-F.col("b.col2")).alias("best_substitute")))
    # Category, with few and large values, is joined at product level only.
    lacking = info.filter("NOT has_all").select("product_id", "category", "missing").join(options, "category", "left")
    return (lines.select("order_id", "product_id").join(lacking, "product_id")
            .select("order_id", "product_id", "category", "missing", F.coalesce("n_substitutes", F.lit(0)).alias("n_substitutes"), "best_substitute"))


def set_report(components: DataFrame, products: DataFrame, attributes: DataFrame, required: Sequence[str]) -> DataFrame:
    """Contents, price next to the sum of the parts' prices, and whether any
    part lacks a ``required`` attribute."""
    price = products.select("product_id", "price")
    items = (components.join(attribute_products(price, attributes, required), "product_id")
             .groupBy("set_id").agg(F.count("*").alias("n_components"), F.sum("price").alias("items_price"),
                                    F.count_if(~F.col("has_all")).alias("n_lacking")))
    return (items.join(price.withColumnRenamed("product_id", "set_id"), "set_id")
            .select("set_id", "n_components", F.col("price").alias("set_price"), "items_price",
                    (F.col("items_price") - F.col("price")).alias("saving"), (F.col("n_lacking") > 0).alias("any_lacking")))


def routine_gaps(lines: DataFrame, steps: DataFrame, products: DataFrame) -> DataFrame:
    """Missing steps of routines a customer owns in part, with the best
    stocked product of the step. ``steps`` is (product_id, routine, step)."""
    owned = (lines.filter(F.col("customer_id") > 0).select("customer_id", "product_id").distinct()
             .join(steps, "product_id").select("customer_id", "routine", "step").distinct())
    best = F.max(F.struct(F.col("stock_level"), -F.col("product_id")))
    offers = (steps.join(products.select("product_id", "stock_level"), "product_id").filter("stock_level > 0")
              .groupBy("routine", "step").agg(best.alias("b"))
              .select("routine", "step", (-F.col("b.col2")).alias("product_id")))
    started = owned.select("customer_id", "routine").distinct()
    return started.join(offers, "routine").join(owned, ["customer_id", "routine", "step"], "left_anti")
