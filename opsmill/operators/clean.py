"""Cleaning of products, customers and order lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import elapsed_days, lookup, parse_date, ratio, strip, timestamp


def strip_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: strip(F.col(n)) for n in names})


def title_case(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.initcap(name))


def lower_case(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lower(name))


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit raises under ANSI mode."""
    return df.withColumns({n: F.col(n).cast(t) for n, t in types.items()})


def margin_pct(price: Column, cost: Column) -> Column:
    return F.bround(F.try_divide(price - cost, price) * 100, 2)


def dedupe_by_key(df: DataFrame, keys: list[str], order_by: list[str], keep: str = "first") -> DataFrame:
    """One row per key. Spark trims each map partition to one row per key
    before the shuffle, so a hot key never gathers in one task."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def map_values(df: DataFrame, name: str, mapping: dict[str, str], exact: bool = False) -> DataFrame:
    """Replace values found in ``mapping``; others pass through unchanged.

    Keys are compared in lower case without outer blanks unless ``exact``."""
    key = F.col(name) if exact else F.lower(strip(F.col(name)))
    return df.withColumn(name, F.coalesce(lookup(key, mapping), F.col(name)))


def fill_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))


def parse_dates(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, parse_date(F.col(name)))


def drop_unparsed_dates(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def mark_guests(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "customer_id": F.coalesce("customer_id", F.lit(config.GUEST_CUSTOMER_ID)),
        "customer_email": F.coalesce("customer_email", F.lit(config.GUEST_EMAIL)),
    })


def impute_status(df: DataFrame, as_of) -> DataFrame:
    age = elapsed_days(as_of, F.col("order_date"))
    filled = F.when(F.col("order_status").isNotNull(), F.col("order_status"))
    for days, status in config.STATUS_BY_AGE:
        filled = filled.when(age > days, status)
    return df.withColumn("order_status", filled)


def clean_products(raw: DataFrame) -> DataFrame:
    df = title_case(strip_columns(raw, "name", "category"), "category")
    df = enforce_types(df, {"price": "double", "cost": "double",
                            "stock_level": "int", "restock_threshold": "int"})
    return df.withColumn("margin_pct", margin_pct(F.col("price"), F.col("cost")))


def _unwatched(df: DataFrame, stage: str, **figures: Column) -> DataFrame:
    return df


def clean_customers(raw: DataFrame, as_of, watch=_unwatched) -> DataFrame:
    df = lower_case(strip_columns(raw, "email"), "email")
    df = watch(dedupe_by_key(df, ["email"], ["customer_id"]), "customers distinct")
    df = map_values(df, "state", config.STATE_ABBREVIATIONS)
    df = fill_constant(df, "acquisition_channel", config.UNKNOWN_CHANNEL)
    df = parse_dates(df, "created_at")
    return df.withColumn("tenure_days", elapsed_days(as_of, F.col("created_at")))


def clean_orders(raw: DataFrame, as_of, watch=_unwatched) -> DataFrame:
    """Copies go before the dates are parsed: one date in two formats is two rows."""
    open_ = {"guests": F.count_if(F.col("customer_id").isNull()), "open": F.count_if(F.col("order_status").isNull())}
    df = watch(drop_exact_duplicates(raw), "orders distinct")
    df = watch(drop_unparsed_dates(parse_dates(df, "order_date"), "order_date"), "orders dated", **open_)
    df = watch(impute_status(mark_guests(df), as_of), "orders filled", **open_)
    return enforce_types(df, {
        "customer_id": "bigint", "quantity": "int", "price": "double",
        "discount_applied": "boolean", "is_subscription": "boolean", "returned": "boolean",
    })


def orphan_keys(lines: DataFrame, parents: DataFrame, key: str, kind: str) -> DataFrame:
    """Keys of order lines without a parent row. Lines are counted per key
    first, so the anti join sees each key once."""
    counts = lines.groupBy(key).agg(F.count("*").alias("n_lines"))
    return (counts.join(parents.select(key), key, "left_anti")
            .select(F.lit(kind).alias("kind"), F.col(key).alias("missing_key"), "n_lines"))


def referential_report(lines: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    real = lines.filter(F.col("customer_id") > 0)
    return (orphan_keys(lines, products, "product_id", "product")
            .unionByName(orphan_keys(real, customers, "customer_id", "customer")))


def _share(condition: Column, weight: Column) -> Column:
    return ratio(F.sum(F.when(condition, weight).otherwise(0)), F.sum(weight))


def audit_orders(raw: DataFrame) -> DataFrame:
    """Raw quality rates from one pass: equal rows collapse map-side to one
    row with a weight, every rate is then a weighted share."""
    d, n = F.col("order_date"), F.col("_n")
    grouped = raw.groupBy(*raw.columns).agg(F.count("*").alias("_n"))
    return grouped.agg(
        F.sum(n).alias("rows_total"),
        ratio(F.sum(n - 1), F.sum(n)).alias("duplicate_rate"),
        _share(F.col("customer_id").isNull(), n).alias("missing_customer_rate"),
        _share(F.col("order_status").isNull(), n).alias("null_status_rate"),
        _share(F.col("quantity") < 0, n).alias("negative_quantity_rate"),
        _share(d.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), n).alias("iso_date_rate"),
        _share(d.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), n).alias("us_date_rate"),
        _share(d.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T"), n).alias("timestamp_date_rate"),
    )


def audit_customers(raw: DataFrame) -> DataFrame:
    email, one = F.col("email"), F.lit(1)
    return raw.agg(
        F.count("*").alias("rows_total"),
        _share(email.rlike(r"^\s|\s$"), one).alias("untrimmed_email_rate"),
        _share(email != F.lower(email), one).alias("upper_email_rate"),
        _share(F.length("state") > 2, one).alias("long_state_rate"),
        _share(F.col("acquisition_channel").isNull(), one).alias("missing_channel_rate"),
    )


class Watch:
    """Counts of the rows that pass a stage of a job, taken while the job runs."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def __call__(self, df: DataFrame, stage: str, **figures: Column) -> DataFrame:
        self.seen[stage] = Observation()
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in figures.items()])

    def figures(self) -> dict[str, dict[str, int]]:
        """Per stage; waits until the job has run."""
        return {stage: o.get for stage, o in self.seen.items()}


def cleaning_report(raw_orders: DataFrame, raw_customers: DataFrame, raw_products: DataFrame, as_of,
                    save: Callable[[DataFrame, DataFrame, DataFrame], None]) -> DataFrame:
    """Rows in, out and changed per cleaning stage, one row per figure, counted by the
    cleaning job itself in the one pass that ``save`` (products, customers, order lines) makes.

    Each table must be written once by ``save``. Where an executor is lost, a
    stage that runs again counts its rows again; the tables written are not touched by that."""
    spark = raw_orders.sparkSession
    watch = Watch()
    save(watch(clean_products(watch(raw_products, "products in")), "products out"),
         watch(clean_customers(watch(raw_customers, "customers in"), as_of, watch), "customers out"),
         watch(clean_orders(watch(raw_orders, "orders in"), as_of, watch), "orders out"))
    n = watch.figures()
    rows = [
        ("orders", "rows_in", n["orders in"]["rows"]),
        ("orders", "duplicates_removed", n["orders in"]["rows"] - n["orders distinct"]["rows"]),
        ("orders", "unparsed_dates_removed", n["orders distinct"]["rows"] - n["orders dated"]["rows"]),
        ("orders", "rows_out", n["orders out"]["rows"]),
        ("orders", "guests_marked", n["orders dated"]["guests"] - n["orders filled"]["guests"]),
        ("orders", "statuses_imputed", n["orders dated"]["open"] - n["orders filled"]["open"]),
        ("customers", "rows_in", n["customers in"]["rows"]),
        ("customers", "duplicates_removed", n["customers in"]["rows"] - n["customers distinct"]["rows"]),
        ("customers", "rows_out", n["customers out"]["rows"]),
        ("products", "rows_in", n["products in"]["rows"]),
        ("products", "rows_out", n["products out"]["rows"]),
    ]
    return spark.createDataFrame(rows, "table_name STRING, figure STRING, n BIGINT")
