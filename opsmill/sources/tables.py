"""Sources and sinks: tables, document corpora, evaluation cases, reports."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT_SCHEMA = ("product_id INT, name STRING, category STRING, price DOUBLE, cost DOUBLE, "
                  "stock_level INT, restock_threshold INT")
CUSTOMER_SCHEMA = ("customer_id INT, customer_ref STRING, email STRING, city STRING, state STRING, "
                   "acquisition_channel STRING, created_at STRING")
ORDER_SCHEMA = ("order_id INT, customer_id INT, customer_email STRING, order_date STRING, product_id INT, "
                "quantity INT, price DOUBLE, discount_applied INT, is_subscription INT, order_status STRING, "
                "returned INT, return_reason STRING")
# expected_data differs in shape from case to case, so it stays raw JSON.
CASE_SCHEMA = ("id STRING, category STRING, difficulty STRING, query STRING, "
               "expected_sources ARRAY<STRING>, expected_data STRING, expected_decision STRING, reasoning STRING")


def load_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def load_raw(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The raw products, customers and orders tables below ``root``."""
    return (load_table(spark, f"{root}/products", PRODUCT_SCHEMA),
            load_table(spark, f"{root}/customers", CUSTOMER_SCHEMA),
            load_table(spark, f"{root}/orders", ORDER_SCHEMA))


def load_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines under an enforced schema. A line that does not fit it keeps
    what could be read and stands in ``corrupt``, null elsewhere."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    return spark.read.text(path).select(F.from_json("value", f"{schema}, corrupt STRING", options).alias("r")).select("r.*")


def corrupt_report(rows: DataFrame, table: str, **sums: str) -> DataFrame:
    """How many rows were read, how many did not fit, the first of those, and sums
    of columns over the others."""
    return rows.agg(F.count("*").alias("rows_read"), F.count("corrupt").alias("corrupt_rows"), F.min("corrupt").alias("example"),
                    *[F.sum(F.when(F.col("corrupt").isNull(), F.col(c))).alias(n) for n, c in sums.items()]).select(
        F.lit(table).alias("table_name"), "rows_read", "corrupt_rows", "example", *sums)


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: file name as source, where it lies as path, whole file as
    text. Folders below ``path`` count."""
    return (spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("source"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def load_cases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CASE_SCHEMA).json(path, multiLine=True)


def parse_cases(texts: DataFrame, column: str = "value") -> DataFrame:
    """Cases from rows of JSON text, one case per row."""
    return texts.select(F.from_json(column, CASE_SCHEMA).alias("c")).select("c.*")


LOG_SCHEMA = "version BIGINT, folders ARRAY<STRING>, schema STRING"


def _latest(spark: SparkSession, path: str):
    """The last complete version of a published table, or None."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{path}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.orderBy(F.desc("version"), F.desc("folders")).first()


def publish(df: DataFrame, path: str, partition_by: str | None = None, keep: bool = False) -> None:
    """Write ``df`` as the next version of the table at ``path``, behind what is there
    with ``keep``, else instead of it.

    Rows go to a fresh folder; only when that is complete does a line of the table's
    log name it. So readers and a failed job see the old version or the new one, never
    a part of either, and a job may read the table that it replaces. Folders of old
    versions stay, for readers that are still busy with them. Of two writers at once one counts."""
    spark = df.sparkSession
    before = _latest(spark, path)
    folder = f"rows-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/{folder}")
    folders = [*(before.folders if keep and before else []), folder]
    row = (before.version + 1 if before else 1, folders, df.schema.json())
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/log")


def read_published(spark: SparkSession, path: str, empty: str | None = None) -> DataFrame:
    """The last complete version. A table never published is an error, or an
    empty table of the schema ``empty``."""
    last = _latest(spark, path)
    if last is None:
        if empty is None:
            raise FileNotFoundError(f"no published table at {path}")
        return spark.createDataFrame([], empty)
    schema = T.StructType.fromJson(json.loads(last.schema))
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in last.folders])


def published_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of the last complete version."""
    last = _latest(spark, path)
    return list(last.folders) if last else []


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    publish(df, path, partition_by)


def save_clean(products: DataFrame, customers: DataFrame, lines: DataFrame, root: str) -> None:
    """Replace the clean tables. Order lines are laid out by month, so that
    date filters prune files."""
    replace_table(products, f"{root}/products")
    replace_table(customers, f"{root}/customers")
    month = F.date_format("order_date", "yyyy-MM")
    # Rebalanced at run time: a busy month is written by as many tasks as it
    # has data for, and small months share one.
    laid_out = lines.withColumn("order_month", month).hint("rebalance", "order_month")
    replace_table(laid_out, f"{root}/orders", "order_month")


def save_report(df: DataFrame, path: str) -> None:
    """A nested report as JSON lines, one document per row."""
    df.write.mode("overwrite").json(path)
