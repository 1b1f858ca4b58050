"""Labelled rows for fitting, and the split into fitted and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc: Column) -> Column:
    """True where crc32 of the id as text leaves 2 by 4; false without an id."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitting_labels(labels: DataFrame, name: str, doc: str = "doc_id") -> DataFrame:
    """(id, y) of rows to fit on: one per id, labels 0 and 1 only; an id with
    both counts as 1."""
    rows = labels.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{name}`").cast("int").alias("y"))
    rows = rows.where("id is not null and y in (0, 1)").where(~held_out(F.col("id")))
    return rows.groupBy("id").agg(F.max("y").alias("y"))
