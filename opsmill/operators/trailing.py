"""Counts over a trailing calendar period, safe for very busy keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(events: DataFrame, key: str, day: str) -> DataFrame:
    return events.groupBy(key, F.col(day).cast("date").alias("day")).agg(F.count("*").alias("n"))


def trailing_counts(events: DataFrame, key: str, day: str, months: int, name: str,
                    probes: DataFrame | None = None, probe_day: str | None = None) -> DataFrame:
    """Events of each key in the ``months`` months up to and with each day.

    Rows are (key, day) for every day that has an event or a probe. Events
    collapse to daily counts map-side first, so a window partition holds at
    most one row per calendar day however busy the key is."""
    days = daily_counts(events, key, day)
    if probes is not None:
        asked = probes.select(key, F.col(probe_day).cast("date").alias("day"), F.lit(0).cast("bigint").alias("n"))
        days = days.unionByName(asked).groupBy(key, "day").agg(F.sum("n").alias("n"))
    frame = (f"sum(n) OVER (PARTITION BY {key} ORDER BY day "
             f"RANGE BETWEEN INTERVAL {months} MONTH PRECEDING AND CURRENT ROW)")
    return days.select(key, "day", F.expr(frame).alias(name))


def running_counts(events: DataFrame, key: str, day: str, name: str, probes: DataFrame, probe_day: str) -> DataFrame:
    """Events of each key up to and with each of its probe days."""
    asked = probes.select(key, F.col(probe_day).cast("date").alias("day"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asked"))
    days = daily_counts(events, key, day).withColumn("asked", F.lit(False)).unionByName(asked)
    days = days.groupBy(key, "day").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    frame = f"sum(n) OVER (PARTITION BY {key} ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return days.select(key, "day", F.expr(frame).alias(name), "asked").filter("asked").drop("asked")


def earlier_counts(events: DataFrame, key: str, day: str, name: str) -> DataFrame:
    """Events of each key on days before each of its event days."""
    frame = (f"coalesce(sum(n) OVER (PARTITION BY {key} ORDER BY day "
             "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    return daily_counts(events, key, day).select(key, "day", F.expr(frame).alias(name))
