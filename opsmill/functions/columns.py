"""Column helpers shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsmill import config

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def timestamp(value) -> Column:
    """A timestamp literal read in the session time zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def _micros(ts) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed_days(as_of, ts: Column) -> Column:
    """Whole elapsed 24-hour periods, rounded down also before ``as_of``."""
    return F.floor((_micros(timestamp(as_of)) - _micros(ts)) / F.lit(MICROS_PER_DAY)).cast("bigint")


def elapsed_hours(later: Column, earlier: Column) -> Column:
    return F.floor((_micros(later) - _micros(earlier)) / F.lit(MICROS_PER_HOUR)).cast("bigint")


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of every kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def lookup(key: Column, mapping: dict) -> Column:
    """Value for ``key`` in a small fixed mapping, null when absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[key]


def parse_date(c: Column, patterns=config.DATE_PATTERNS) -> Column:
    """First pattern that fits the whole string, null when none does."""
    return F.coalesce(*[F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(p))) for shape, p in patterns])


def season(month: Column) -> Column:
    return lookup(month, config.SEASON_OF_MONTH)


def in_yearly_period(day: Column, period) -> Column:
    """True inside a (month, day) period that wraps over New Year."""
    (from_m, from_d), (to_m, to_d) = period
    md = F.month(day) * 100 + F.dayofmonth(day)
    return (md >= from_m * 100 + from_d) | (md <= to_m * 100 + to_d)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def flags(*named: tuple[Column, str]) -> Column:
    """Array of the names whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in named]))


def elapsed_business_hours(end: Column, start: Column) -> Column:
    """Whole hours from ``start`` to ``end`` that lie on Monday to Friday; not
    below zero. Arithmetic only: five days a week, and what is left over."""
    def seconds(t):
        # Since Monday 1970-01-05: whole weeks, then at most five days of this one.
        s = t.cast("timestamp").cast("double") - 4 * 86400
        week = F.floor(s / 604800)
        return week * 432000 + F.least(s - week * 604800, F.lit(432000.0))
    return F.greatest(F.floor((seconds(end) - seconds(start)) / 3600), F.lit(0)).cast("bigint")
