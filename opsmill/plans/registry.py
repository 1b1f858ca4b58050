"""Registry of queries: a Spark builder and, where SQL can say it, an oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmill.operators import clean, features
from opsmill.plans import fixtures


@dataclass(frozen=True)
class Query:
    build: Callable[["Tables"], DataFrame]
    sql: str | None
    exact: tuple[str, ...] = ()


# Large sums of money: the engines add in different orders, so four decimals.
LARGE_SUMS = ("total_revenue",)

QUERIES: dict[str, Query] = {}
# Named steps the oracles share; a body may use base tables and other names.
ORACLE_STEPS: dict[str, str] = {
    name: body.format(**fixtures.DUCKDB, **{t: t for t in (*fixtures.BASE_TABLES, *fixtures.VIEWS)})
    for name, body in fixtures.VIEWS.items()
}


# Tables with much work per row. The supplied files are a single row group
# each, which Spark cannot deal to several tasks.
SPREAD = ("lineitem", "documents")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores where a table has fewer files than cores and no
    more than one wave of splits. Splits say little: a file of one row group is
    cut into byte ranges of which one has all rows. What is shuffled is never
    more than a split per core; tables of many files are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores or df.rdd.getNumPartitions() > cores:
        return df
    return df.repartition(cores)


# Order lines that a task joins, strips of copies and groups, all in memory at once.
LINES_PER_TASK = 200_000


def dealt(lines: DataFrame, key: str) -> DataFrame | None:
    """``lines`` dealt by ``key``, on which they meet their orders, to tasks of bounded
    size, or None where that is no more than a task per core. Spark merges the partitions
    it makes by itself up to 64 MB of compressed rows, which take 20 times that
    in the sorts and hash maps of one task; a number that is given stays."""
    n = -(-lines.count() // LINES_PER_TASK)
    if n <= lines.sparkSession.sparkContext.defaultParallelism:
        return None
    return lines.filter(F.col(key).isNotNull()).repartition(n, key)


class Tables:
    """Supplied tables and the views over them, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, root: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.root = spark, root
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.BASE_TABLES:
            if name not in self._known:
                df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
                self._known[name] = spread(df) if name in SPREAD else df
            return self._known[name]
        if name in fixtures.VIEWS:
            if name not in self._known:
                body = fixtures.VIEWS[name]
                used = {u: getattr(self, u) for u in set(re.findall(r"{(\w+)}", body)) if u not in fixtures.SPARK}
                if name == "raw_orders":
                    used["lineitem"] = dealt(self.spark.read.parquet(f"{self.root}/lineitem.parquet"), "l_orderkey") or used["lineitem"]
                for part, text in fixtures.SPARK.items():
                    body = body.replace("{" + part + "}", text)
                self._known[name] = self.spark.sql(body, **used)
            return self._known[name]
        raise AttributeError(name)

    @property
    def products(self) -> DataFrame:
        return clean.clean_products(self.raw_products)

    @property
    def customers(self) -> DataFrame:
        return clean.clean_customers(self.raw_customers, fixtures.AS_OF)

    @property
    def lines(self) -> DataFrame:
        return clean.clean_orders(self.raw_orders, fixtures.AS_OF)

    @property
    def valued_lines(self) -> DataFrame:
        return features.order_features(self.lines)


def present(df: DataFrame, exact: tuple[str, ...] = ()) -> DataFrame:
    """Plain output types: days as text, whole numbers as BIGINT, doubles to
    six decimals, large sums to four (but for ``exact`` columns, which are copied), arrays joined,
    so both engines print the same value."""
    out = []
    for field in df.schema:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("date").cast("string")
        elif isinstance(t, T.IntegralType):
            c = c.cast("bigint")
        elif field.name in exact:
            pass
        elif isinstance(t, (T.DecimalType, T.FractionalType)):
            # adding 0 turns -0.0 into 0.0
            c = F.round(c.cast("double"), 4 if field.name in LARGE_SUMS else 6) + F.lit(0.0)
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, exact: tuple[str, ...] = ()):
    def register(build):
        QUERIES[name] = Query(build, sql, exact)
        return build
    return register


def step(name: str, body: str) -> None:
    ORACLE_STEPS[name] = body


def run(name: str, spark: SparkSession, root: str) -> DataFrame:
    return present(QUERIES[name].build(Tables(spark, root)), QUERIES[name].exact)


def oracle(name: str) -> str | None:
    """The oracle with every shared step it needs put in front as a CTE."""
    sql = QUERIES[name].sql
    if sql is None:
        return None
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in ORACLE_STEPS and word not in seen:
                seen.add(word)
                visit(ORACLE_STEPS[word])
                order.append(word)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({ORACLE_STEPS[n]})" for n in order)
    head = "WITH RECURSIVE" if "RECURSIVE" in sql or any("UNION ALL" in ORACLE_STEPS[n] for n in order) else "WITH"
    body = re.sub(r"^\s*WITH(\s+RECURSIVE)?\s", ", ", sql)
    return f"{head} {ctes}\n{body}"
