"""Offline retrieval evaluation.

A case has test_id, category, difficulty, query, expected_sources. An arm is a
corpus (id, source, vec) with the function that embeds its queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import ratio
from opsmill.operators.retrieval import nearest

Arm = tuple[DataFrame, Callable[[Column], Column]]


def document_cases(cases: DataFrame) -> DataFrame:
    return cases.filter(F.col("category").isin(*config.DOCUMENT_CATEGORIES))


def category_counts(cases: DataFrame) -> DataFrame:
    return document_cases(cases).groupBy("category").agg(F.count("*").alias("n_cases"))


def source_hit(expected: Column, retrieved: Column) -> Column:
    """Any expected and retrieved name of which one contains the other."""
    return F.coalesce(F.exists(retrieved, lambda r: F.exists(
        expected, lambda e: F.contains(r, e) | F.contains(e, r))), F.lit(False))


def run_cases(cases: DataFrame, arms: dict[str, Arm], key: str, k: int = 3) -> DataFrame:
    """One row per case and arm with its ordered hits (at most k)."""
    def one(name: str, arm: Arm) -> DataFrame:
        corpus, embed = arm
        queries = cases.select(F.col("test_id").alias("query_id"), embed(F.col("query")).alias("vec"))
        hits = nearest(corpus, queries, key, k)
        packed = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(
            F.struct("rank", "distance", "source", F.col(key).alias("id")))).alias("retrieved"))
        return packed.select(F.col("query_id").alias("test_id"), F.lit(name).alias("arm"), "retrieved")

    found = reduce(DataFrame.unionByName, [one(n, a) for n, a in arms.items()])
    asked = cases.withColumn("arm", F.explode(F.array(*[F.lit(n) for n in arms])))
    df = asked.join(found, ["test_id", "arm"], "left")
    names = F.col("retrieved.source")
    return df.withColumns({
        "retrieved_sources": names,
        "sources_match": source_hit(F.col("expected_sources"), names),
        "top_distance": F.get("retrieved", F.lit(0))["distance"],
    })


def accuracy(results: DataFrame) -> DataFrame:
    return (results.groupBy("arm").agg(F.avg(F.col("sources_match").cast("int")).alias("accuracy"))
            .orderBy(F.desc("accuracy"), "arm"))


def accuracy_pivot(results: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Percent per arm and value of ``column``, one decimal. Fixed values save
    the pass that would look for them."""
    df = results.groupBy("arm").pivot(column, values).agg(F.avg(F.col("sources_match").cast("int")) * 100)
    return df.select("arm", *[F.round(F.col(f"`{v}`"), 1).alias(v) for v in values])


def mean_distance(results: DataFrame) -> DataFrame:
    return (results.groupBy("arm").agg(F.avg("top_distance").alias("avg_distance"))
            .orderBy("avg_distance", "arm"))


def run_costs(log: DataFrame) -> DataFrame:
    """A log row has arm, kind (query or batch), seconds, cost."""
    query = F.col("kind") == "query"
    return log.groupBy("arm").agg(
        F.avg(F.when(query, F.col("seconds") * 1000)).alias("avg_latency_ms"),
        F.sum(F.when(~query, F.col("seconds")).otherwise(0.0)).alias("batch_seconds"),
        F.sum("cost").alias("total_cost"))


def disagreements(results: DataFrame) -> DataFrame:
    """Cases on which the arms differ, with each arm's outcome and first two
    sources. A case collects one short text per arm."""
    hit = F.col("sources_match")
    outcome = F.concat_ws(":", "arm", F.when(hit, "hit").otherwise("miss"),
                          F.array_join(F.slice(F.coalesce("retrieved_sources", F.array().cast("array<string>")), 1, 2), ";"))
    df = results.groupBy("test_id", "query", "expected_sources").agg(
        F.count_if(hit).alias("n_hit"), F.count("*").alias("n_arms"),
        F.array_sort(F.collect_list(outcome)).alias("outcomes"))
    return df.filter((F.col("n_hit") > 0) & (F.col("n_hit") < F.col("n_arms")))


def disagreement_examples(results: DataFrame, n: int = 5) -> DataFrame:
    """The report's first few disagreements."""
    return disagreements(results).orderBy("test_id").limit(n)


def winner(results: DataFrame) -> DataFrame:
    """Most accurate arm; equal arms by name."""
    df = results.groupBy("arm").agg(F.avg(F.col("sources_match").cast("int")).alias("accuracy"),
                                    F.avg("top_distance").alias("avg_distance"), F.count("*").alias("n_cases"))
    return df.orderBy(F.desc("accuracy"), "arm").limit(1)


def recommendation(results: DataFrame, paid: str, free: str) -> DataFrame:
    """The free arm when the accuracies are within five points, else the better."""
    hit = F.col("sources_match").cast("int") * 100.0
    df = results.agg(F.avg(F.when(F.col("arm") == paid, hit)).alias("paid_accuracy"),
                     F.avg(F.when(F.col("arm") == free, hit)).alias("free_accuracy"))
    gap = F.col("paid_accuracy") - F.col("free_accuracy")
    pick = F.when((gap >= config.ACCURACY_GAP_POINTS), paid).otherwise(free)
    return df.select("paid_accuracy", "free_accuracy", gap.alias("gap_points"), pick.alias("recommended"))


def precision_recall(results: DataFrame, k: int = 3) -> DataFrame:
    """Averages over the cases; recall skips cases that expect nothing."""
    common = F.size(F.array_intersect(F.array_distinct("retrieved_sources"), F.col("expected_sources")))
    common = F.coalesce(common, F.lit(0))
    df = results.select("arm", (common / F.lit(k)).alias("p"),
                        ratio(common, F.nullif(F.size("expected_sources"), F.lit(0))).alias("r"))
    return df.groupBy("arm").agg(F.avg("p").alias("precision_at_k"), F.avg("r").alias("recall_at_k"))


def cohen_kappa(ratings: DataFrame, first: str, second: str) -> DataFrame:
    """Agreement of two raters beyond chance. The ratings shrink to one row per
    pair of grades; the margins are sums over those rows."""
    cells = ratings.groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("agree"))
    rows = cells.groupBy(F.col("a").alias("g")).agg(F.sum("n").alias("ra"))
    cols = cells.groupBy(F.col("b").alias("g")).agg(F.sum("n").alias("rb"))
    cross = rows.join(cols, "g").agg(F.coalesce(F.sum(F.col("ra").cast("double") * F.col("rb")), F.lit(0.0))).scalar()
    po = ratio(F.col("agree"), F.col("total"))
    pe = F.try_divide(F.col("cross"), F.col("total").cast("double") * F.col("total"))
    return total.withColumn("cross", cross).select(
        "total", po.alias("observed"), pe.alias("expected"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


def regressions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cases that changed between two runs of one arm set."""
    a = before.select("test_id", F.col("sources_match").alias("was"))
    b = after.select("test_id", F.col("sources_match").alias("now"))
    was, now = F.coalesce("was", F.lit(False)), F.coalesce("now", F.lit(False))
    change = F.when(was & ~now, "newly_failing").when(~was & now, "newly_passing").otherwise("unchanged")
    return a.join(b, "test_id", "full_outer").select("test_id", was.alias("was"), now.alias("now"), change.alias("change"))
