"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has its own covariance, shrunk towards the diagonal of the pooled
one. The score is the logistic of the difference of the two log densities, and
Mahalanobis distances come from Cholesky factors computed once. Counts, means
and covariances are aggregates over all labelled rows, so fitting sends a few
numbers to the driver whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.llm.labels import fitting_labels, held_out
from opsmill.session import materialise

SHRINK, RIDGE, STEEPEST = 0.2, 1e-3, 30.0
FEATURES = ("words", "symbols", "bangs", "upper", "digits", "word_length", "variety", "copied_lines", "stops", "bars", "line_length")


def statistics(text: Column) -> Column:
    """An array of transformed statistics, in the order of ``FEATURES``. Shares
    go through square roots and counts through logarithms, which makes them
    closer to normal; a text without words has zeros."""

    def count(t, pattern, gate=None):
        n = F.regexp_count(t, F.lit(pattern))
        return n if gate is None else F.when(t.rlike(gate), n).otherwise(0)

    def let(value, use):
        return F.transform(F.array(value), use)[0]

    def of(t, w, lines):
        n_words = F.greatest(F.size(w), F.lit(1)).cast("double")
        n_chars = F.greatest(F.length(t), F.lit(1)).cast("double")
        n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
        return F.array(
            F.log1p(F.size(w)),
            F.sqrt(count(t, "[#*$%&<>]", "[#*$%&<>]") / n_chars),
            F.sqrt(count(t, "!", "!") / n_words),
            F.sqrt(count(t, "\\p{Lu}") / n_chars),
            F.sqrt(count(t, "[0-9]", "[0-9]") / n_chars),
            F.log1p(F.length(F.array_join(w, "")) / n_words),
            F.log1p(F.size(F.array_distinct(w))) / F.greatest(F.log1p(F.size(w)), F.lit(1.0)),
            F.sqrt((F.size(lines) - F.size(F.array_distinct(lines))) / n_lines),
            F.sqrt(count(t, "[.,;:?]") / n_words),
            F.sqrt(count(t, "\\|", "\\|") / n_words),
            F.log1p(n_words / n_lines))

    body = F.coalesce(text, F.lit(""))
    made = let(body, lambda t: let(F.array_remove(F.split(t, "[\\x20\\x09-\\x0D]+"), ""), lambda w: let(
        F.filter(F.split(t, "\n"), lambda x: x != ""), lambda lines: of(t, w, lines))))
    return made.cast("array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): mean, inverse of the Cholesky factor, and log density
    at the mean plus log prior. ``prior`` alone scores where a class is missing."""

    means: np.ndarray
    factors: np.ndarray
    levels: np.ndarray
    prior: float
    fitted: bool = True

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        logs = [self.levels[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(logs[1] - logs[0], -STEEPEST, STEEPEST)))


def fit(rows: DataFrame, shrink: float = SHRINK) -> Discriminant:
    """From all of ``rows`` (x array<double>, y 0 or 1)."""
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    found = {r.y: r for r in rows.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(x[i]).alias(f"m{i}") for i in range(d)],
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]).collect()}
    total = sum(r.n for r in found.values())
    if any(c not in found or found[c].n < 2 for c in (0, 1)):
        prior = (found[1].n + 1) / (total + 2) if 1 in found else 1 / (total + 2)
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), prior, False)
    means = np.array([[found[c][f"m{i}"] for i in range(d)] for c in (0, 1)])
    own = np.array([[[found[c][f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)] for c in (0, 1)])
    share = np.array([found[c].n / total for c in (0, 1)])
    pooled = np.diag(np.tensordot(share, own, 1)) + RIDGE
    factors, levels = [], []
    for c in (0, 1):
        cov = (1 - shrink) * own[c] + np.diag(shrink * pooled)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        levels.append(np.log(share[c]) - np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(levels), share[1])


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", text: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Fitted on labelled rows that are not held out; scored are all rows, null
    and empty texts too (their statistics are zeros). With fewer than two rows
    of a class every score is the share of label 1. Repeated rows score alike.
    Statistics are computed once and written; texts are read once.
    """
    rows = docs.select(F.col(f"`{doc}`").alias("id"), statistics(F.col(f"`{text}`")).alias("x"))
    rows = materialise(rows, "statistics")
    model = fit(rows.join(fitting_labels(labels, label), "id"))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    out = rows.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), score("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
