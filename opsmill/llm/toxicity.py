"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, takes compatible forms off, maps look-alike letters of
other scripts and digits or signs that stand for letters, and parts words by
single blanks. Where a word and its parts have no entry, it is also tried without
accents and with its inner signs as nothing and as letters. Lexicon entries
are word beginnings, and whole words that are shorter or longer than those, with weights
learnt from labelled rows as log odds; the weights found in a text, without those inside
exception phrases (read with and without accents and signs), are normalised
by its length and turned into a probability by a logistic fit.
"""

from __future__ import annotations

import math
import string
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.llm.labels import fitting_labels, held_out
from opsmill.session import materialise

# Rows to fit on: at most this many labelled rows, taken in order of a hash of
# the id. The lexicon's threshold of gain keeps chance entries out, so the
# logistic is fitted on the same rows.
FIT_ROWS = 16_000
SHORTEST, LONGEST = 4, 10  # letters of a word beginning; other words are entries as a whole, with a blank behind
LEAST_ROWS, LEAST_GAIN, LEAST_ODDS = 4, 20.0, 2.0
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pond scum", "sore loser board game")

# Fixed look-alikes: other scripts' letters, then digits and signs, to Latin.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ℓ": "l", "ⅰ": "i", "ｏ": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
# A one may stand for i or l, so both are one letter.
SAME = {"l": "i"}


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {ord(a): b for a, b in LOOK_ALIKES.items()}
    table |= {ord(a): b for a, b in SAME.items()}
    table |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    return table


TABLE = _table()


def fold(text: str | None) -> str:
    """Folded words, each with one blank before it and one at the end."""
    parts = _plain(text or "").lower().translate(TABLE).split()
    return f" {' '.join(parts)} " if parts else ""


def _plain(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


# Signs that stand for letters inside a word, and those that never end one.
INSIDE = str.maketrans({"!": "i", "+": "t"})
ENDS = "".join(c for c in string.punctuation if c not in "+@$")
NO_SIGNS = str.maketrans(dict.fromkeys(c for c in string.punctuation if c not in "@$"))


def _bare(text: str) -> str:
    return text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _masked(chunks: list[str], auto: ahocorasick.Automaton) -> dict[str, float]:
    """Weights of entries that begin a word only if it loses its accents, or its
    inner signs are nothing or letters. Words with a part that has an entry are left to ``match``."""
    out = {}
    for chunk in set(chunks):
        core = chunk.strip(ENDS)
        if not core or core.isascii() and core.isalnum():
            continue
        if any(weight > 0 for _, (_, weight) in auto.iter(fold(core))):
            continue
        bare = _bare(core)
        ways = {fold(w) for w in (bare, bare.translate(NO_SIGNS), bare.translate(INSIDE).translate(NO_SIGNS))}
        best = max((weight for way in ways for end, (size, weight) in auto.iter(way) if end + 1 == size), default=0.0)
        if best > 0:
            out[chunk] = best
    return out


def _excepted(chunks: list[str], auto: ahocorasick.Automaton) -> set[int]:
    """Numbers of the words that lie in an exception phrase once all words have lost
    accents and signs."""
    out: set[int] = set()
    for shown in ([fold(_bare(c).translate(NO_SIGNS)) for c in chunks], [fold(_bare(c)) for c in chunks]):
        stops = list(accumulate(max(len(w) - 1, 0) for w in shown))
        starts = [0, *stops[:-1]]
        for end, (size, weight) in auto.iter(" " + "".join(w[1:] for w in shown)):
            if weight < 0:
                out.update(range(bisect_right(starts, end - size + 1) - 1, bisect_left(starts, end)))
    return out


def entries(text: str | None) -> set[str]:
    """What of a text may become an entry."""
    own = set(fold(text).split())
    return {w[:k] for w in own for k in range(SHORTEST, min(len(w), LONGEST) + 1)} | {f"{w} " for w in own if not SHORTEST <= len(w) <= LONGEST}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per entry: labelled rows with it, by label."""
    tally: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        names = list(tally[0].keys() | tally[1].keys())
        made = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([tally[y][e] for e in names], pa.int64()) for y in (1, 0))],
            names=["entry", "pos", "neg"])
        for t in tally:
            t.clear()
        return made

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = entries(text)
            tally[y].update(seen)
            if len(tally[0]) + len(tally[1]) > 500_000:
                yield out()
    yield out()


def _gain(pos: Column, neg: Column, p: int, n: int) -> Column:
    """Log-likelihood ratio of the entry being more frequent among positives."""
    def part(k, total, share):
        return F.when(k > 0, k * F.log(k / (total * share))).otherwise(0.0)
    share = (pos + neg) / (p + n)
    return F.when(share < 1, 2 * (part(pos, p, share) + part(neg, n, share) + part(p - pos, p, 1 - share) + part(n - neg, n, 1 - share))).otherwise(0.0)


def learn(rows: DataFrame, p: int, n: int) -> dict[str, float]:
    """Entry to weight, from labelled ``rows`` (text, y) of which ``p`` are
    positive and ``n`` negative. An entry must be in LEAST_ROWS positives and
    beat chance by LEAST_GAIN; of nested ones a longer one stays only if it
    weighs clearly more. Their number is bounded by that of the rows."""
    found = rows.select("text", "y").mapInArrow(_counts, "entry string, pos long, neg long")
    found = found.groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log((F.col("neg") + 0.5) / (n + 1))
    found = found.where(F.col("pos") >= LEAST_ROWS).withColumn("weight", odds).where(F.col("weight") >= LEAST_ODDS)
    best = found.where(_gain(F.col("pos"), F.col("neg"), p, n) >= LEAST_GAIN).collect()
    kept: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r.entry), r.entry)):
        shorter = max((kept[r.entry[:k]] for k in range(SHORTEST, len(r.entry)) if r.entry[:k] in kept), default=-math.inf)
        if r.weight > shorter + 0.7:
            kept[r.entry] = float(r.weight)
    return dict(sorted(kept.items(), key=lambda e: (-e[1], e[0])))


def _automaton(lexicon: dict[str, float], exceptions: tuple[str, ...]) -> ahocorasick.Automaton | None:
    auto = ahocorasick.Automaton()
    for entry, weight in lexicon.items():
        auto.add_word(f" {entry}", (len(entry) + 1, weight))
    for phrase in exceptions:
        if key := fold(phrase):
            auto.add_word(key, (len(key), -1.0))
    if not len(auto):
        return None
    auto.make_automaton()
    return auto


def _may_except(text: str, phrases: tuple[str, ...]) -> bool:
    """Whether a folded phrase stands in the text once all words have lost accents and signs."""
    bare = _bare(text)
    return any(p in line for line in (fold(bare), fold(bare.translate(NO_SIGNS))) for p in phrases)


def match(text: str | None, auto: ahocorasick.Automaton | None, phrases: tuple[str, ...] | None = None) -> tuple[int, int, float]:
    """(words, hits, summed weight): the heaviest entry at each word, but none
    that begins inside an exception phrase. ``phrases``: the folded ones of ``auto``."""
    line = fold(text)
    if not line:
        return 0, 0, 0.0
    found: dict[int, float] = {}
    free: list[tuple[int, int]] = []
    if auto is not None:
        for end, (size, weight) in auto.iter(line):
            start = end - size + 1
            if weight < 0:
                free.append((start, end))
            else:
                found[start] = max(found.get(start, 0.0), weight)
    if free:
        found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in free)}
    if auto is None:
        return line.count(" ") - 1, 0, 0.0
    chunks = _plain(text).split()
    masked = _masked(chunks, auto)
    if phrases is None:
        phrases = tuple(key for key, (_, weight) in auto.items() if weight < 0)
    # Words are read one by one only where a phrase is there at all.
    clear = _excepted(chunks, auto) if (found or masked) and _may_except(_plain(text), phrases) else set()
    if clear:
        at, gone = 0, []
        for i, chunk in enumerate(chunks):
            size = max(len(fold(chunk)) - 1, 0)
            if i in clear:
                gone.append((at, at + size))
            at += size
        found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in gone)}
    more = [masked[c] for i, c in enumerate(chunks) if c in masked and i not in clear]
    return line.count(" ") - 1, len(found) + len(more), sum(found.values()) + sum(more)


def measure(docs: DataFrame, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with n_words, n_hits, weight. Null and empty
    texts have zeros."""
    keep = [c for c in docs.columns if c not in (text, "n_words", "n_hits", "weight")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(lexicon, exceptions)
        phrases = tuple(filter(None, map(fold, exceptions)))
        for batch in batches:
            at = {f.name: i for i, f in enumerate(batch.schema)}
            made = [match(t, auto, phrases) for t in batch.column(at[text]).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at[c]) for c in keep), *(pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64())))],
                names=[*keep, "n_words", "n_hits", "weight"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return docs.select(*[F.col(f"`{c}`") for c in (*keep, text)]).mapInArrow(run, f"{fields}, n_words long, n_hits long, weight double")


def _shape(weight, n_words):
    """What the logistic sees: the weight, and the weight per hundred words."""
    return F.log1p(weight), F.log1p(100 * weight / F.greatest(n_words, F.lit(1)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Coefficients by Newton steps with a small ridge, the constant first."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc: str = "doc_id", text: str = "text",
                    threshold: float = 0.3, exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_hits.

    Fitted on at most FIT_ROWS labelled rows that are not held out; their ids
    are sent to the tasks, which that number bounds. All rows are scored, null
    and empty texts too. Without labels of both kinds every score is the share
    of label 1, or 0. Repeated rows score alike.
    """
    rows = docs.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{text}`").alias("text"))
    chosen = fitting_labels(labels, label).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
    fitting = materialise(rows.join(F.broadcast(chosen), "id").select("text", "y"), "fitting")
    sizes = {r.y: r["count"] for r in fitting.groupBy("y").count().collect()}
    p, n = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = learn(fitting, p, n) if p and n else {}
    prior = p / max(1, p + n)
    shown = measure(fitting.select("y", "text"), lexicon, exceptions)
    seen = np.array([tuple(r) for r in shown.select("y", *_shape(F.col("weight"), F.col("n_words"))).collect()], float).reshape(-1, 3)
    out = measure(rows, lexicon, exceptions)
    if lexicon and 0 < seen[:, 0].sum() < len(seen):
        b = [float(v) for v in _logistic(seen[:, 1:], seen[:, 0])]
        one, two = _shape(F.col("weight"), F.col("n_words"))
        score = 1 / (1 + F.exp(-(b[0] + b[1] * one + b[2] * two)))
    else:
        score = F.lit(float(prior))
    return out.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), "n_hits")
