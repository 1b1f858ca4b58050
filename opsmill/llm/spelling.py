"""Spelling variants: words of one edit's distance, by dynamic programming over sorted lists.

Two words whose longer one has M letters and that differ by one edit agree, beside
it, in M - 1 places. So they share the first or the last M // 2 letters, and all
near words meet in groups of one such half. In a group the words stand sorted and are
scanned like one long list: a row of the edit matrix (three cells, as more than
one edit does not count) belongs to a prefix, and all neighbours whose common
prefix (LCP) reaches so far reuse it. Where every cell of a row exceeds one edit,
the whole range of words with that prefix is skipped.

The scan goes letter by letter for all words of a piece of the list at once. A
group of over ``GROUP_WORDS`` words is parted by the halves of what its words do
not yet share, again and again: in the end all but one letter is shared, so no
group is larger than the alphabet and no task holds an unbounded one. Every pair is
found in one group only, the one that the place of its first difference leads to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"
GROUP_WORDS = 20_000  # beyond it a group is parted
PIECE_WORDS = 20_000  # scanned at a time
GROUP = ["m", "a", "b", "u", "part"]


def runs(doc: Column, text: Column) -> Column:
    """Lower-cased runs of letters, one in 31 (by crc32 of id and run) without one of its letters."""
    body = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)

    def spelt(run: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)

    return F.transform(F.regexp_extract_all(body, F.lit(RUN), F.lit(0)), spelt)


def vocabulary(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: int = 7, times: int = 2) -> DataFrame:
    """(word, n): distinct words of at least ``least`` letters and ``times`` occurrences.
    Null texts have none; rows without id count as rows of an empty id; repeated rows
    count each time."""
    found = docs.select(F.explode(runs(F.col(f"`{doc}`"), F.col(f"`{text}`"))).alias("word")).where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


def _group(m: Column, a: Column, b: Column, u: Column) -> Column:
    """The group of a word: shared are the first ``a`` and last ``b`` letters, and the
    first difference lies before place ``u``."""
    return F.struct(m.cast("int").alias("m"), a.cast("int").alias("a"), b.cast("int").alias("b"), u.cast("int").alias("u"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, g) with the letters that the group shares."""
    rows = rows.select("word", "n", "g.*")
    return rows.withColumn("part", F.concat(F.substring("word", F.lit(1), F.col("a")), F.expr("right(word, b)")))


def _halves(words: DataFrame) -> DataFrame:
    """Each word under its halves, as the longer and as the shorter one of a pair."""
    size = F.length("word")
    return _keyed(words.select("word", "n", F.explode(F.array(*[
        g for m in (size, size + 1) for half in (F.floor(m / 2),)
        for g in (_group(m, half, F.lit(0), m), _group(m, F.lit(0), half, half))])).alias("g")))


def _parted(rows: DataFrame) -> DataFrame:
    """Words of large groups under the halves of what they do not yet share."""
    a, b, u = F.col("a"), F.col("b"), F.col("u")
    half = F.floor((F.col("m") - a - b) / 2)
    both = F.array(F.when(a + half < u, _group(F.col("m"), a + half, b, u)), _group(F.col("m"), a, b + half, F.least(u, a + half)))
    return _keyed(rows.select("word", "n", F.explode(F.array_compact(both)).alias("g")))


def groups(words: DataFrame, most: int = GROUP_WORDS) -> DataFrame:
    """(word, n, group columns) such that each near pair shares exactly one group
    that its first difference fits, and no group that can be parted has over ``most`` words."""
    open_, done = _halves(words), []
    while True:
        sizes = open_.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size"))
        large = materialise(sizes.where((F.col("size") > most) & (F.col("m") - F.col("a") - F.col("b") > 1)).select(*GROUP), "large")
        if large.isEmpty():
            done.append(open_)
            break
        done.append(open_.join(large, GROUP, "left_anti"))
        open_ = materialise(_parted(open_.join(large, GROUP, "left_semi")), "parted")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _children(starts: np.ndarray, nodes: np.ndarray, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of the list, the ranges of one letter more: which range each
    comes from, and its number."""
    first = np.searchsorted(deeper, starts[nodes])
    last = np.searchsorted(deeper, np.append(starts, np.iinfo(np.int64).max)[nodes + 1])
    sizes = last - first
    ends = np.cumsum(sizes)
    return np.repeat(np.arange(len(nodes)), sizes), np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)


def near_pairs(words: list[str], new: np.ndarray, m: int, a: int, u: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (x, y), both ways, of words one edit apart within their group. ``words`` are
    sorted within groups, which begin where ``new`` holds, have ``m`` or ``m - 1``
    letters and share the first ``a``; the first difference lies before ``u``, and one
    word of a pair has ``m`` letters."""
    n = len(words)
    letters = np.zeros((n, m + 2), np.uint32)
    letters[:, :m] = np.array(words, dtype=f"U{m}").view(np.uint32).reshape(n, m)
    size = np.where(letters[:, m - 1] == 0, m - 1, m)
    lcp = np.full(n, -1)
    if n > 1:
        lcp[1:] = np.where(new[1:], -1, (letters[1:] != letters[:-1]).argmax(axis=1))
    starts = np.flatnonzero(lcp < a if a else lcp < 0)  # at depth a a range is a group
    # Groups of one word have no pair.
    lone = np.diff(np.append(starts, n)) == 1
    node = np.searchsorted(starts, np.arange(n), side="right") - 1
    ask = np.flatnonzero(~lone[node])
    node = node[ask]
    # Cells of the row of depth k: edits against the first k - 1, k and k + 1 letters asked for.
    low, mid, high = (np.full(len(ask), v, np.int8) for v in (1 if a else 2, 0, 1))
    out_x, out_y = [], []
    for k in range(a, m):
        if not len(ask):
            break
        if k == m - 1:  # words that end here
            y = starts[node]
            hit = (size[y] == k) & (size[ask] == m) & (high == 1)
            out_x.append(ask[hit])
            out_y.append(y[hit])
        deeper = np.flatnonzero(lcp < k + 1)
        of, child = _children(starts, node, deeper)
        ask, low, mid, high = ask[of], low[of], mid[of], high[of]
        letter = letters[deeper[child], k]
        there = letter != 0
        if not there.all():
            ask, low, mid, high, letter, child = (v[there] for v in (ask, low, mid, high, letter, child))
        e0 = np.minimum(low + (letter != letters[ask, k - 1]), mid + 1) if k else np.minimum(mid + 1, 2)
        e1 = np.minimum(np.minimum(mid + (letter != letters[ask, k]), high + 1), e0 + 1)
        e1 = np.where(k + 1 <= size[ask], e1, 2)
        e2 = np.where(k + 2 <= size[ask], np.minimum(high + (letter != letters[ask, k + 1]), e1 + 1), 2)
        # Skipped: ranges beyond one edit, and those equal up to where a difference is due.
        good = np.minimum(np.minimum(e0, e1), e2) <= 1
        if k + 1 >= u:
            good &= e1 > 0
        ask, node, low, mid, high = ask[good], child[good], *(np.minimum(v[good], 2).astype(np.int8) for v in (e0, e1, e2))
        starts = deeper
    if len(ask):
        y = starts[node]
        hit = np.where(size[ask] == m, mid, low) == 1
        out_x.append(ask[hit])
        out_y.append(y[hit])
    if not out_x:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_x), np.concatenate(out_y)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word with near words in a group: how many, and the most frequent one.
    Rows come sorted by group and word; whole groups are scanned, some at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= PIECE_WORDS:
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.flatnonzero(_heads(table))[-1])  # the last group may go on
            if cut:
                yield from _scan_piece(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            count = table.num_rows - cut
    if held:
        yield from _scan_piece(pa.Table.from_batches(held).combine_chunks())


def _heads(table: pa.Table) -> np.ndarray:
    """True where a group begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in GROUP:
        v = table[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


def _scan_piece(table: pa.Table) -> Iterator[pa.RecordBatch]:
    new = _heads(table)
    n = table["n"].to_numpy()
    words = np.array(table["word"].to_pylist(), dtype=object)
    shape = np.stack([table[c].to_numpy() for c in ("m", "a", "b", "u")])
    edges = np.append(np.flatnonzero(np.append(True, (shape[:, 1:] != shape[:, :-1]).any(axis=0))), table.num_rows)
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
        m, a, _, u = shape[:, start].tolist()
        x, y = near_pairs(words[start:stop].tolist(), new[start:stop], m, a, u)
        if not len(x):
            continue
        x, y = x + start, y + start
        order = np.lexsort((y, -n[y], x))
        x, y = x[order], y[order]
        at = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(words[x[at]].tolist(), pa.string()), pa.array(np.diff(np.append(at, len(x)))), pa.array(n[y[at]]), pa.array(words[y[at]].tolist(), pa.string())],
            names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, most: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for words (word, n) that have near ones: how many, and
    the most frequent of them (ties: the smallest)."""
    rows = groups(words, most).repartition(*GROUP).sortWithinPartitions(*GROUP, "word")
    found = rows.select(*GROUP, "word", "n").mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for forms (word, form): forms followed to the last. A form is
    many times as frequent as its word, so chains are short, and each round doubles the way."""
    up = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        made = materialise(up.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        up = made.select("word", "root")
        if made.where("moved").isEmpty():
            return up


def variants(docs: DataFrame, doc: str = "doc_id", text: str = "text", ratio: int = 10) -> DataFrame:
    """One row per word of the vocabulary: word, form (its most frequent near word, if that
    occurs at least ``ratio`` times as often; else null), root (forms followed to the last), n,
    n_near and form_n. Empty tables, null and empty texts have no words."""
    words = materialise(vocabulary(docs, doc, text), "vocabulary")
    rows = words.join(near_words(words), "word", "left")
    takes = F.col("best_n") >= ratio * F.col("n")
    rows = materialise(rows.select(
        "word", F.when(takes, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best_n")).alias("form_n")), "variants")
    return rows.join(roots(rows.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
