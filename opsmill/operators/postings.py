"""Keyword and hybrid scores of many queries against a part of a corpus.

A part is turned round: every term leads to the rows that hold it. What the frequent terms of a query
can add to a score is bounded, so rows are found by its other terms, and only where those
leave a row a chance to reach the k-th best score so far are the frequent ones looked up. Sums in single
precision choose rows with a margin above their error; what is handed on is summed in
double precision, over the terms of a query in their order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DIGITS = 6
HALF = 0.51 * 10.0 ** -DIGITS
# A part of the corpus that is searched at once, in entries (row and term) and bytes.
ENTRIES_PER_PART = 4_000_000
BYTES_PER_PART = 256_000_000
# Terms held by at least one row in FREQUENT are frequent, the first FREQUENT_TERMS of them; they have a column of weights.
FREQUENT = 32
FREQUENT_TERMS = 256
# Share of the score to beat that frequent terms may make up without being followed. Any share gives the same rows.
SHARE = 0.6
# Hybrid: so that about one row in FEW + 1 is near enough to count without its other terms.
FEW = 127
QUERIES_PER_STEP = 512
# Cells of distances, entries, and pairs to be scored, at a time.
CELLS_PER_STEP = 2_000_000
ENTRIES_PER_STEP = 1_000_000
PAIRS_PER_STEP = 50_000


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


@dataclass
class Asked:
    """Queries: ``terms`` (distinct, the frequent first) with ``factors``, and for hybrid scores
    ``vec`` and the score ranges ``lo``, ``hi`` and ``top``. ``bars`` is the k-th best score so far."""
    names: pa.Array
    vocabulary: pa.Array
    codes: np.ndarray
    factors: np.ndarray
    bounds: np.ndarray
    vecs: np.ndarray | None
    ranges: list
    bars: np.ndarray

    @staticmethod
    def packed(table: pa.Table, bars: np.ndarray) -> tuple:
        """What is sent to the tasks."""
        lists = table.column("terms").combine_chunks()
        flat = lists.flatten()
        vocabulary = pc.unique(flat)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return (table.column("query_id").combine_chunks(), vocabulary, pc.index_in(flat, vocabulary).to_numpy(zero_copy_only=False).astype(np.int32),
                table.column("factors").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]),
                matrix(table.column("vec")) if "vec" in table.column_names else None,
                [table.column(c).to_numpy() for c in ("lo", "hi", "top") if c in table.column_names], bars)

    def __len__(self) -> int:
        return len(self.bars)


@dataclass
class Rows:
    """Corpus rows with the places of their terms in a vocabulary; ``doc`` is the row of an entry."""
    ids: pa.ChunkedArray
    code: np.ndarray
    doc: np.ndarray
    weight: np.ndarray
    vecs: np.ndarray | None

    def __len__(self) -> int:
        return len(self.ids)


def _known(table: pa.Table, vocabulary: pa.Array, key: str) -> Rows:
    lists = table.column("terms").combine_chunks()
    code = pc.index_in(lists.flatten(), vocabulary)
    known = pc.is_valid(code).to_numpy(zero_copy_only=False)
    weight = table.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)[known]
    return Rows(table.column(key), code.drop_null().to_numpy(), lists.value_parent_indices().to_numpy()[known].astype(np.int32), weight,
                matrix(table.column("vec")) if "vec" in table.column_names else None)


def parts(tables: Iterator[pa.Table], vocabulary: pa.Array, key: str) -> Iterator[Rows]:
    """The rows of a task, some at a time, without terms that no query has."""
    held, entries, size = [], 0, 0

    def joined() -> Rows:
        starts = np.cumsum([0] + [len(r) for r in held[:-1]])
        return Rows(pa.chunked_array([c for r in held for c in r.ids.chunks], held[0].ids.type), np.concatenate([r.code for r in held]),
                    np.concatenate([r.doc + np.int32(s) for r, s in zip(held, starts, strict=True)]), np.concatenate([r.weight for r in held]),
                    None if held[0].vecs is None else np.concatenate([r.vecs for r in held]))

    for table in tables:
        if table.num_rows:
            held.append(_known(table, vocabulary, key))
            entries += len(held[-1].code)
            size += 0 if held[-1].vecs is None else held[-1].vecs.nbytes
        if entries >= ENTRIES_PER_PART or size >= BYTES_PER_PART:
            rows = joined()
            held, entries, size = [], 0, 0
            yield rows
            del rows
    if held:
        yield joined()


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of every number."""
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Part:
    """Some corpus rows, by term. Of rows that score alike for every query only the ``k`` of
    least id are held, since ties go by id."""

    def __init__(self, rows: Rows, n_terms: int, k: int):
        keep = self._without_copies(rows, k)
        code, doc, weight = rows.code, rows.doc, rows.weight
        self.ids, self.vecs = rows.ids.combine_chunks(), rows.vecs
        if len(keep) < len(rows):
            place = np.full(len(rows), -1, np.int32)
            place[keep] = np.arange(len(keep))
            held = place[doc] >= 0
            code, doc, weight = code[held], place[doc[held]], weight[held]
            self.ids, self.vecs = self.ids.take(pa.array(keep)), None if self.vecs is None else self.vecs[keep]
        self.n = len(keep)
        self.counts = np.bincount(code, minlength=n_terms)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        order = code.astype(np.int64)
        order <<= 32
        order += np.arange(len(code))
        order.sort()
        order &= 0xFFFFFFFF
        self.docs, self.weights = doc[order].astype(np.int64), weight[order]
        del order, code, doc, weight
        self.entries = np.repeat(np.arange(n_terms) * self.n, self.counts)
        self.entries += self.docs
        self.small = self.weights.astype(np.float32)
        self.most = np.zeros(n_terms)
        some = np.flatnonzero(self.counts)
        if len(some):
            self.most[some] = np.maximum.reduceat(self.weights, self.starts[some])
        often = np.argsort(-self.counts, kind="stable")[:FREQUENT_TERMS]
        often = often[self.counts[often] * FREQUENT >= max(self.n, 1)]
        self.place = np.full(n_terms, -1)
        self.place[often] = np.arange(len(often))
        self.columns = np.zeros((len(often), self.n), np.float32)
        for column, term in zip(self.columns, often, strict=True):
            at = slice(self.starts[term], self.starts[term + 1])
            column[self.docs[at]] = self.small[at]

    @staticmethod
    def _without_copies(rows: Rows, k: int) -> np.ndarray:
        """Rows of one part that have equal weights of all terms and equal vectors are known by 128 bits."""
        if len(rows) <= k:
            return np.arange(len(rows))
        marks = np.zeros((2, len(rows)), np.uint64)
        for mark, salt in zip(marks, (0x243F6A8885A308D3, 0x13198A2E03707344), strict=True):
            for start in range(0, len(rows.code), ENTRIES_PER_STEP):
                some = slice(start, start + ENTRIES_PER_STEP)
                np.add.at(mark, rows.doc[some].astype(np.int64), _mixed(_mixed(rows.code[some].astype(np.uint64), salt) ^ rows.weight[some].view(np.uint64), salt))
            for i in range(0 if rows.vecs is None else rows.vecs.shape[1]):
                mark[:] = _mixed(mark ^ np.ascontiguousarray(rows.vecs[:, i]).view(np.uint64), salt + i)
        order = np.lexsort((rows.ids.to_numpy(), marks[1], marks[0]))
        first, second = marks[0][order], marks[1][order]
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        starts = np.flatnonzero(new)
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        return np.sort(order[nth < k])

    def keyword_scores(self, asked: Asked, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of query ``q[i]`` and row ``at[i]``: the factors of the query times the weights of the row."""
        sizes = asked.bounds[q + 1] - asked.bounds[q]
        pair = np.repeat(np.arange(len(q)), sizes)
        cell = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + asked.bounds[q][pair]
        if not len(self.entries):
            return np.zeros(len(q))
        wanted = asked.codes[cell].astype(np.int64) * self.n + at[pair]
        found = np.minimum(np.searchsorted(self.entries, wanted), len(self.entries) - 1)
        value = np.where(self.entries[found] == wanted, asked.factors[cell] * self.weights[found], 0.0)
        return np.bincount(pair, weights=value, minlength=len(q))

    def distances(self, asked: Asked, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        mine, theirs = self.vecs[at], asked.vecs[q]
        d = (mine * mine).sum(1) + (theirs * theirs).sum(1) - 2.0 * np.einsum("ij,ij->i", mine, theirs)
        return np.maximum(d, 0.0)


def _fused(part: Part, asked: Asked, alpha: float, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    dense = np.round(part.distances(asked, q, at), DIGITS)
    sparse = np.round(part.keyword_scores(asked, q, at), DIGITS)
    lo, hi, top = (r[q] for r in asked.ranges)
    near = np.where(hi > lo, (hi - dense) / np.where(hi > lo, hi - lo, 1.0), 1.0)
    words = np.where(top > 0, sparse / np.where(top > 0, top, 1.0), 0.0)
    return alpha * near + (1 - alpha) * words


class Near:
    """alpha * nearness of all rows of a part for some queries, and how far that may be off."""

    def __init__(self, part: Part, asked: Asked, alpha: float):
        self.asked, self.alpha, mine = asked, alpha, part.vecs
        own, self.other = (mine * mine).sum(1), (asked.vecs * asked.vecs).sum(1)
        size = np.nanmax(own, initial=0.0) + np.nanmax(self.other, initial=0.0) + np.nanmax(np.abs(asked.ranges[1]), initial=0.0)
        self.kind, error = (np.float32, 1e-7) if size < 1e12 else (np.float64, 1e-14)
        self.error, self.rounding = size * error * (mine.shape[1] + 16) + HALF, 2 * alpha * error
        self.right = np.vstack([mine.T, own, np.ones(len(mine))]).astype(self.kind)

    def of(self, at: slice) -> tuple[np.ndarray, np.ndarray]:
        lo, hi, _ = (r[at] for r in self.asked.ranges)
        scale = np.where(hi > lo, self.alpha / np.where(hi > lo, hi - lo, 1.0), 0.0)
        left = [2.0 * scale[:, None] * self.asked.vecs[at], -scale, np.where(hi > lo, scale * (hi - self.other[at]), self.alpha)]
        return np.column_stack(left).astype(self.kind) @ self.right, scale * self.error + self.rounding


def search(part: Part, asked: Asked, k: int, alpha: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries, rows of the part and rounded scores, among them all that are among the ``k`` best
    of their query in this part and reach its bar. ``alpha`` is None for keyword scores, of which those above zero count."""
    step = QUERIES_PER_STEP if alpha is None else max(1, min(QUERIES_PER_STEP, CELLS_PER_STEP // part.n))
    nearness = None if alpha is None else Near(part, asked, alpha)
    found_q, found_at, waiting = [], [], 0

    def scored():
        q, at = np.concatenate(found_q), np.concatenate(found_at)
        for lo in range(0, len(q), PAIRS_PER_STEP):
            some = slice(lo, lo + PAIRS_PER_STEP)
            value = part.keyword_scores(asked, q[some], at[some]) if alpha is None else _fused(part, asked, alpha, q[some], at[some])
            value = np.round(value, DIGITS)
            keep = np.isfinite(value) & (value >= asked.bars[q[some]])
            if alpha is None:
                keep &= value > 0
            yield q[some][keep], at[some][keep], value[keep]

    for lo in range(0, len(asked), step):
        for q, at in _chosen(part, asked, k, alpha, nearness, lo, min(lo + step, len(asked))):
            found_q.append(np.full(len(at), q))
            found_at.append(at)
            waiting += len(at)
            if waiting >= PAIRS_PER_STEP:
                yield from scored()
                found_q, found_at, waiting = [], [], 0
    if waiting:
        yield from scored()


def _chosen(part: Part, asked: Asked, k: int, alpha: float | None, nearness: Near | None, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of every query the rows that may count."""
    n, bounds = part.n, asked.bounds[lo:hi + 1] - asked.bounds[lo]
    cells = slice(asked.bounds[lo], asked.bounds[hi])
    owner = np.repeat(np.arange(hi - lo), np.diff(bounds))
    codes, factors, bars = asked.codes[cells], asked.factors[cells], asked.bars[lo:hi]
    room = bars * SHARE
    if alpha is None:
        near, off = None, 0.0
    else:
        near, off = nearness.of(slice(lo, hi))
        top = asked.ranges[2][lo:hi]
        factors = factors * np.where(top > 0, (1 - alpha) / np.where(top > 0, top, 1.0), 0.0)[owner]
        # Frequent terms may make up what all but few of the rows lack.
        some = near[:, ::max(1, n // 512)]
        nth = some.shape[1] * FEW // (FEW + 1)
        room = bars - np.partition(some, nth, axis=1)[:, nth]
    counts, column = part.counts[codes], part.place[codes]
    most = factors * part.most[codes]
    often = column >= 0
    run = np.concatenate([[0.0], np.cumsum(np.where(often, most, 0.0))])
    skipped = often & (run[1:] - run[bounds[:-1]][owner] <= room[owner])
    total = np.bincount(owner, weights=most, minlength=hi - lo)
    rest = np.bincount(owner, weights=np.where(skipped, most, 0.0), minlength=hi - lo)
    slack = off + (total + (alpha or 0.0)) * (np.diff(bounds) + 4) * 1.2e-7 + 2 * HALF
    live = ~skipped & (counts > 0) & (factors != 0)
    first, last = part.starts[codes[live]].tolist(), part.starts[codes[live] + 1].tolist()
    by, places = factors[live].tolist(), column[live].tolist()
    ends = np.searchsorted(owner[live], np.arange(hi - lo + 1)).tolist()
    late, late_ends = np.flatnonzero(skipped), np.searchsorted(owner[skipped], np.arange(hi - lo + 1)).tolist()
    late_by, late_most, late_place = factors[late].tolist(), most[late].tolist(), column[late].tolist()
    if alpha is None:
        tries = np.flatnonzero((np.diff(ends) > 0) & (total + slack >= bars)).tolist()
    else:
        tries = range(hi - lo)
    # Python's numbers, since NumPy's would make the sums double.
    bars, rest, slack = bars.tolist(), rest.tolist(), (slack + np.zeros(hi - lo)).tolist()
    docs, small, columns = part.docs, part.small, part.columns
    score, product, above = np.zeros(n, np.float32), np.empty(n, np.float32), np.zeros(-(-n // 8) * 8, bool)
    for q in tries:
        if alpha is None:
            score.fill(0.0)
        else:
            score = near[q]
        for i in range(ends[q], ends[q + 1]):
            a, b = first[i], last[i]
            if places[i] >= 0 and (b - a) * 16 > n:
                score += np.multiply(columns[places[i]], by[i], out=product)
            elif b - a > 500:
                np.add.at(score, docs[a:b], by[i] * small[a:b])
            else:
                score[docs[a:b]] += by[i] * small[a:b]
        bar, left, margin = bars[q], rest[q], slack[q]
        if bar == -math.inf:
            need = float(np.partition(score, n - k)[n - k]) - margin if n > k else -math.inf
        else:
            need = bar - left - margin
        if alpha is None:
            need = max(need, 1e-30)
        if score.max() < need:
            continue
        # Eight rows at a time, most of which have none above.
        np.greater_equal(score, need, out=above[:n])
        some = np.flatnonzero(above.view(np.int64))
        inner, eighth = np.nonzero(above.reshape(-1, 8)[some])
        at = some[inner] * 8 + eighth
        if bar != -math.inf and len(at) > k:
            value = score[at]
            for i in range(late_ends[q + 1] - 1, late_ends[q] - 1, -1):
                value += late_by[i] * columns[late_place[i]][at]
                left -= late_most[i]
                keep = value >= bar - left - margin
                at, value = at[keep], value[keep]
                if len(at) <= k:
                    break
        if len(at):
            yield lo + q, at
