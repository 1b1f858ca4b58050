"""Language-model scores by Katz backoff over word pairs.

A pair's count is lowered by Good and Turing's estimate: small counts by the counts of
counts themselves, others by their log-linear trend, so every count gives something up.
What a context gives up goes to the words never seen after it, in proportion to their own
(lowered) share; the backoff weight is this mass over the share of exactly those words,
so the probabilities of all words and of one unknown word add up to one.

    p(w | v) = n*(v w) / n(v)            if the pair was seen
             = backoff(v) * p(w)         if only the context was seen
             = p(w)                      else, where p(w) = n*(w) / N, or what all words gave up

Counts are kept in tables parted by the hash of the pair's second word, a part to a task
(words, pairs, contexts; see ``Model``). One shuffle takes every token to the part of its pair,
packed by block of texts and part: there the pair is counted and the token is looked
up, and per text the sums go back to its block. n(v) is known where v itself is counted, so
log n(v) is subtracted there, on behalf of the next token. Discounts are known only when all is
counted, so a text's sums keep the tokens of each small count apart. Tokens whose pair
was never seen ask the table of contexts for the backoff weight.

A word that fills a good part of a part is dealt to several by its contexts. A pair that
does is counted beforehand (both its words are such words) and settled in its text's block:
it never travels. So no task holds more than the blocks and parts given below.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.llm import words
from opsmill.session import materialise

SMALL = 5  # counts up to it are lowered by the counts of counts themselves
BLOCK_TOKENS = 2_000_000  # of texts that are packed together
READ_BYTES = 1 << 20  # of text tokenised at a time
PART_TOKENS = 2_500_000  # of one part of the tables
SLICES, AT_ONCE = 8, 2  # a part's contexts are counted in slices of their hashes, some in one reading
HOT = 1_000_000  # occurrences from which a word or pair is treated apart
START, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
PIECE, TEXTS, SUMS, PAIRS, UNSEEN, COUNTS = range(6)  # kinds of rows


# --- discounts ----------------------------------------------------------------


@dataclass(frozen=True)
class Discount:
    """Lowered counts: ``small[r]`` for r up to SMALL, r * (1 + 1 / r) ** power beyond."""

    small: tuple[float, ...]
    power: float

    def lowered(self, r: np.ndarray) -> np.ndarray:
        r = np.asarray(r, np.float64)
        trend = r * (1 + 1 / np.maximum(r, 1)) ** self.power
        return np.where(r <= SMALL, np.array(self.small)[np.minimum(r, SMALL).astype(np.int64)], trend)


def good_turing(n: list[int]) -> Discount:
    """From counts of counts: n[r] things were seen r times, r from 1 to SMALL + 1. Where
    Turing's estimate has no basis or lowers nothing, the trend counts. Its slope is
    held at -1.1 at most, so that it always lowers."""
    at = [r for r in range(1, SMALL + 2) if n[r] > 0]
    slope = -2.0
    if len(at) > 1:
        x, y = np.log(at), np.log([n[r] for r in at])
        slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
    power = min(slope, -1.1) + 1
    small = [0.0]
    for r in range(1, SMALL + 1):
        turing = (r + 1) * n[r + 1] / n[r] if n[r] else 0.0
        small.append(turing if 0 < turing < r else r * (1 + 1 / r) ** power)
    return Discount(tuple(small), power)


# --- texts as blocks of tokens ------------------------------------------------


class _Block:
    """Tokens of some texts: words and one end for each."""

    def __init__(self, parts: list):
        self.ids = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        self.learn = np.concatenate([p[1] for p in parts])
        counts = np.concatenate([p[3] for p in parts])
        self.sizes = counts + 1
        ends = np.cumsum(self.sizes)
        self.word = np.full(int(ends[-1]), END, np.uint64)
        inside = np.ones(len(self.word), bool)
        inside[ends - 1] = False
        self.word[inside] = np.concatenate([p[2] for p in parts])
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[ends - self.sizes] = START
        self.text = np.repeat(np.arange(len(counts), dtype=np.int32), self.sizes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    parts, size = [], 0
    for batch in words.chunks(batches, most=READ_BYTES):
        at = {f.name: i for i, f in enumerate(batch.schema)}
        own = words.Words(batch.column(at["text"]), lower=True)
        learn = ~np.asarray(batch.column(at["held_out"])).astype(bool)
        parts.append((batch.column(at["id"]), learn, own.hashes(), own.counts))
        size += len(own) + batch.num_rows
        if size >= BLOCK_TOKENS:
            block = _Block(parts)
            parts, size = [], 0
            yield block
    if parts:
        yield _Block(parts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        word, n = np.unique(block.word[block.learn[block.text]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])


def _count_hot(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of hot words (the start counts as one)."""
    for block in _blocks(batches):
        some = block.learn[block.text] & _within(hot, block.word)[1] & _within(hot, block.context)[1]
        pair, n = np.unique(np.stack([block.context[some], block.word[some]]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1].view(np.int64)), pa.array(n)], names=["context", "word", "n"])


def _within(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in the sorted ``table``, and which are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return words.mix(context * np.uint64(0x9E3779B97F4A7C15) + words.mix(word))


# --- packed rows ----------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as zstd bytes, first bytes of all values first: high bytes are much alike."""
    raw = np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(
        np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(packed: bytes, *kinds) -> list[np.ndarray]:
    raw = pa.decompress(packed[8:], int(np.frombuffer(packed[:8], np.int64)[0]), "zstd", asbytes=True)
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), map(np.dtype, kinds)):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _steps(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Differences of values that rise from each head on, whose own value stays."""
    out = np.diff(values, prepend=values[:1])
    out[heads] = values[heads]
    return out


def _unstep(steps: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps, dtype=np.int64)
    return total - np.repeat(total[heads] - steps[heads], sizes)


ROW = "part int, kind int, block long, packed binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, block, packed = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array(packed, pa.binary())],
        names=["part", "kind", "block", "packed"])


SUM_KINDS = (np.uint32, np.uint32, np.float64, np.float64, np.float64, *[np.uint32] * SMALL)


def _sums(text: np.ndarray, count: np.ndarray, times: np.ndarray, unseen: np.ndarray | None, end: np.ndarray, n: int) -> bytes:
    """Per text: known tokens, base logarithms, fixed part of the score, what the trend's power
    multiplies, and tokens of each small count. ``count`` of the word, ``times`` of the pair."""

    def total(weights):
        return np.bincount(text, weights, n)

    log = np.log10(np.maximum(count, 1))
    large = times > SMALL
    fixed = np.where(large, np.log10(np.maximum(times, 1)), 0.0) - np.where(end, 0.0, log)
    if unseen is not None:
        fixed += unseen
    tokens = np.bincount(text, minlength=n)
    some = np.flatnonzero(tokens)
    columns = [total(count > 0), total(np.log10(count + 1.0)), total(fixed), total(np.where(large, np.log10((times + 1.0) / np.maximum(times, 1)), 0.0)),
               *[total(times == r) for r in range(1, SMALL + 1)]]
    return _pack(some.astype(np.uint32), *[c[some].astype(k) for c, k in zip(columns, SUM_KINDS[1:])])


def _cut(batches: Iterator[pa.RecordBatch], parts: int, hot: np.ndarray, hot_n: np.ndarray, pairs: np.ndarray, pairs_n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packed tokens for the parts of the tables, and the texts of the block. ``hot`` words
    and ``pairs`` (hashes) are sorted and have their counts."""
    from pyspark import TaskContext

    here = TaskContext.get()
    block_id = (here.partitionId() if here else 0) << 32
    slices = 1 + hot_n * 4 // PART_TOKENS
    for block in _blocks(batches):
        n = len(block.sizes)
        ids = block.ids
        home = int(words.mix(np.array([block_id], np.uint64))[0] % np.uint64(parts))
        rows = [(home, TEXTS, block_id, _pack(
            np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(ids.is_null()).astype(np.uint8), (~block.learn).astype(np.uint8), block.sizes.astype(np.int64)))]
        at, is_hot = _within(hot, block.word)
        take = np.ones(len(block.word), bool)
        if len(pairs):
            which, settled = _within(pairs, _pair(block.context, block.word))
            if settled.any():
                take = ~settled
                rows.append((home, SUMS, block_id, _sums(
                    block.text[settled], hot_n[at[settled]], pairs_n[which[settled]], None, block.word[settled] == END, n)))
        with np.errstate(over="ignore"):
            part = (words.mix(block.word) % np.uint64(parts)).astype(np.int32)
            if is_hot.any():  # dealt by its contexts
                deal = words.mix(block.context[is_hot]) % slices[at[is_hot]].astype(np.uint64)
                part[is_hot] = (words.mix(words.mix(block.word[is_hot] + deal)) % np.uint64(parts)).astype(np.int32)
        part[~take] = parts
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        yield _rows(rows)
        for p, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            own = order[a:b]
            yield _rows([(p, PIECE, block_id, _pack_piece(block.word[own], block.context[own], block.text[own], block.learn))])
        block_id += 1


def _pack_piece(word: np.ndarray, context: np.ndarray, text: np.ndarray, learn: np.ndarray) -> bytes:
    """Tokens of a block as runs of equal pairs, by word and context, with their texts in order."""
    words_, w = np.unique(word, return_inverse=True)
    contexts, v = np.unique(context, return_inverse=True)
    pair = w * len(contexts) + v
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    w, v = w[order[heads]], v[order[heads]]
    per_word = np.bincount(w)
    return _pack(_steps(words_, np.zeros(1, np.int64)), _steps(contexts, np.zeros(1, np.int64)), per_word.astype(np.uint32),
                 _steps(v, np.cumsum(per_word) - per_word).astype(np.uint32), np.diff(np.append(heads, len(word))).astype(np.uint32),
                 _steps(text[order], heads).astype(np.uint32), np.packbits(learn), np.array([len(learn)], np.int64))


class _Piece:
    """Tokens of a block that belong to a part: per run of equal pairs the word, the context and
    how many of its tokens are learnt from; per token its run and text."""

    def __init__(self, packed: bytes):
        words_, contexts, per_word, v, runs, text, learn, n = _unpack(
            packed, np.uint64, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32, np.uint8, np.int64)
        self.words, self.contexts, self.texts = np.cumsum(words_, dtype=np.uint64), np.cumsum(contexts, dtype=np.uint64), int(n[0])
        self.at = np.repeat(np.arange(len(self.words)), per_word)
        self.of = _unstep(v.astype(np.int64), np.cumsum(per_word) - per_word, per_word)
        heads = np.cumsum(runs, dtype=np.int64) - runs
        self.runs, self.run = runs, np.repeat(np.arange(len(runs)), runs)
        self.text = _unstep(text.astype(np.int64), heads, runs)
        self.n = np.add.reduceat(np.unpackbits(learn, count=self.texts)[self.text].astype(np.int64), heads)
        self.slice = (self.contexts % np.uint64(SLICES)).astype(np.uint8)[self.of]

    def pairs(self, some: np.ndarray) -> np.ndarray:
        return _pair(self.contexts[self.of[some]], self.words[self.at[some]])


def _summed(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """Columns of ``parts`` (key, count, others) with one row per key, in its order."""
    key, count, *others = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    count = np.add.reduceat(count[order], heads) if len(key) else count
    return [key[heads], count, *(x[order[heads]] for x in others)]


def _settle(part: int, pieces: list[tuple[int, bytes]], uni: Discount, total: int, left: float, hot: np.ndarray, hot_n: np.ndarray) -> Iterator[tuple]:
    """Counts of one part, and sums of its tokens by block and text. Pieces stay packed
    and are read some times over, so that only a slice's pairs are held with their words."""
    found = []
    for _, packed in pieces:
        piece = _Piece(packed)
        n = np.bincount(piece.at, piece.n, len(piece.words)).astype(np.int64)
        found.append((piece.words[n > 0], n[n > 0]))
    known, count = _summed(found)
    at, is_hot = _within(hot, known)  # counted in other parts too
    count[is_hot] = hot_n[at[is_hot]]

    tables: list[tuple[np.ndarray, np.ndarray]] = []
    of_counts = np.zeros(SMALL + 3, np.int64)
    for first in range(0, SLICES, AT_ONCE):
        fresh: list[list] = [[] for _ in range(AT_ONCE)]
        for _, packed in pieces:
            piece = _Piece(packed)
            for k in range(AT_ONCE):
                own = np.flatnonzero((piece.n > 0) & (piece.slice == first + k))
                fresh[k].append((piece.pairs(own), piece.n[own], piece.words[piece.at[own]], piece.contexts[piece.of[own]]))
        for k in range(AT_ONCE):
            pair, times, word, context = _summed(fresh[k])
            fresh[k] = []
            of_counts += np.bincount(np.minimum(times, SMALL + 2), minlength=SMALL + 3)
            tables.append((pair, times))
            if len(pair):
                names, at = np.unique(context, return_inverse=True)
                order = np.lexsort((at, word))
                own, sizes = np.unique(word, return_counts=True)
                start = np.zeros(1, np.int64)
                yield part, PAIRS, 0, _pack(_steps(own, start), count[np.searchsorted(known, own)], sizes.astype(np.uint32), _steps(names, start),
                                            _steps(at[order], np.cumsum(sizes) - sizes).astype(np.uint32), times[order].astype(np.int64))
    yield part, COUNTS, 0, _pack(of_counts)

    for block, packed in pieces:
        piece = _Piece(packed)
        at, there = _within(known, piece.words)
        own_count = np.where(there, count[at], 0) if len(known) else np.zeros(len(piece.words), np.int64)
        at, is_hot = _within(hot, piece.words)  # where it is learnt in other parts only
        own_count[is_hot] = hot_n[at[is_hot]]
        share = np.where(own_count > 0, np.log10(np.maximum(uni.lowered(own_count), 1e-300) / max(total, 1)), math.log10(left))
        seen = np.zeros(len(piece.at), np.int64)
        for k, (pair, times) in enumerate(tables):
            if len(pair):
                some = np.flatnonzero(piece.slice == k)
                at, there = _within(pair, piece.pairs(some))
                seen[some] = np.where(there, times[at], 0)
        of = piece.at[piece.run]
        times = seen[piece.run]
        yield part, SUMS, block, _sums(piece.text, own_count[of], times, np.where(times == 0, share[of], 0.0), (piece.words == END)[of], piece.texts)
        new = np.flatnonzero(seen == 0)
        if len(new):
            yield part, UNSEEN, block, _pack(piece.contexts[piece.of[new]], piece.runs[new], piece.text[times == 0].astype(np.uint32))


def _meet(batches: Iterator[pa.RecordBatch], *known) -> Iterator[pa.RecordBatch]:
    """All parts; rows come sorted by part. Pieces are held packed."""
    now, pieces = None, []
    for batch in batches:
        heads = zip(*(batch.column(i).to_pylist() for i in range(3)))
        for i, (part, kind, block) in enumerate(heads):
            packed = batch.column(3)[i].as_py()
            if part != now and pieces:
                for row in _settle(now, pieces, *known):
                    yield _rows([row])
                pieces = []
                pa.default_memory_pool().release_unused()
            now = part
            if kind == PIECE:
                pieces.append((block, packed))
            else:
                yield _rows([(part, kind, block, packed)])
    if pieces:
        for row in _settle(now, pieces, *known):
            yield _rows([row])


# --- the tables -------------------------------------------------------------------


def _unpack_counts(batches):
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            n, = _unpack(packed, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], names=["r", "n"])


def _unpack_pairs(packed: bytes):
    """Of a slice: words, their counts and numbers of pairs; contexts; of each pair the context and its times."""
    known, count, sizes, names, of, times = _unpack(packed, np.uint64, np.int64, np.uint32, np.uint64, np.uint32, np.int64)
    of = _unstep(of.astype(np.int64), np.cumsum(sizes) - sizes, sizes)
    return np.cumsum(known, dtype=np.uint64), count, sizes, np.cumsum(names, dtype=np.uint64), of, times


def _context_sums(batches, uni: Discount, bi: Discount, total: int):
    """Per context of a part: its count, what its pairs give up, and the share of their words."""
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            _, count, sizes, names, of, times = _unpack_pairs(packed)
            share = np.repeat(uni.lowered(count) / total, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.bincount(of, times, len(names)).astype(np.int64)),
                 pa.array(np.bincount(of, times - bi.lowered(times), len(names))), pa.array(np.bincount(of, share, len(names)))],
                names=["context", "n", "given", "share"])


def _explode_pairs(batches):
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            known, _, sizes, names, of, times = _unpack_pairs(packed)
            word = np.repeat(known, sizes)
            for k in range(0, len(word), 100_000):
                own = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(names[of[own]].view(np.int64)), pa.array(word[own].view(np.int64)), pa.array(times[own])], names=["context", "word", "n"])


def _explode_unseen(batches):
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            context, runs, text = _unpack(packed, np.uint64, np.uint32, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(context, runs).view(np.int64)), pa.array(np.full(len(text), block)), pa.array(text.astype(np.int64))], names=["context", "block", "text"])


def _add_up(batches, bi: Discount):
    """Per text of a block: id, held_out, tokens, known tokens, base and score but for backoff
    weights. Rows come sorted by block, its texts first."""
    small = np.log10(np.array(bi.small[1:]))

    def out():
        ids, gone, held, sizes = texts
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), now)), pa.array(np.arange(len(ids))), pa.array(ids, mask=gone.astype(bool)), pa.array(held.astype(bool)), pa.array(sizes),
             pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2] + bi.power * sums[3] + (small[:, None] * sums[4:]).sum(axis=0))],
            names=["block", "text", "id", "held_out", "n_tokens", "n_known", "base", "score"])

    now, texts, sums = None, None, None
    for batch in batches:
        for kind, block, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block != now:
                if now is not None:
                    yield out()
                now = block
            if kind == TEXTS:
                texts = _unpack(packed, np.int64, np.uint8, np.uint8, np.int64)
                sums = np.zeros((4 + SMALL, len(texts[0])))
            else:
                at, *columns = _unpack(packed, *SUM_KINDS)
                for i, c in enumerate(columns):
                    sums[i, at] += c
    if now is not None:
        yield out()


@dataclass(frozen=True)
class Model:
    """The written tables, by hashes of words: words (word, n), pairs (context, word, n), contexts
    (context, n, backoff: log10 of the weight), and the discounts. ``total`` tokens were
    learnt, ``kinds`` different ones; an unknown word has the share ``left``."""

    words: DataFrame
    pairs: DataFrame
    contexts: DataFrame
    uni: Discount
    bi: Discount
    total: int
    kinds: int
    left: float


def held_out(doc: Column) -> Column:
    """True where crc32 of the id as text leaves 2 by 7; false without an id."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def learn_and_score(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> tuple[DataFrame, Model]:
    """A model of the texts that are not held out, and one row per row of ``docs``: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score.

    Words are lower-cased (A-Z) and parted by blanks; every text has one end. Null and empty texts
    are an end alone. Rows without id are learnt from; repeated rows count each time, and each
    has its score. With nothing to learn from every token is unknown, with
    probability one. ``docs`` is read several times and should be a written table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc}`").cast("long").alias("id"), held_out(F.col(f"`{doc}`")).alias("held_out"), F.col(f"`{text}`").alias("text"))
    vocabulary = materialise(rows.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    found = vocabulary.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), *[F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, SMALL + 2)]).first()
    total, kinds = found.total or 0, found.kinds
    uni = good_turing([0, *[found[f"n{r}"] for r in range(1, SMALL + 2)]])
    n = F.col("n").cast("double")
    lowered = F.when(n > SMALL, n * F.pow(1 + 1 / n, F.lit(uni.power))).otherwise(F.get(F.array(*map(F.lit, uni.small)), F.col("n").cast("int")))
    left = (vocabulary.agg(F.sum(n - lowered)).first()[0] or 0.0) / total if total else 1.0

    # At most total / HOT words and as many pairs.
    hot_rows = sorted((np.uint64(r.word % 2**64), r.n) for r in vocabulary.where(F.col("n") > HOT).collect())
    hot, hot_n = np.array([r[0] for r in hot_rows], np.uint64), np.array([r[1] for r in hot_rows], np.int64)
    hot_pairs = []
    if len(hot):
        asked = np.sort(np.append(hot, START))
        counted = rows.mapInArrow(lambda b: _count_hot(b, asked), "context long, word long, n long").groupBy("context", "word").agg(F.sum("n").alias("n"))
        hot_pairs = counted.where(F.col("n") > HOT).collect()
    context, word = (np.array([r[c] % 2**64 for r in hot_pairs], np.uint64) for c in ("context", "word"))
    pairs_n = np.array([r.n for r in hot_pairs], np.int64)
    order = np.argsort(_pair(context, word))
    pairs, pairs_n, context, word = _pair(context, word)[order], pairs_n[order], context[order], word[order]

    parts = max(1, -(-total * 7 // (6 * PART_TOKENS)))
    cut = rows.mapInArrow(lambda b: _cut(b, parts, hot, hot_n, pairs, pairs_n), ROW)
    # Several times as many partitions as parts, so that few get more than one.
    met = cut.repartition(3 * parts, F.col("part")).sortWithinPartitions("part").mapInArrow(lambda b: _meet(b, uni, total, left, hot, hot_n), ROW)
    met = materialise(met.drop("part"), "pairs")

    of_counts = met.where(F.col("kind") == COUNTS).select("packed").mapInArrow(_unpack_counts, "r long, n long")
    n_of = {r.r: r.n for r in of_counts.groupBy("r").agg(F.sum("n").alias("n")).collect()}
    bi = good_turing([n_of.get(r, 0) for r in range(SMALL + 2)])

    packed = met.where(F.col("kind") == PAIRS).select("packed")
    schema = "context long, n long, given double, share double"
    sums = packed.mapInArrow(lambda b: _context_sums(b, uni, bi, total), schema)
    if hot_pairs:
        word_n = hot_n[np.searchsorted(hot, word)]
        sums = sums.unionByName(spark.createDataFrame(list(zip(
            context.view(np.int64).tolist(), pairs_n.tolist(), (pairs_n - bi.lowered(pairs_n)).tolist(), (uni.lowered(word_n) / total).tolist())), schema))
    sums = sums.groupBy("context").agg(*[F.sum(c).alias(c) for c in ("n", "given", "share")])
    contexts = materialise(sums.select("context", "n", F.log10(F.col("given") / F.col("n") / (1 - F.col("share"))).alias("backoff")), "contexts")

    asked = met.where(F.col("kind") == UNSEEN).select("block", "packed").mapInArrow(_explode_unseen, "context long, block long, text long")
    asked = asked.groupBy("context", "block", "text").agg(F.count(F.lit(1)).alias("times"))
    weight = (F.col("backoff") + F.log10(F.col("n"))) * F.col("times")
    weights = asked.join(contexts, "context").groupBy("block", "text").agg(F.sum(weight).alias("weight"))
    by_block = met.where(F.col("kind").isin(TEXTS, SUMS)).select("kind", "block", "packed").repartition("block").sortWithinPartitions("block", "kind")
    scored = by_block.mapInArrow(lambda b: _add_up(b, bi), "block long, text long, id long, held_out boolean, n_tokens long, n_known long, base double, score double")
    first = contexts.where(F.col("context") == int(START.view(np.int64))).select("n").first()
    opening = math.log10(first.n) if first else 0.0
    scored = scored.join(weights, ["block", "text"], "left").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(total + kinds + 1)).alias("base_score"),
        (F.col("score") + F.coalesce("weight", F.lit(0.0)) - opening).alias("score"))
    pair_rows = packed.mapInArrow(_explode_pairs, "context long, word long, n long")
    if hot_pairs:
        pair_rows = pair_rows.unionByName(spark.createDataFrame(list(zip(context.view(np.int64).tolist(), word.view(np.int64).tolist(), pairs_n.tolist())), "context long, word long, n long"))
    return scored, Model(vocabulary, pair_rows, contexts, uni, bi, total, kinds, left)
