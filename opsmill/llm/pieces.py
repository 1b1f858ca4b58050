"""SentencePiece encoding and decoding with sampled segmentations.

The pieces of a text form a lattice. Forward filtering sums the weights of all
ways to each place; backward sampling then draws one way from the end, each
with its probability. All draws come from the row's key and the place in the
row, so a row is segmented alike in any job, batch or retry. Decoding gives the
text back, byte for byte.

The vocabulary file is read on the driver, is a parameter, and is never
trained. It holds merge ranks and no probabilities, so a piece of rank r weighs
(r + 1) ** -temperature, as words of rank r do by Zipf's law. Characters
without a piece are spelt in bytes.

Pieces hold blanks at their start only and no line ends, so the lattice falls
apart into words. The distinct words of a megabyte of text are filtered
together in numpy, and all their occurrences sampled together.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmill.llm import words

LONG_UNIT = 48
PIECE_BYTES = 1 << 20  # of text whose words are filtered together
BASE = 0x9E3779B185EBCA87
UNITS = r" *[^ \n]+| +|\n"


@dataclass(frozen=True)
class Vocabulary:
    """Surface (blank for the mark of a word start), id and weight of each
    piece, the ids of the 256 bytes, and the bytes of each id."""

    pieces: dict[str, tuple[int, float]]
    prefixes: frozenset[str]
    byte_ids: tuple[int, ...]
    byte_weight: float
    spelling: tuple[bytes, ...]
    split: bool


def load(path: str, temperature: float = 1.0) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, spelling, rank = {}, [0] * 256, [], 0
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            spelling.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelling.append(b"")
        else:
            rank += 1
            surface = name.replace("▁", " ")
            pieces[surface] = (i, float(rank + 1) ** -temperature)
            spelling.append(surface.encode())
    prefixes = frozenset(p[:k] for p in pieces for k in range(1, len(p) + 1))
    split = not any("\n" in p or " " in p.lstrip(" ") for p in pieces)
    return Vocabulary(pieces, prefixes, tuple(byte_ids), float(len(spelling)) ** -temperature, tuple(spelling), split)


def arcs(unit: str, v: Vocabulary) -> list[list[tuple[int, int, float]]]:
    """For each place after the first: (place before, piece or -1 for bytes, weight)."""
    into: list[list[tuple[int, int, float]]] = [[] for _ in range(len(unit) + 1)]
    for i in range(len(unit)):
        single = False
        for j in range(i + 1, len(unit) + 1):
            part = unit[i:j]
            if part not in v.prefixes:
                break
            hit = v.pieces.get(part)
            if hit:
                into[j].append((i, *hit))
                single = single or j == i + 1
        if not single:
            into[i + 1].append((i, -1, v.byte_weight ** len(unit[i].encode("utf-8", "surrogatepass"))))
    return into


class _Lookup:
    """The vocabulary as arrays: per length the hashes of all beginnings of
    pieces, sorted, with the piece that ends there or -1."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.longest = max(map(len, v.pieces))
        self.code = np.zeros((len(v.spelling), self.longest), np.uint32)
        self.weight = np.zeros(len(v.spelling))
        for surface, (i, w) in v.pieces.items():
            self.code[i, :len(surface)] = [ord(c) for c in surface]
            self.weight[i] = w
        by: list[dict[int, int]] = [{} for _ in range(self.longest + 1)]
        for prefix in v.prefixes:
            h = 0
            for c in prefix:
                h = (h * BASE + ord(c) + 1) % 2**64
            by[len(prefix)][h] = v.pieces.get(prefix, (-1,))[0]
        self.hashes = [np.array(sorted(t), np.uint64) for t in by]
        self.ids = [np.array([t[h] for h in sorted(t)], np.int64) for t in by]

    def find(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (start, length, piece) in ``codes``; ``left`` is how far each
        place is from the end of its unit."""
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        starts, sizes, ids = [], [], []
        with np.errstate(over="ignore"):
            for n in range(1, self.longest + 1):
                fits = left[at] >= n
                at, h = at[fits], h[fits]
                h = h * np.uint64(BASE) + codes[at + (n - 1)] + np.uint64(1)
                slot = np.searchsorted(self.hashes[n], h)
                slot[slot == len(self.hashes[n])] = 0
                known = self.hashes[n][slot] == h
                at, h, slot = at[known], h[known], slot[known]
                if not len(at):
                    break
                piece = self.ids[n][slot]
                hit = np.flatnonzero(piece >= 0)
                same = (codes[at[hit][:, None] + np.arange(n)] == self.code[piece[hit], :n]).all(axis=1)
                hit = hit[same]
                starts.append(at[hit])
                sizes.append(np.full(len(hit), n))
                ids.append(piece[hit])
        if not starts:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(ids)


class _Lattices:
    """Filtered lattices of the distinct units of some texts.

    State s is a place in a unit; its arcs are ``first[s]`` on, ``count[s]`` of
    them, each with the state before (-1: the start of the unit), the piece, and
    where its share of the probability begins, in 2**32 parts. Short units go
    through the filter together; long ones, and those with a character that is
    spelt in bytes, one by one. Either way a unit's numbers depend on it alone.
    """

    def __init__(self, units: list[str], lookup: _Lookup):
        self.ends = np.full(len(units), -1, np.int64)
        lengths = np.array([len(u) for u in units], np.int64)
        short = np.flatnonzero(lengths <= LONG_UNIT)
        codes = np.frombuffer("".join([units[i] for i in short]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        stop = np.cumsum(lengths[short])
        left = np.repeat(stop, lengths[short]) - np.arange(len(codes))
        starts, sizes, ids = lookup.find(codes, left)
        single = np.zeros(len(codes), bool)
        single[starts[sizes == 1]] = True
        odd = np.zeros(len(short), bool)
        odd[np.searchsorted(stop, np.flatnonzero(~single), side="right")] = True
        self.ends[short[~odd]] = stop[~odd] - 1

        state = starts + sizes - 1
        order = np.argsort(state * 32 - sizes, kind="stable")  # longer pieces, so earlier starts, first
        state, starts, self.piece = state[order], starts[order], ids[order].astype(np.int32)
        begin = stop - lengths[short]
        self.back = np.where(starts == np.repeat(begin, lengths[short])[starts], -1, starts - 1) if len(starts) else starts
        self.count = np.bincount(state, minlength=len(codes))
        self.first = np.cumsum(self.count) - self.count
        self.share = np.zeros(len(state), np.uint32)
        self._filter(lookup.weight[self.piece], np.arange(len(codes)) - np.repeat(begin, lengths[short]))
        self._add([(i, units[i]) for i in np.concatenate([short[odd], np.flatnonzero(lengths > LONG_UNIT)]).tolist()], lookup.v)

    def _filter(self, weight: np.ndarray, depth: np.ndarray) -> None:
        """Masses and shares, all units together, place by place. Sums run arc
        by arc, so they are the same whatever else is in the texts."""
        n = len(depth)
        mass, part = np.zeros(n + 1), np.zeros(len(weight))
        mass[n] = 1.0  # place -1
        by_depth = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2)) if n else np.zeros(1, np.int64)
        for lo, hi in zip(edges[:-1], edges[1:]):
            own = by_depth[lo:hi]
            count, first = self.count[own], self.first[own]
            total, sofar = np.zeros(len(own)), np.zeros(len(own))
            most = count.max() if len(own) else 0
            for k in range(most):
                some = count > k
                arc = first[some] + k
                part[arc] = mass[self.back[arc]] * weight[arc]
                total[some] += part[arc]
            mass[own] = total
            for k in range(most):
                some = count > k
                arc = first[some] + k
                self.share[arc] = np.minimum(sofar[some] / total[some] * 4294967296.0, 4294967295.0).astype(np.uint32)
                sofar[some] += part[arc]

    def _add(self, units: list[tuple[int, str]], v: Vocabulary) -> None:
        if not units:
            return
        first, count, back, piece, share = array("q"), array("q"), array("q"), array("i"), array("L")
        states, arcs_before = len(self.first), len(self.back)

        def state(shares):
            total = 0.0
            for _, _, w in shares:
                total += w
            first.append(arcs_before + len(back))
            count.append(len(shares))
            sofar = 0.0
            for before, p, w in shares:
                back.append(before)
                piece.append(p)
                share.append(min(int(sofar / total * 4294967296.0), 0xFFFFFFFF))
                sofar += w
            return states + len(first) - 1, total

        for number, unit in units:
            mass, at = [1.0] + [0.0] * len(unit), [-1] + [0] * len(unit)
            for j, into in enumerate(arcs(unit, v)):
                if not j:
                    continue
                shares = []
                for i, p, w in into:
                    before = at[i]
                    if p < 0:
                        spelt = unit[i].encode("utf-8", "surrogatepass")
                        for b in spelt[:-1]:
                            before, _ = state([(before, v.byte_ids[b], 1.0)])
                        p = v.byte_ids[spelt[-1]]
                    shares.append((before, p, mass[i] * w))
                at[j], mass[j] = state(shares)
                if mass[j] < 1e-150:  # only ratios count
                    for i in range(max(0, j - 64), j + 1):
                        mass[i] *= 1e150
            self.ends[number] = at[-1]
        self.first = np.concatenate([self.first, np.array(first, np.int64)])
        self.count = np.concatenate([self.count, np.array(count, np.int64)])
        self.back = np.concatenate([self.back, np.array(back, np.int64)])
        self.piece = np.concatenate([self.piece, np.array(piece, np.int32)])
        self.share = np.concatenate([self.share, np.array(share, np.uint32)])

    def step(self, state: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The arc of each state that its draw falls into."""
        arc = self.first[state]
        last = arc + self.count[state] - 1
        moving = np.flatnonzero(arc < last)
        while len(moving):
            moving = moving[self.share[arc[moving] + 1] <= draw[moving]]
            arc[moving] += 1
            moving = moving[arc[moving] < last[moving]]
        return arc


def sample(texts: list[str], keys: np.ndarray, lookup: _Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in order, and how many each text has."""
    find = re.compile(UNITS).findall if lookup.v.split else lambda t: [t] if t else []
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    counts, places = np.zeros(len(texts), np.int64), []
    for i, t in enumerate(texts):
        own = find(t)
        counts[i] = len(own)
        places.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
    held = _Lattices(list(number), lookup)
    state = held.ends[np.concatenate(places)] if places else np.zeros(0, np.int64)
    n = len(state)
    nth = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        base = words.mix(np.repeat(keys.view(np.uint64), counts) + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    alive, steps, taken = np.arange(n), np.zeros(n, np.int64), []
    while len(alive):
        with np.errstate(over="ignore"):
            draw = words.mix(base[alive] + np.uint64((len(taken) * 0x9E3779B97F4A7C15) % 2**64)) >> np.uint64(32)
        arc = held.step(state[alive], draw)
        taken.append((alive, held.piece[arc]))
        steps[alive] += 1
        state[alive] = held.back[arc]
        alive = alive[state[alive] >= 0]
    stop = np.cumsum(steps)
    out = np.empty(stop[-1] if n else 0, np.int32)
    for k, (who, ids) in enumerate(taken):
        out[stop[who] - 1 - k] = ids
    edges = np.append(0, np.cumsum(counts))
    return out, np.diff(np.append(0, stop)[edges])


def encode(docs: DataFrame, vocabulary: Vocabulary, key: Column, text: str = "text", out: str = "pieces", seed: int = 0) -> DataFrame:
    """``docs`` with ``out``, an array of piece ids (a column of that name is
    replaced). ``key`` names the row for the draws: rows with equal key and
    text get equal pieces. A null text gives null, an empty one no pieces."""
    keep = [c for c in docs.columns if c != out]
    # Plain values, as broadcasts are read before the package is known to a task.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(vocabulary).values()))
    source = text if text in keep else "__text"
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{text}`").alias(source)] * (source != text), F.xxhash64(key, F.lit(seed)).alias("__key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(Vocabulary(*sent.value))
        for batch in words.chunks(batches, source, PIECE_BYTES):
            at = {f.name: i for i, f in enumerate(batch.schema)}
            texts = batch.column(at[source]).to_pylist()
            keys = np.ascontiguousarray(batch.column(at["__key"]).to_numpy(zero_copy_only=False).astype(np.int64))
            ids, sizes = sample([t or "" for t in texts], keys, lookup)
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            gone = np.append(np.array([t is None for t in texts], bool), False)
            lists = pa.ListArray.from_arrays(pa.array(offsets, mask=gone), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in keep), lists], names=[*keep, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return rows.mapInArrow(run, f"{fields + ', ' if fields else ''}`{out}` array<int>")


def decode(docs: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``, the text of the piece ids (a column of that name
    is replaced). Null pieces give null."""
    keep = [c for c in docs.columns if c != out]
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.spelling)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{pieces}`").alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(b"".join(sent.value), np.uint8)
        size = np.array([len(x) for x in sent.value], np.int64)
        start = np.cumsum(size) - size
        for big in batches:
            for k in range(0, big.num_rows, 256):
                batch = big.slice(k, 256)
                at = {f.name: i for i, f in enumerate(batch.schema)}
                lists = batch.column(at["__ids"])
                ids = np.asarray(lists.flatten()).astype(np.int64)
                counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
                sizes = size[ids]
                ends = np.cumsum(sizes)
                data = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ids] - ends + sizes, sizes)]
                offsets = np.append(0, ends)[np.append(0, np.cumsum(counts))].astype(np.int64)
                empty = np.asarray(lists.is_null())
                texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [
                    pa.py_buffer(np.packbits(~empty, bitorder="little").tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(at[c]) for c in keep), texts.cast(pa.binary()).cast(pa.string())], names=[*keep, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return rows.mapInArrow(run, f"{fields + ', ' if fields else ''}`{out}` string")


def default_path() -> str:
    """The public vocabulary file of this installation."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def round_trip(spark: SparkSession, docs: DataFrame, path: str | None = None, temperature: float = 1.0) -> DataFrame:
    """``docs`` (doc_id, text) with pieces and decoded."""
    v = load(path or default_path(), temperature)
    return decode(encode(docs, v, F.col("doc_id")), v)
