"""Substring dedup by super-k-mer partitioning.

A window is twenty consecutive words. The minimiser of a window is the least
hash of its three-word runs; consecutive windows with one minimiser travel as
one packed string to the bucket of that minimiser, so equal windows meet. There
sorting finds the first place of each window, and all other places are copies.

Every task first drops, piece by piece, windows it has already seen, so a
passage in a third of all documents reaches its bucket once per piece. Buckets
are read as streams: memory follows the distinct windows of one bucket, whose
size is set by the number of buckets, not by how often a window occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill.llm import words

WINDOW, MINI = 20, 3
BUCKET_BYTES = 12 << 20  # packed text of a bucket, before compression
SPREAD_FACTOR = 3  # packed text per byte of input
PIECE_BYTES = 3 << 20
NO_ID = 2**63 - 1


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of ``sizes[i]`` consecutive places from ``starts[i]`` on, for all i."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _copies(h1, h2, key, pos):
    """For windows: True where the same window has a smaller (key, pos)."""
    later = np.zeros(len(h1), bool)
    order = np.argsort(h1)
    s = h1[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return later
    near = np.zeros(len(h1), bool)
    near[1:] |= same
    near[:-1] |= same
    few = order[near]
    few = few[np.lexsort((pos[few], key[few], h2[few], h1[few]))]
    first = np.ones(len(few), bool)
    first[1:] = (h1[few][1:] != h1[few][:-1]) | (h2[few][1:] != h2[few][:-1])
    lead = few[np.maximum.accumulate(np.where(first, np.arange(len(few)), 0))]
    later[few] = (key[few] != key[lead]) | (pos[few] != pos[lead])
    return later


def _runs(key, mark, pos) -> dict[str, np.ndarray]:
    """Places in reading order as runs of consecutive ones."""
    order = np.lexsort((pos, mark, key))
    key, mark, pos = key[order], mark[order], pos[order]
    new = np.ones(len(pos), bool)
    new[1:] = (key[1:] != key[:-1]) | (mark[1:] != mark[:-1]) | (pos[1:] > pos[:-1] + 1)
    at = np.flatnonzero(new)
    return {"key": key[at], "mark": mark[at], "first": pos[at], "last": pos[np.append(at[1:], len(pos)) - 1] if len(at) else pos[:0]}


def _cut(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed super-k-mers per bucket, and places already known as copies."""
    for batch in words.chunks(batches, "text", PIECE_BYTES):
        own = words.Words(batch.column(batch.schema.get_field_index("text")))
        if len(own) < WINDOW:
            continue
        keys = batch.column(batch.schema.get_field_index("key")).to_numpy(zero_copy_only=False).astype(np.int64)
        marks = batch.column(batch.schema.get_field_index("mark")).to_numpy(zero_copy_only=False).astype(np.int64)
        h1, h2 = own.hashes(0), own.hashes(1)
        mini = words.slide_min(words.windows(h1, MINI), WINDOW - MINI + 1)
        w1, w2 = words.windows(h1, WINDOW), words.windows(h2, WINDOW)
        owner = own.owner()
        whole = np.flatnonzero(owner[:len(w1)] == owner[WINDOW - 1:])
        if not len(whole):
            continue
        text = owner[whole]
        key, mark, pos = keys[text], marks[text], whole - own.bounds[text]
        later = _copies(w1[whole], w2[whole], key, pos)
        rows: dict[str, list] = {"bucket": [], "packed": [], "bytes": []}

        known = _runs(key[later], mark[later], pos[later])
        if len(known["key"]):
            packed = np.concatenate([known["key"], known["mark"], known["first"].astype(np.int64), known["last"].astype(np.int64)])
            rows["bucket"].append(int(words.mix(known["key"][:1].view(np.uint64))[0] % np.uint64(buckets)))
            rows["packed"].append(pa.compress(packed.tobytes(), "zstd", asbytes=True))
            rows["bytes"].append(-packed.nbytes)

        sent = np.flatnonzero(~later)
        at, least = whole[sent], mini[whole[sent]]
        new = np.ones(len(sent), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (text[sent][1:] != text[sent][:-1]) | (least[1:] != least[:-1])
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(sent)))
        bucket = (least[head] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        head, n, bucket = head[order], n[order], bucket[order]
        begin = own.starts[at[head]]
        size = own.ends[at[head] + n + WINDOW - 2] - begin
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(head))
        for a, b in zip(edges[:-1], edges[1:]):
            of = sent[head[a:b]]
            packed = np.concatenate([key[of], mark[of], pos[of], n[a:b], size[a:b]]).astype(np.int64).tobytes() + own.data[_ragged(begin[a:b], size[a:b])].tobytes()
            rows["bucket"].append(int(bucket[a]))
            rows["packed"].append(np.int64(b - a).tobytes() + pa.compress(packed, "zstd", asbytes=True))
            rows["bytes"].append(len(packed))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["bucket"], pa.int32()), pa.array(rows["packed"], pa.binary()), pa.array(rows["bytes"], pa.int64())],
            names=["bucket", "packed", "bytes"])


def _unpack(packed: bytes, size: int):
    n = int(np.frombuffer(packed[:8], np.int64)[0])
    raw = pa.decompress(packed[8:], size, "zstd", asbytes=True)
    return np.frombuffer(raw, np.int64, 5 * n).reshape(5, n), np.frombuffer(raw, np.uint8, offset=40 * n)


class _Bucket:
    """The first places of the windows of one bucket so far."""

    def __init__(self) -> None:
        self.kept = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))]
        self.wait: list = []
        self.room = 0

    def add(self, packed: bytes, size: int) -> Iterator[dict]:
        self.wait.append(_unpack(packed, size))
        self.room += size
        if self.room > 2 * BUCKET_BYTES:
            yield self.settle(False)

    def settle(self, end: bool) -> dict:
        """Takes in what waits; the places that are copies."""
        heads = np.concatenate([h for h, _ in self.wait], axis=1) if self.wait else np.zeros((5, 0), np.int64)
        data = np.concatenate([d for _, d in self.wait]) if self.wait else np.zeros(0, np.uint8)
        self.wait, self.room = [], 0
        key, mark, pos, n, size = heads
        own = words.Words((data, np.append(0, np.cumsum(size))))
        at = _ragged(own.bounds[:-1], n)
        w1 = words.windows(own.hashes(0), WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
        w2 = words.windows(own.hashes(1), WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
        fresh = [w1, w2, np.repeat(key, n), np.repeat(mark, n), _ragged(pos, n)]
        w1, w2, key, mark, pos = (np.concatenate(x) for x in zip(self.kept, fresh)) if len(self.kept[0]) else fresh
        later = _copies(w1, w2, key, pos)
        if not end:
            self.kept = [x[~later] for x in (w1, w2, key, mark, pos)]
        return _runs(key[later], mark[later], pos[later])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies per bucket; the rows come sorted by bucket."""
    def out(r):
        return pa.RecordBatch.from_arrays(
            [pa.array(r["key"]), pa.array(r["mark"]), pa.array(r["first"].astype(np.int32)), pa.array(r["last"].astype(np.int32))],
            names=["key", "mark", "first", "last"])

    now, held = None, _Bucket()
    for batch in batches:
        for bucket, packed, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if size < 0:
                known = np.frombuffer(pa.decompress(packed, -size, "zstd", asbytes=True), np.int64).reshape(4, -1)
                yield out(dict(zip(("key", "mark", "first", "last"), known)))
                continue
            if bucket != now:
                if now is not None:
                    yield out(held.settle(True))
                now, held = bucket, _Bucket()
            for found in held.add(packed, size):
                yield out(found)
    if now is not None:
        yield out(held.settle(True))


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd bytes with their size, for the way through the shuffle."""
    for batch in words.chunks(batches, "__text"):
        at = batch.schema.get_field_index("__text")
        raw = [None if t is None else t.encode() for t in batch.column(at).to_pylist()]
        columns, names = list(batch.columns), list(batch.schema.names)
        columns[at] = pa.array([t and pa.compress(t, "zstd", asbytes=True) for t in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([*columns, pa.array([len(t or b"") for t in raw], pa.int64())], names=[*names, "__size"])


def _keep(batches: Iterator[pa.RecordBatch], text: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = {f.name: i for i, f in enumerate(batch.schema)}
        texts, n_words, n_removed, kept = [], [], [], []
        for packed, size, spans in zip(*(batch.column(at[c]).to_pylist() for c in ("__text", "__size", "__spans"))):
            raw = pa.decompress(packed, size, "zstd", asbytes=True) if size else packed and b""
            own = raw.split() if raw else []
            left = own
            if spans:
                gone = np.zeros(len(own) + 1, np.int64)
                np.add.at(gone, [s["first"] for s in spans], 1)
                np.add.at(gone, [s["last"] + WINDOW for s in spans], -1)
                left = [own[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
            texts.append(raw)
            n_words.append(len(own))
            n_removed.append(len(own) - len(left))
            kept.append(b" ".join(left))
        made = {n: batch.column(i) for n, i in at.items() if n not in ("__text", "__size", "__spans")}
        if text:
            made[text] = pa.array(texts, pa.binary()).cast(pa.string())
        made |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
        yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))


def copied_windows(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of window starts that are copies: key (the id, null last), mark (a
    hash of the text), first, last (word numbers, both included)."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(1, -(-total * SPREAD_FACTOR // BUCKET_BYTES))
    rows = docs.select(_key(doc), _mark(text), F.col(f"`{text}`").alias("text")).where("text is not null")
    cut = rows.mapInArrow(lambda b: _cut(b, buckets), "bucket int, packed binary, bytes long")
    return cut.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "key long, mark long, first int, last int")


def _key(doc: str):
    return F.coalesce(F.col(f"`{doc}`").cast("long"), F.lit(NO_ID)).alias("key")


def _mark(text: str):
    return F.xxhash64(F.col(f"`{text}`")).alias("mark")


def remove_copies(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (kept words joined by one
    space; columns of these names are replaced). ``with_text=False`` leaves the
    text itself out. Texts go through the shuffle once and compressed.

    A word goes if a window over it also starts earlier: at a smaller id, or
    earlier in the same document. Rows without id come last. Rows with one id
    count as one document: equal places are not earlier than each other, so
    repeated rows lose the same words. Null and empty texts have no words.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text", text)]
    spans = copied_windows(docs, doc, text).groupBy(
        F.col("key").alias("__k"), F.col("mark").alias("__m")).agg(F.collect_list(F.struct("first", "last")).alias("__spans"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], _key(doc).alias("__key"), _mark(text).alias("__mark"), F.col(f"`{text}`").alias("__text"))
    types = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema}
    rows = rows.mapInArrow(_squeeze, ", ".join(t for c, t in types.items() if c != "__text") + ", __text binary, __size long")
    rows = rows.join(spans, (F.col("__key") == F.col("__k")) & (F.col("__mark") == F.col("__m")), "left")
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], "__text", "__size", "__spans")
    fields = [types[c] for c in keep] + [f"`{text}` string"] * with_text + ["n_words long", "n_removed long", "kept_text string"]
    out = rows.mapInArrow(lambda b: _keep(b, text if with_text else None), ", ".join(fields))
    order = [c for c in docs.columns if c in keep or (with_text and c == text)]
    return out.select(*[F.col(f"`{c}`") for c in order], "n_words", "n_removed", "kept_text")
