"""MinHash near-dedup with min-max hashing.

For each of ``PERMUTATIONS`` hash functions both the least and the greatest
value over a document's shingles are kept, so half the hash evaluations give a
signature of full length. Bands of four values propose partners; every link is
confirmed on full shingle sets.

Documents with one and the same shingle set are one class, whatever their
number, and only a class's first document goes on. In a bucket all members are
compared with its first one. Members that end up in its component need no more
comparisons there. The others meet the rest of the bucket, but only pairs whose
upper bound allows a link leave that join: each set has a small map of the cells
its shingles fall into, and a shingle in a cell that the other map lacks is not
shared. No pair is left out that could be a link.

Where one set has at most ``SMALL`` shingles, bands miss a link too often. Such
sets and their possible partners also meet by every subset of the size that a
link of theirs must share, so none of these links is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.llm import words
from opsmill.llm.components import components
from opsmill.llm.names import free
from opsmill.session import materialise

SHINGLE = 5
SIMILAR = 75  # percent
PERMUTATIONS, BANDS = 64, 32  # two values each: 128, four to a band
SMALL = 8  # shingles of the smaller set up to which no link may be missed
MAP_LONGS = 16  # of 64 cells each; few enough for one compiled method


def _shingles(own: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, each text's sorted, and their counts."""
    h = own.hashes()
    full = words.windows(h, SHINGLE)
    parts, sizes = [], np.zeros(len(own.bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(own.bounds[:-1].tolist(), own.bounds[1:].tolist())):
        if b - a >= SHINGLE:
            got = np.unique(full[a:b - SHINGLE + 1])
        elif b > a:  # fewer words: the whole sequence is the one shingle
            got = words.mix(words.windows(h[a:b], b - a) + np.uint64(b - a))
        else:
            continue
        parts.append(got)
        sizes[i] = len(got)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes


def _factors() -> np.ndarray:
    return words.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def _subsets(n: int) -> list[np.ndarray]:
    """Places of the subsets, one array (subset, place) per size, by which a set
    of ``n`` shingles meets all other sets it may be linked with, if one of the
    two is small. Equal sets are one class and need no subset."""
    sizes = set()
    for m in range(1, n * 100 // SIMILAR + 1):
        least = -(-SIMILAR * (n + m) // (100 + SIMILAR))  # shared shingles of a link
        if min(n, m) <= SMALL and least <= min(n, m) and not least == n == m:
            sizes.add(least)
    return [np.array(list(combinations(range(n), k))) for k in sorted(sizes)]


def _small_keys(own: np.ndarray, subsets: list[np.ndarray]) -> np.ndarray:
    """One hash per subset of a set's shingles."""
    with np.errstate(over="ignore"):
        made = [words.mix(own[at].sum(axis=1, dtype=np.uint64) + np.uint64(at.shape[1] << 48)) for at in subsets]
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n_shingles, two sums that tell the set, and one hash per band, with those of
    a small set's subsets."""
    factors = _factors()
    subsets: dict[int, list[np.ndarray]] = {}  # kept by the task, as the function travels by value
    for batch in words.chunks(batches):
        ids = batch.column(batch.schema.get_field_index("id"))
        found, sizes = _shingles(words.Words(batch.column(batch.schema.get_field_index("text")), lower=True))
        some = np.flatnonzero(sizes)
        sums = np.zeros((2, len(sizes)), np.uint64)
        bands = np.zeros((len(some), BANDS), np.uint64)
        if len(some):
            at = np.append(0, np.cumsum(sizes[some])[:-1])
            with np.errstate(over="ignore"):
                sums[0, some] = np.add.reduceat(found, at)
                sums[1, some] = np.add.reduceat(words.mix(found), at)
                low, high = np.empty((PERMUTATIONS, len(some)), np.uint64), np.empty((PERMUTATIONS, len(some)), np.uint64)
                for k in range(PERMUTATIONS):
                    v = found * factors[k]
                    v ^= v >> np.uint64(32)
                    low[k], high[k] = np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)
                per = PERMUTATIONS // BANDS
                for b in range(BANDS):
                    x = np.full(len(some), np.uint64(b + 1))
                    for k in range(b * per, (b + 1) * per):
                        x = words.mix(x * np.uint64(0xE7037ED1A0B428DB) + low[k])
                        x = words.mix(x * np.uint64(0xE7037ED1A0B428DB) + high[k])
                    bands[:, b] = x
        lists = list(bands)
        for j in np.flatnonzero(sizes[some] <= SMALL * 100 // SIMILAR).tolist():
            n = int(sizes[some[j]])
            if n not in subsets:
                subsets[n] = _subsets(n)
            lists[j] = np.concatenate([bands[j], _small_keys(found[at[j]:at[j] + n], subsets[n])])
        ends = np.zeros(len(sizes) + 1, np.int32)
        ends[some + 1] = [len(x) for x in lists]
        ends = np.cumsum(ends, dtype=np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
            names=["id", "n", "a", "b", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, all shingle hashes, and the map of their cells."""
    cells = MAP_LONGS * 64
    for batch in words.chunks(batches):
        found, sizes = _shingles(words.Words(batch.column(batch.schema.get_field_index("text")), lower=True))
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        flags = np.zeros((len(sizes), cells), np.uint8)
        flags[np.repeat(np.arange(len(sizes)), sizes), (found >> np.uint64(40)).astype(np.int64) % cells] = 1
        maps = np.packbits(flags, axis=1).view(np.int64).ravel()
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("id")), pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64))),
             pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * MAP_LONGS), pa.array(maps))],
            names=["id", "shingles", "map"])


def _fit(n: str, m: str):
    """Sizes that a similarity of SIMILAR percent allows."""
    return 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (src, dst) that are similar on full sets."""
    one = sets.select(F.col("id").alias("src"), F.col("shingles").alias("s"))
    two = sets.select(F.col("id").alias("dst"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    near = pairs.join(one, "src").join(two, "dst")
    near = near.select("src", "dst", both.alias("both"), (F.size("s") + F.size("t")).alias("sum"))
    return near.where(100 * F.col("both") >= SIMILAR * (F.col("sum") - F.col("both"))).select("src", "dst")


def _label(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    own = labels.select(F.col("id").alias(column), F.col("comp").alias(name))
    return rows.join(own, column, "left").withColumn(name, F.coalesce(name, column))


def near_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Confirmed links (src, dst) that give the components of all similar pairs
    of ``members`` (band, id, n); ``docs`` (id, text) has their texts."""
    first = members.groupBy("band").agg(F.min(F.struct("id", "n")).alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(members.join(first, "band").select("band", "id", "n", F.col("lead.id").alias("lead"), F.col("lead.n").alias("lead_n")), "members")
    asked = members.select("id").distinct()
    sets = materialise(docs.join(asked, "id", "left_semi").mapInArrow(_sets, "id long, shingles array<long>, map array<long>"), "sets")
    pairs = members.where((F.col("id") != F.col("lead")) & _fit("n", "lead_n")).select(F.col("id").alias("src"), F.col("lead").alias("dst")).distinct()
    links = materialise(confirm(pairs, sets), "links")

    # Members outside the component of their bucket's first one, and the rest of
    # their buckets, with the maps that bound what two sets may share.
    labels = components(links)
    open_ = _label(_label(members, labels, "id", "comp"), labels, "lead", "main").where("comp != main")
    open_ = materialise(open_.select("band", "id"), "open")
    if open_.isEmpty():
        return links
    rest = members.join(open_.select("band").distinct(), "band", "left_semi").select("band", "id", "n")
    rest = _label(rest, labels, "id", "comp").join(sets.select("id", "map"), "id")
    rest = materialise(rest.withColumn("extra", F.col("n") - _bits([F.col("map")[i] for i in range(MAP_LONGS)])), "rest")
    one = rest.join(open_, ["band", "id"], "left_semi").select(
        "band", F.col("id").alias("src"), F.col("n").alias("m"), F.col("comp").alias("own"), F.col("map").alias("other"), F.col("extra").alias("more"))
    # A cell that both maps have may hold a shared shingle; every other cell
    # holds one that is not shared.
    shared = _bits([F.col("map")[i].bitwiseAND(F.col("other")[i]) for i in range(MAP_LONGS)]) + F.least("extra", "more")
    pairs = one.join(rest, "band").where(
        (F.col("own") != F.col("comp")) & _fit("n", "m") & ((100 + SIMILAR) * shared >= SIMILAR * (F.col("n") + F.col("m"))))
    pairs = pairs.select(F.least("src", "id").alias("src"), F.greatest("src", "id").alias("dst")).distinct()
    return links.union(confirm(pairs, sets))


def _bits(longs) -> Column:
    return reduce(add, [F.bit_count(x) for x in longs])


def classes(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (least id with
    the same shingle set), component_id (least id reachable over similar
    documents), kept (doc_id = component_id).

    Words are lower-cased (A-Z) and parted by blanks. Texts with fewer than
    five words are one shingle; null texts and texts without words have an
    empty set and are linked with nothing. Rows that share an id are one node,
    so they share a component. Rows without id have no component and are kept.
    """
    rows = docs.select(F.col(f"`{doc}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = materialise(rows.mapInArrow(_sign, "id long, n long, a long, b long, bands array<long>"), "signatures")
    full = signed.where("n > 0 and id is not null")
    # Only sets of several rows are joined with their class, from a written table: so
    # Spark deals the many rows of one set over tasks, as it could not do with an
    # aggregate of the same partitioning.
    same = full.groupBy("n", "a", "b").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    same = materialise(same.drop("rows"), "copies")
    full = full.drop("bands").join(same, ["n", "a", "b"], "left")
    full = materialise(full.select("id", "n", F.coalesce("least", "id").alias("class")), "classes")
    heads = full.where("id = class").select("id", "n").distinct()
    banded = signed.join(heads, ["id", "n"], "left_semi").select("id", "n", F.explode("bands").alias("band")).distinct()
    links = near_links(rows.where("id is not null").distinct(), banded)
    # Components are those of the classes; an id of several texts ties its classes together.
    own = full.groupBy("id").agg(F.min("class").alias("class"), F.max("class").alias("last"))
    shared = own.where("class != last").select("id", F.col("class").alias("dst"))
    ties = full.join(shared, "id").where("class != dst").select(F.col("class").alias("src"), "dst").distinct()
    labels = components(links.union(ties)).select(F.col("id").alias("class"), "comp")
    # Rows of several texts take the label of any of their classes, which is one.
    out = signed.select("id", "n").join(own.select("id", "class"), "id", "left").join(labels, "class", "left")
    comp = F.coalesce("comp", "class", "id")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("class", "id").alias("class_id"),
        comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def clean_documents(docs: DataFrame) -> DataFrame:
    """One document of each group, with its columns as they were. Of rows that
    share an id one stays; rows without id all stay."""
    mark = free("gone", docs.columns)
    judged = classes(docs)
    gone = judged.where("not kept").select(F.col("doc_id").alias(mark)).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col(mark), "left_anti")
    twice = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias(mark))
    if twice.isEmpty():
        return kept
    one = kept.join(twice, F.col("doc_id") == F.col(mark), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, F.col("doc_id") == F.col(mark), "left_anti").unionByName(one)
