"""Compression of vectors to codes: product quantisation with norm-of-sum bounds.

Vectors of whole numbers are cut into parts, and each part has a codebook that a
few rounds of assigning and averaging improve. All codebooks of all rounds are
kept. A part remembers how near any entry but its own can be (a lower bound), and the
round in which that was measured. Later the bound is lowered by how far the entries
have really moved since that round - the length of the net displacement, which is at
most the sum of the lengths of the single moves - and only where its own entry is not
surely nearer than that, all entries are measured again. Skipping changes no result:
the bounds have a margin, and where they leave a doubt (ties included) the exact
distances decide, in whole numbers.

A round reads the rows that the last one wrote and writes them with their new state.
To the driver go sums per entry and component: parts x entries x length numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 26  # components beyond it are held there: squares stay whole in 64 bits
MARGIN = 1e-9
SENT_LABELS = 100_000  # sums by label that may go to all tasks

STATE = np.dtype([("code", np.uint8), ("stamp", np.uint8), ("low", np.float32)])


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all entries, exact as int64."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
    kind = np.float64 if 4 * most * most * max(x.shape[1], 1) < 2**53 else np.int64
    a, c = x.astype(kind), book.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)[None]).astype(np.int64)


def _lowered(value: np.ndarray) -> np.ndarray:
    """float32 values that are surely not larger."""
    return np.nextafter(value.astype(np.float32), np.float32(-np.inf))


def rescan(x: np.ndarray, book: np.ndarray, stamp: int) -> np.ndarray:
    """The state of rows measured against all entries; ties go to the lower one."""
    state = np.zeros(len(x), STATE)
    d = distances(x, book)
    code = d.argmin(axis=1)
    state["code"], state["stamp"] = code, stamp
    d[np.arange(len(x)), code] = np.iinfo(np.int64).max
    second = d.min(axis=1)
    state["low"] = np.where(second == np.iinfo(np.int64).max, np.inf, _lowered(np.sqrt(second.astype(np.float64))))
    return state


def assign(x: np.ndarray, state: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The state under the last of ``books``, and which rows had to be measured again.
    ``books`` has the codebooks of this part for every round so far."""
    now = len(books) - 1
    book = books[now]
    code = state["code"].astype(np.int64)
    own = np.sqrt(((x - book[code]) ** 2).sum(axis=1).astype(np.float64))
    moved = np.zeros(len(x))
    for stamp in np.unique(state["stamp"]).tolist():
        net = np.sqrt(((book - books[stamp]) ** 2).sum(axis=1).astype(np.float64))
        order = np.argsort(net)
        at = state["stamp"] == stamp
        # The farthest of the other entries: the second where the farthest is one's own.
        second = net[order[-2]] if len(net) > 1 else 0.0
        moved[at] = np.where(code[at] == order[-1], second, net[order[-1]])
    doubt = ~(own * (1 + MARGIN) + MARGIN < state["low"] - moved * (1 + MARGIN))
    state = state.copy()
    if doubt.any():
        state[doubt] = rescan(x[doubt], book, now)
    return state, doubt


def _parts(batch: pa.RecordBatch, size: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("parts"))
    return np.asarray(values.flatten()).astype(np.int64).reshape(batch.num_rows, size)


def _step(batches: Iterator[pa.RecordBatch], sent, size: int) -> Iterator[pa.RecordBatch]:
    """Rows with their state under the last codebooks."""
    books = sent.value  # (round, part, entry, place)
    width = size // PARTS
    for batch in batches:
        x = _parts(batch, size)
        at = batch.schema.get_field_index("state")
        old = batch.column(at)
        if old.null_count:
            made = [rescan(x[:, p * width:(p + 1) * width], books[-1][p], len(books) - 1) for p in range(PARTS)]
        else:
            held = np.frombuffer(b"".join(old.to_pylist()), STATE).reshape(-1, PARTS)
            made = [assign(x[:, p * width:(p + 1) * width], held[:, p], [b[p] for b in books])[0] for p in range(PARTS)]
        rows = np.stack(made, axis=1)
        states = pa.array([r.tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([states if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)


def _sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per part and entry of a task's rows: how many, and their sum, a component a row."""
    width = size // PARTS
    total, count = np.zeros((PARTS, ENTRIES, width), np.int64), np.zeros((PARTS, ENTRIES), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _parts(batch, size)
        code = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("state")).to_pylist()), STATE).reshape(-1, PARTS)["code"]
        for p in range(PARTS):
            order = np.argsort(code[:, p], kind="stable")
            own = code[order, p]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total[p, own[heads]] += np.add.reduceat(x[order, p * width:(p + 1) * width], heads, axis=0)
            count[p] += np.bincount(own, minlength=ENTRIES)
    part, entry = np.nonzero(count)
    if len(part):
        place = np.arange(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, width).astype(np.int32)), pa.array(np.repeat(entry, width).astype(np.int32)), pa.array(np.tile(place, len(part)).astype(np.int32)),
             pa.array(np.repeat(count[part, entry], width)), pa.array(total[part, entry].ravel())],
            names=["part", "entry", "place", "n", "total"])


def _finish(batches: Iterator[pa.RecordBatch], sent, size: int) -> Iterator[pa.RecordBatch]:
    """Codes as hex digits, and final squared distances."""
    book = sent.value[-1]
    width = size // PARTS
    for batch in batches:
        x = _parts(batch, size)
        code = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("state")).to_pylist()), STATE).reshape(-1, PARTS)["code"]
        error = np.zeros(len(x), np.int64)
        for p in range(PARTS):
            error += ((x[:, p * width:(p + 1) * width] - book[p][code[:, p]]) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in ("id", "label")), pa.array([bytes(r).hex() for r in code], pa.string()), pa.array(error)],
            names=["id", "label", "code", "error"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components times SCALE, rounded down."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("vector"))
        flat = np.asarray(lists.flatten().cast(pa.float64()))
        made = np.clip(np.floor(flat * SCALE), -LARGEST, LARGEST).astype(np.int32)
        offsets = np.append(0, np.cumsum(np.asarray(pc.list_value_length(lists)).astype(np.int64))).astype(np.int32)
        parts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made))
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("id", "label")), parts], names=["id", "label", "parts"])


def averaged(book: np.ndarray, sums: list, size: int) -> np.ndarray:
    """The next codebooks: sums over counts rounded down; unused entries stay."""
    book = book.copy()
    for r in sums:
        book[r.part, r.entry, r.place] = int(r.total) // r.n
    return book


def digest(book: np.ndarray) -> str:
    """sha256 of all components as decimals, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def train(rows: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """``rows`` (id, label, parts) with their last state, and the codebooks of all
    rounds as an array (round, part, entry, place)."""
    spark = rows.sparkSession
    first = rows.orderBy(F.col("id").asc_nulls_last(), "parts").limit(ENTRIES).select("parts").collect()
    start = np.array([r.parts for r in first], np.int64).reshape(len(first), PARTS, size // PARTS)
    books = start.transpose(1, 0, 2)[None]
    state = rows.withColumn("state", F.lit(None).cast("binary"))
    for k in range(ROUNDS + 1):
        sent = spark.sparkContext.broadcast(books)
        state = materialise(state.mapInArrow(_stepper(sent, size), state.schema), "codes")
        if k < ROUNDS:
            sums = state.select("parts", "state").mapInArrow(lambda b: _sums(b, size), "part int, entry int, place int, n long, total long")
            found = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
            books = np.concatenate([books, averaged(books[-1], found, size)[None]])
    return state, books


def _stepper(sent, size):
    return lambda batches: _step(batches, sent, size)


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per kept row: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null, or has a null or non-finite component, are dropped. Starting
    entries come from the smallest ids (rows of one id in order of their vectors, rows
    without id last); with fewer rows there are fewer entries. All vectors should have one
    length, divisible by PARTS: that of the smallest id counts, and rows of another one,
    or all if it is not divisible, have a null code and error. Components of over
    LARGEST / SCALE are held there. Errors are summed over equal labels, nulls together.
    An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("vector")).where(
        F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    rows = materialise(rows.mapInArrow(_whole, f"id {kinds['id']}, label {kinds['label']}, parts array<int>"), "vectors")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "parts").limit(1).collect()
    size = len(first[0].parts) if first else 0
    fits = (F.size("parts") == size) if size % PARTS == 0 else F.lit(False)
    head = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    if first and size % PARTS == 0:
        state, books = train(rows.where(fits), size)
        sent = spark.sparkContext.broadcast(books)
        coded = state.mapInArrow(lambda b: _finish(b, sent, size), head)
        mark = digest(books[-1])
    else:
        coded, mark = spark.createDataFrame([], head), digest(np.zeros(0, np.int64))
    other = rows.where(~fits).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = materialise(coded.unionByName(other), "errors")
    out = _with_sums(coded)
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(mark).alias("codebooks_sha256"))


def _with_sums(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error. Labels are summed before they meet the rows; up to
    SENT_LABELS of them go to all tasks, more are joined with every label dealt to
    several tasks, so that a hot one is no single task's."""
    sums = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    sums = sums.withColumnRenamed("label", "of")
    if sums.limit(SENT_LABELS + 1).count() <= SENT_LABELS:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left")
    deals = 32
    dealt = coded.withColumn("deal", F.pmod(F.xxhash64("id", "code"), F.lit(deals)))
    spread = sums.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    return dealt.join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("deal") == F.col("to")), "left")
