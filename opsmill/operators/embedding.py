"""Text embeddings: hashed token features, a model hook, cache, usage."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmill import config
from opsmill.functions.columns import lookup
from opsmill.functions.text import token_count, tokens
from opsmill.session import materialise
from opsmill.sources.tables import publish, published_folders, read_published


ENTRIES_PER_STEP = 20_000
# What a worker adds up at a time, in tokens and in cells of the sums, however long the texts are.
TOKENS_PER_STEP = 500_000
CELLS_PER_STEP = 1_000_000


def feature_tokens(text: Column) -> Column:
    """The lower-case tokens that are hashed into features."""
    return tokens(F.lower(text))


def token_slots(flat: pa.Array, dim: int) -> np.ndarray:
    """Signed feature slot of every token (feature hashing): the first seven
    hex digits of its MD5 choose the slot, the eighth its sign. Slot s is
    2s for plus and 2s + 1 for minus. A token that comes again is hashed once."""
    flat = flat.cast(pa.large_binary() if pa.types.is_large_string(flat.type) else pa.binary()).dictionary_encode()
    digits = b"".join([hashlib.md5(t).digest() for t in flat.dictionary.to_pylist()])
    heads = np.frombuffer(digits, dtype=">u4")[::4].astype(np.int64)
    slots = (heads >> 4) % dim * 2 + ((heads & 15) >= 8)
    return slots[flat.indices.to_numpy(zero_copy_only=False)]


def _row_sums(lists: pa.Array, dim: int) -> np.ndarray:
    """One row of added features per list of tokens."""
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    slots = token_slots(lists.flatten(), dim)
    rows = np.repeat(np.arange(len(lists)), counts)
    sums = np.bincount(rows * dim + slots // 2, weights=1.0 - 2.0 * (slots % 2), minlength=len(lists) * dim)
    return sums.reshape(len(lists), dim)


def _add_up(lists: pa.Array, dim: int) -> pa.Array:
    """Unit vectors from lists of tokens, some lists at a time."""
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    made, start = np.zeros((len(lists), dim), dtype=np.float32), 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + TOKENS_PER_STEP, side="right"))
        stop = max(start + 1, min(stop, start + CELLS_PER_STEP // dim))
        sums = _row_sums(lists.slice(start, stop - start), dim)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        norms[norms == 0] = 1.0
        made[start:stop] = sums / norms
        start = stop
    return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dim), pa.array(made.ravel()))


def _timed(vectors: Callable[[], pa.Array]) -> pa.Array:
    """(vec, seconds): the time of a batch, measured in its task and dealt over its rows."""
    start = time.perf_counter()
    made = vectors()
    seconds = (time.perf_counter() - start) / max(len(made), 1)
    return pa.StructArray.from_arrays([made, pa.array(np.full(len(made), seconds))], ["vec", "seconds"])


def _accumulate(dim: int, timed: bool = False):
    if timed:
        @F.arrow_udf("vec array<float>, seconds double")
        def accumulate(lists: pa.Array) -> pa.Array:
            return _timed(lambda: _add_up(lists, dim))
    else:
        @F.arrow_udf("array<float>")
        def accumulate(lists: pa.Array) -> pa.Array:
            return _add_up(lists, dim)
    # Declared nondeterministic so that the optimizer never copies the call,
    # as it does into a filter when the vector is exploded.
    return accumulate.asNondeterministic()


def embed_tokens(text: Column, dim: int = 64, timed: bool = False) -> Column:
    """Unit vector of hashed token counts, zeros for a null or empty text.
    Tokens come from the JVM; one vectorised pass hashes and adds them up, so
    there is no shuffle. With ``timed`` a struct of the vector and the seconds of that pass."""
    return _accumulate(dim, timed)(feature_tokens(text))


def embed_lists(lists: Column, dim: int = 64) -> Column:
    """``embed_tokens`` of texts whose ``feature_tokens`` are there already."""
    return _accumulate(dim)(lists)


def neighbour_distances(lists: Column, dim: int, buffer: int) -> Column:
    """(distances, counts) of an array of token lists: cosine distances between consecutive
    entries, each added up with ``buffer`` entries before and after it, and the tokens of every entry."""
    def part(documents: pa.Array) -> pa.Array:
        sizes = documents.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        entries = documents.flatten()
        n = len(entries)
        total = np.vstack([np.zeros((1, dim)), np.cumsum(_row_sums(entries, dim), axis=0)])
        stop = np.cumsum(sizes)
        at, first, last = np.arange(n), np.repeat(stop - sizes, sizes), np.repeat(stop, sizes)
        near = total[np.minimum(at + buffer + 1, last)] - total[np.maximum(at - buffer, first)]
        norms = np.sqrt((near * near).sum(axis=1))
        pairs = np.flatnonzero(at + 1 < last)
        size = norms[pairs] * norms[pairs + 1]
        dots = (near[pairs] * near[pairs + 1]).sum(axis=1)
        values = 1.0 - np.divide(dots, size, out=np.zeros(len(size)), where=size > 0)
        offsets = np.append(0, np.cumsum(np.maximum(sizes - 1, 0))).astype(np.int32)
        counts = entries.value_lengths().fill_null(0).cast(pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                                           pa.ListArray.from_arrays(pa.array(np.append(0, stop).astype(np.int32)), counts)], fields=list(kind))

    kind = pa.struct([("distances", pa.list_(pa.float64())), ("counts", pa.list_(pa.int32()))])

    @F.arrow_udf("distances array<double>, counts array<int>")
    def distances(documents: pa.Array) -> pa.Array:
        # Some documents at a time, so that the sums stay small.
        ends = np.cumsum(documents.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        out, start = [pa.array([], kind)], 0
        while start < len(documents):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + ENTRIES_PER_STEP, side="right")))
            out.append(part(documents.slice(start, stop - start)))
            start = stop
        return pa.concat_arrays(out)
    return distances.asNondeterministic()(lists)


def embed_with_model(text: Column, load: Callable[[], Callable[[list[str]], np.ndarray]], timed: bool = False) -> Column:
    """Vectors from any batch model. ``load`` runs once per Python worker and
    returns a function from texts to a matrix. With ``timed`` a struct of the vector
    and the model's seconds."""
    def vectors(model, batch: pa.Array) -> pa.Array:
        return pa.array(list(np.asarray(model(batch.to_pylist()), dtype=np.float32)), pa.list_(pa.float32()))

    if timed:
        @F.arrow_udf("vec array<float>, seconds double")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                yield _timed(lambda: vectors(model, batch))
    else:
        @F.arrow_udf("array<float>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                yield vectors(model, batch)
    return run.asNondeterministic()(text)


CACHE_SCHEMA = "text_hash STRING, vec ARRAY<FLOAT>"


def text_key(text: Column) -> Column:
    """What a text is known by; a null text has a key of its own."""
    return F.coalesce(F.sha2(text, 256), F.lit("null"))


def embed_once(texts: DataFrame, cache: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """Vectors for all rows of ``texts`` (key columns and ``text``), reusing
    ``cache`` (text_hash, vec). Equal texts, also many copies in one input, are
    embedded once. Returns (text_hash, vec, cached) per distinct text."""
    distinct = texts.select(text_key(F.col("text")).alias("text_hash"), "text").distinct()
    missing = distinct.join(cache.select("text_hash"), "text_hash", "left_anti")
    known = cache.join(distinct.select("text_hash"), "text_hash", "left_semi")
    return (known.select("text_hash", "vec", F.lit(True).alias("cached"))
            .unionByName(missing.select("text_hash", embed(F.col("text")).alias("vec"), F.lit(False).alias("cached"))))


def _by_key(vectors: DataFrame) -> DataFrame:
    """Rows in order of their key, so that a file holds a range of keys."""
    return vectors.select("text_hash", "vec").repartitionByRange("text_hash").sortWithinPartitions("text_hash")


def fill_cache(texts: DataFrame, path: str, embed: Callable[[Column], Column]) -> tuple[int, int, int]:
    """Embed the texts that the kept table at ``path`` (text_hash, vec) does not have, and put
    them behind it. Returns how many those were, how many texts the table has now, and in how many
    folders. A run that fails leaves the table as it was; two runs at once may embed a
    text twice, and the next compaction drops the copies."""
    spark = texts.sparkSession
    cache = read_published(spark, path, CACHE_SCHEMA)
    distinct = texts.select(text_key(F.col("text")).alias("text_hash"), "text").distinct()
    fresh = distinct.join(cache.select("text_hash"), "text_hash", "left_anti")
    fresh = materialise(fresh.select("text_hash", embed(F.col("text")).alias("vec")), "vectors")
    n = fresh.count()
    if n:
        publish(_by_key(fresh), path, keep=True)
    kept = read_published(spark, path, CACHE_SCHEMA)
    return n, kept.count(), len(published_folders(spark, path))


def compact_cache(spark: SparkSession, path: str) -> None:
    """All vectors of the kept table in one folder, one per text."""
    cache = read_published(spark, path, CACHE_SCHEMA)
    publish(_by_key(cache.dropDuplicates(["text_hash"])), path)


def attach_vectors(texts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Join vectors back to every row; AQE splits a hot text over tasks."""
    return (texts.withColumn("text_hash", text_key(F.col("text")))
            .join(vectors.select("text_hash", "vec"), "text_hash").drop("text_hash"))


def usage_statistics(log: DataFrame) -> DataFrame:
    """Per model: tokens, cost, time and count. A log row has model, tokens,
    seconds and cached; an unknown model costs the small price."""
    price = F.coalesce(lookup(F.col("model"), config.MODEL_PRICES), F.lit(config.DEFAULT_MODEL_PRICE))
    done = ~F.col("cached")
    df = log.groupBy("model").agg(
        F.sum(F.when(done, F.col("tokens")).otherwise(0)).alias("total_tokens"),
        F.sum(F.when(done, F.col("seconds")).otherwise(0.0)).alias("total_time"),
        F.count_if(done).alias("embed_count"), F.count_if(F.col("cached")).alias("cache_hits"))
    return df.withColumns({
        "total_cost": F.col("total_tokens") / 1000 * price,
        "avg_time_per_embed": F.col("total_time") / F.greatest("embed_count", F.lit(1)),
    })


def reduce_dimension(vec: Column, dim: int) -> Column:
    """Leading part of a vector, scaled back to unit length."""
    head = F.slice(vec, 1, dim)
    norm = F.sqrt(F.aggregate(head, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(head, lambda x: F.when(norm > 0, x / norm).otherwise(x).cast("float"))


def compare_embedders(texts: DataFrame, key: str, embedders: dict[str, Callable[..., Column]]) -> DataFrame:
    """Dimension, first five values, tokens, cost and seconds of every text under every
    embedder; an unknown model costs the small price. An embedder takes the text and
    ``timed=True`` and gives a struct of vec and seconds."""
    arms = [texts.select(key, F.lit(name).alias("model"), embed(F.col("text"), timed=True).alias("made"), token_count(F.col("text")).alias("tokens"))
            for name, embed in embedders.items()]
    df = reduce(DataFrame.unionByName, arms)
    price = F.coalesce(lookup(F.col("model"), config.MODEL_PRICES), F.lit(config.DEFAULT_MODEL_PRICE))
    return df.select(key, "model", F.size("made.vec").alias("embedding_dim"), F.slice("made.vec", 1, 5).alias("embedding_sample"), "tokens",
                     (F.col("tokens") / 1000 * price).alias("cost"), F.col("made.seconds").alias("seconds"))


def embedder_times(compared: DataFrame) -> DataFrame:
    """Per model of ``compare_embedders``: texts, tokens, cost, and seconds in all and per text."""
    df = compared.groupBy("model").agg(F.count("*").alias("n_texts"), F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost"), F.sum("seconds").alias("seconds"))
    return df.withColumn("seconds_per_text", F.col("seconds") / F.col("n_texts"))
