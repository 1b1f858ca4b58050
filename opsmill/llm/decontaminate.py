"""Benchmark decontamination by one Aho-Corasick automaton.

Test items are normalised to lower-case words, and every window of ten words
(or a whole shorter item) is a pattern. A document is normalised the same way
and scanned once; hits are mapped to its words and to character places in the
text as it was. Documents are never shuffled: the items' windows go to them, as
one automaton. Only where the windows have more than ``BLOCK_CHARS`` characters
are there several, one scan each, and its hits are written before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill.llm import words
from opsmill.llm.names import free
from opsmill.session import materialise

WINDOW = 10
BLOCK_CHARS = 4 << 20
# Separators to blanks and A-Z to a-z; every other byte stays as it is.
NORMAL = bytes(words.LOWER[b] if words.ALNUM[b] else 32 for b in range(256))


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (pattern, items): a padded window and the ids, as strings, that
    hold it, a null for items without id. Items without words, or null, have none."""
    kind = F.array_remove(F.split(F.translate(
        F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")
    own = items.select(F.col(f"`{item}`").cast("string").alias("item"), kind.alias("w"))
    own = own.where("size(w) > 0")
    places = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    shown = own.select("item", F.explode(F.transform(
        places, lambda i: F.array_join(F.slice("w", i, F.lit(window)), " "))).alias("pattern"))
    return shown.groupBy("pattern").agg(F.sort_array(F.collect_set(F.struct("item")))["item"].alias("items"))


def _automaton(patterns: list[tuple[str, list[str]]]) -> ahocorasick.Automaton | None:
    if not patterns:
        return None
    auto = ahocorasick.Automaton()
    for pattern, ids in patterns:
        key = f" {pattern} ".encode().decode("latin-1")
        auto.add_word(key, (len(key), pattern.count(" ") + 1, ids))
    auto.make_automaton()
    return auto


def _scan(batches: Iterator[pa.RecordBatch], patterns, names: list[str], source: str) -> Iterator[pa.RecordBatch]:
    """The rows with their hits; the automaton is built once per task."""
    auto = _automaton(patterns.value)
    for batch in batches:
        made: list[list] = [[] for _ in range(4)]
        for text in batch.column(batch.schema.get_field_index(source)).to_pylist():
            raw = (text or "").encode()
            parts = raw.translate(NORMAL).split()
            hits: list[tuple[int, int]] = []
            found: set[str | None] = set()
            if parts and auto is not None:
                line = f" {b' '.join(parts).decode('latin-1')} "
                ends, lens = [], []
                for end, (_, n, ids) in auto.iter(line):
                    ends.append(end)
                    lens.append(n)
                    found.update(ids)
                if ends:
                    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
                    stop = np.searchsorted(blanks, ends)  # words before the closing blank
                    for a, b in sorted(set(zip((stop - lens).tolist(), stop.tolist()))):
                        if hits and a <= hits[-1][1]:
                            hits[-1] = (hits[-1][0], max(b, hits[-1][1]))
                        else:
                            hits.append((a, b))
            spans = []
            if hits:
                own = words.Words(pa.array([text], pa.large_string()), words.ALNUM, lower=True)
                chars = np.cumsum((own.data & 0xC0) != 0x80)  # code points up to each byte
                spans = [{"start": int(chars[own.starts[a]]) - 1, "end": int(chars[own.ends[b - 1] - 1])} for a, b in hits]
            for k, v in enumerate((len(parts), sorted(found, key=lambda x: (x is not None, x or "")), [{"start": a, "end": b} for a, b in hits], spans)):
                made[k].append(v)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(made[0], pa.int64()), pa.array(made[1], pa.list_(pa.string())), pa.array(made[2], span), pa.array(made[3], span)],
            names=[*batch.schema.names, *names])


HIT_COLUMNS = ["n_words", "items", "word_spans", "char_spans"]
HIT_TYPES = ["long", "array<string>", "array<struct<start:int,end:int>>", "array<struct<start:int,end:int>>"]


def scan(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without columns named as the results, with n_words, items (ids
    with a window in the text, sorted as strings, first a null if an item without
    id has one), word_spans (merged runs of
    hit words, end exclusive) and char_spans (the same runs as code points of
    the text). Null and empty texts have no words and no hits; repeated rows
    are scanned alike; without items nothing is hit.
    """
    spark = docs.sparkSession
    found = item_windows(items)
    # Blocks of bounded size. What one block hits is written before the next is
    # read, so the driver and a task hold one block at a time.
    total = found.agg(F.coalesce(F.sum(F.length("pattern") + 2), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // BLOCK_CHARS))
    if blocks > 1:
        found = materialise(found, "windows")
    keep = [c for c in docs.columns if c not in HIT_COLUMNS]
    body = text if text in keep else free("body", docs.columns)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{text}`").alias(body)] * (body != text))
    made = [[free(f"{c}_{k}", docs.columns) for c in HIT_COLUMNS] for k in range(blocks)]
    for k, names in enumerate(made):
        own = found.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast([(r.pattern, list(r["items"])) for r in own.collect()])
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"`{n}` {t}" for n, t in zip(names, HIT_TYPES)]
        rows = rows.mapInArrow(_scanner(sent, names, body), ", ".join(fields))
        if k < blocks - 1:
            rows = materialise(rows, "hits")
            sent.destroy()
    n_words, items_, word_spans, char_spans = ([F.col(f"`{names[i]}`") for names in made] for i in range(len(HIT_COLUMNS)))
    if blocks == 1:
        merged = [items_[0], word_spans[0], char_spans[0]]
    else:
        merged = [F.sort_array(F.array_distinct(F.flatten(F.array(*items_)))), *[_merge(F.flatten(F.array(*c))) for c in (word_spans, char_spans)]]
    return rows.select(*[F.col(f"`{c}`") for c in keep], *[c.alias(n) for n, c in zip(HIT_COLUMNS, [n_words[0], *merged])])


def _scanner(sent, names: list[str], source: str):
    return lambda batches: _scan(batches, sent, names, source)


def _merge(spans):
    """Overlapping or touching spans joined."""
    def step(done, s):
        last = F.element_at(done, -1)
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)).end >= s.start), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last.start.alias("start"), F.greatest(last.end, s.end).alias("end"))))).otherwise(F.concat(done, F.array(s)))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(F.sort_array(spans), empty, step)


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without any hit, with their columns as they were. Of the
    columns only the text decides, so null ids and repeated rows stay."""
    own: dict[str, str] = {}
    for c in docs.columns:
        own[c] = free(f"own_{c}", [*docs.columns, *own.values()]) if c.lower() in HIT_COLUMNS else c
    kept = scan(docs.select(*[F.col(f"`{c}`").alias(o) for c, o in own.items()]), items).where("size(word_spans) = 0")
    return kept.select(*[F.col(f"`{o}`").alias(c) for c, o in own.items()])
