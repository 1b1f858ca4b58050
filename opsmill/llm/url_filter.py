"""URL filters: path rules first, then exact host membership by a Bloom filter cascade.

Level 0 holds the listed hosts. Hosts of the corpus that it takes wrongly go
into level 1, listed hosts that level 1 takes wrongly into level 2, and so on,
until a level takes nothing wrongly. Since the levels are built over every host
of the corpus, the answer for each of them is exact, and no join is needed.

The hosts are dealt into shards by hash. A shard's cascade stays below a fixed
number of hosts by choice of the number of shards, and shards are sent to the
tasks in rounds of at most ``MAX_SENT_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, HASHES = 10, 7
KEYS_PER_SHARD = 200_000
MAX_SENT_BYTES = 32 << 20
SEEDS = (11, 12, 13)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def match_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null without one.
    Of rules of one length, a longer path and then the text decides."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.path), r.host + r.path))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(order):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _bits(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """HASHES bit numbers for each key by double hashing, other ones per level."""
    with np.errstate(over="ignore"):
        a = keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % 2**64)
        a ^= a >> np.uint64(31)
        a *= np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(29)
        b = (a * np.uint64(0x94D049BB133111EB) >> np.uint64(7)) | np.uint64(1)
        steps = np.arange(HASHES, dtype=np.uint64)[:, None]
        return (a[None, :] + steps * b[None, :]) % np.uint64(size)


def _encode(keys: np.ndarray, level: int) -> np.ndarray:
    size = max(64, BITS_PER_KEY * len(keys))
    flags = np.zeros(size, bool)
    flags[_bits(keys, level, size).ravel().astype(np.int64)] = True
    return flags


def _takes(flags: np.ndarray, keys: np.ndarray, level: int) -> np.ndarray:
    return flags[_bits(keys, level, len(flags)).astype(np.int64)].all(axis=0) if len(keys) else np.zeros(0, bool)


def _cascade(listed: np.ndarray, others: np.ndarray) -> list[np.ndarray]:
    """Levels for the listed keys that are right for all listed and other keys."""
    levels, own, rest = [], listed, others
    while len(own):
        flags = _encode(own, len(levels))
        wrong = rest[_takes(flags, rest, len(levels))]
        levels.append(flags)
        own, rest = wrong, own
    return levels


def _depth(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Number of levels, from the first on, that take each key."""
    depth, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
    for k, flags in enumerate(levels):
        alive = alive[_takes(flags, keys[alive], k)]
        depth[alive] = k + 1
    return depth


def _keys(high: pd.Series, low: pd.Series) -> np.ndarray:
    """One 64-bit key of two hashes."""
    with np.errstate(over="ignore"):
        return high.to_numpy(np.int64).view(np.uint64) ^ (low.to_numpy(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _hashes(host: Column) -> tuple[Column, Column]:
    return F.xxhash64(host), F.xxhash64(host, F.lit(SEEDS[0]))


def _shard(host: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(host, F.lit(SEEDS[1])), F.lit(shards)).cast("int")


def build(hosts: DataFrame, listed: DataFrame, shards: int) -> DataFrame:
    """One row (shard, level, size, bits) per level. ``hosts`` and ``listed``
    have one column ``host``; duplicates and nulls in them do not matter. Listed hosts
    outside ``hosts`` are never asked for and left out, so a shard's size
    follows the corpus, whatever the length of the list."""
    names = hosts.where("host is not null").select("host").distinct()
    on = listed.where("host is not null").select(F.col("host").alias("of")).distinct()
    marked = names.join(on, F.col("host") == F.col("of"), "left").select("host", F.col("of").isNotNull().alias("on"))
    high, low = _hashes(F.col("host"))
    marked = marked.select(_shard(F.col("host"), shards).alias("shard"), high.alias("high"), low.alias("low"), "on")

    def levels(key, part: pd.DataFrame) -> pd.DataFrame:
        keys, on = _keys(part["high"], part["low"]), part["on"].to_numpy(bool)
        if np.isin(keys[on], keys[~on]).any():
            raise ValueError("a listed host and another one share both hashes; change SEEDS")
        made = _cascade(np.sort(keys[on]), np.sort(keys[~on]))
        return pd.DataFrame({"shard": key[0], "level": range(len(made)), "size": [len(f) for f in made],
                             "bits": [np.packbits(f).tobytes() for f in made]})

    return marked.groupBy("shard").applyInPandas(levels, "shard int, level int, size int, bits binary")


def mark_listed(pages: DataFrame, host: str, cascade: DataFrame, shards: int, out: str = "listed") -> DataFrame:
    """``pages`` with a boolean column ``out``: is the host listed? Exact for
    every host that the cascade was built over; false for null and empty."""
    column = F.col(f"`{host}`")
    high, low = _hashes(column)
    pages = pages.withColumn(out, F.lit(False))
    sizes = {r.shard: r.n for r in cascade.groupBy("shard").agg(F.sum(F.length("bits")).alias("n")).collect()}
    rounds, room = [[]], 0
    for s, n in sorted(sizes.items()):
        if rounds[-1] and room + n > MAX_SENT_BYTES:
            rounds.append([])
            room = 0
        rounds[-1].append(s)
        room += n
    for sent in rounds:
        if not sent:
            continue
        held: dict[int, list[bytes]] = {}
        for r in sorted(cascade.where(F.col("shard").isin(sent)).collect(), key=lambda r: (r.shard, r.level)):
            held.setdefault(r.shard, []).append((r.size, bytes(r.bits)))
        filters = pages.sparkSession.sparkContext.broadcast(held)

        @F.pandas_udf("boolean")
        def member(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            levels = {s: [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in ls]
                      for s, ls in filters.value.items()}
            for shard, h, lo in parts:
                keys, where = _keys(h, lo), shard.to_numpy()
                found = np.zeros(len(keys), bool)
                for s in np.unique(where):
                    if s in levels:
                        at = np.flatnonzero(where == s)
                        found[at] = _depth(levels[s], keys[at]) % 2 == 1
                yield pd.Series(found)

        asked = F.when(column.isNotNull() & (column != ""), member(_shard(column, shards), high, low))
        pages = pages.withColumn(out, F.col(out) | F.coalesce(asked, F.lit(False)))
    return pages


def judge(pages: DataFrame, rules: tuple[Rule, ...], listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict (columns of these
    names are replaced). The longest rule decides; without one a listed host
    is blocked and any other allowed. Null urls and urls without ``://`` have
    empty host and path and are allowed. ``listed`` has one column ``host``.
    """
    host, path = split_url(F.col(f"`{url}`"))
    out = pages.withColumn("host", host).withColumn("path", path)
    hosts = out.select("host").where("host != ''").distinct()
    shards = max(1, -(-hosts.count() // KEYS_PER_SHARD))
    from opsmill.session import materialise

    cascade = materialise(build(hosts, listed.select("host"), shards), "cascade")
    out = mark_listed(out, "host", cascade, shards)
    rule = match_rule(F.col("host"), F.col("path"), rules)
    return out.withColumn("rule", rule.rule).withColumn("verdict", F.coalesce(
        rule.verdict, F.when(F.col("listed"), "block").otherwise("allow")))
