"""Spelling variants next to a plain version."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from opsmill.llm import spelling

SCHEMA = "doc_id LONG, text STRING"


def one_edit(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    x, y = sorted((x, y), key=len)
    p = next((i for i in range(len(x)) if x[i] != y[i]), len(x))
    return x[p + 1:] == y[p + 1:] if len(x) == len(y) else x[p:] == y[p + 1:]


def plain(rows, least=7, times=2, ratio=10):
    import re
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= least and c >= times}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def texts(seed, docs=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 11))) for _ in range(25)]
    stems += ["zzzzzzz", "zzzzzzzz", "zzzzzzzzz", "Zzzzzzz×", "ÀÉÿ÷×aaaa", "x" * 60, "x" * 59 + "y"]
    weights = [4.0 ** rng.randint(0, 5) for _ in stems]
    rows = []
    for i in range(docs):
        out = []
        for w in rng.choices(stems, weights, k=120):
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + "b" + w[at:], w[:at] + "B" + w[at + 1:]])
            out.append(w)
        rows.append((i, rng.choice(["  ", "-", "\n"]).join(out)))
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, ""), (92, "short wörds 12")]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_the_plain_version(spark, seed):
    rows = texts(seed)
    table = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    got = spelling.variants(table.withColumns({"word": F.lit(1), "n": F.lit("x"), "m": F.lit(2)})).collect()
    want = plain(rows)
    assert len(got) == len(want) > 100
    assert {tuple(r) for r in got} == want


@pytest.mark.parametrize("most", [1, 3, 40])
def test_parted_groups_find_the_same_pairs(spark, most):
    """One huge group of words that share much: parted down to single letters."""
    rng = random.Random(5)
    words = sorted({"aaaa" + "".join(rng.choice("ab") for _ in range(rng.randint(3, 6))) + "aaa" for _ in range(120)})
    table = spark.createDataFrame([(w, 2 + i) for i, w in enumerate(words)], "word STRING, n LONG")
    want = {w: [v for v in words if one_edit(w, v)] for w in words}
    got = {r.word: r for r in spelling.near_words(table, most).collect()}
    assert {w: len(v) for w, v in want.items() if v} == {w: r.n_near for w, r in got.items()}
    assert all(r.best == max(want[w], key=words.index) and r.best_n == 2 + words.index(r.best) for w, r in got.items())
    sizes = spelling.groups(table, most).groupBy(*spelling.GROUP).count().collect()
    assert all(r["count"] <= most or r.m - r.a - r.b <= 1 for r in sizes)


def test_pieces_of_the_list_break_at_groups(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    rows = sorted({(8, 4, 0, 8, w[:4], w) for w in ("".join(rng.choice("ab") for _ in range(8)) for _ in range(400))})
    table = pa.table({c: pa.array([r[i] for r in rows], pa.string() if i > 3 else pa.int32()) for i, c in enumerate([*spelling.GROUP, "word"])})
    table = table.append_column("n", pa.array(range(len(rows)), pa.int64()))
    whole = pa.Table.from_batches(spelling._scan(iter(table.to_batches()))).to_pylist()
    monkeypatch.setattr(spelling, "PIECE_WORDS", 7)
    parts = pa.Table.from_batches(spelling._scan(iter(table.to_batches(max_chunksize=5)))).to_pylist()
    assert parts == whole and len(whole) > 100


def test_nothing_comes_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert np.array_equal(spelling.near_pairs(["aaaaaaa"], np.array([True]), 7, 3, 7)[0], [])
