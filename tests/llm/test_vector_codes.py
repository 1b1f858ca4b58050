"""Vector codes next to a plain version, and the bounds next to full scans."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmill.llm import vector_codes as vc

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def plain(rows):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    width = size // 4
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(4)] for _, v, _ in kept]
    books = [[cut[j][p] for j in range(min(256, len(cut)))] for p in range(4)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))
    for _ in range(4):
        for p in range(4):
            own = [near(c[p], books[p])[1] for c in cut]
            for j in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == j]
                if mine:
                    books[p][j] = tuple(sum(col) // len(mine) for col in zip(*mine))
    final = [[near(c[p], books[p]) for p in range(4)] for c in cut]
    errors = [sum(d for d, _ in f) for f in final]
    import hashlib
    sha = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    by = {}
    for (_, _, lab), e in zip(kept, errors):
        by[lab] = by.get(lab, 0) + e
    return sorted((str(i), "".join(f"{j:02x}" for _, j in f), e, by[lab], sha) for (i, _, lab), f, e in zip(kept, final, errors))


def table(seed, n, size=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    rows = [(i * 3, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([None, 1, 1, 1, 2])) for i in range(n)]
    return rows


@pytest.mark.parametrize("n", [1, 40, 600])
def test_codes_equal_the_plain_version(spark, n):
    rows = table(n, n)
    rows += [rows[0][:1] + rows[0][1:]] * 2 + [(5, None, 1), (6, [0.1] * 7 + [None], 1), (7, [float("nan")] * 8, 2), (8, [0.1] * 7 + [float("-inf")], 2), (None, [0.25] * 8, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "code": F.lit(1), "state": F.lit(2), "parts": F.lit(3)})
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.compress(df).collect())
    assert got == plain(rows)


def test_bounds_skip_and_never_err():
    rng = np.random.default_rng(1)
    x = rng.integers(-900, 900, (3000, 6))
    x[::7] = x[0]
    books = [x[rng.choice(3000, 64)]]
    state, scanned = vc.rescan(x, books[0], 0), []
    for k in range(8):
        step = 30 if k < 3 else 2
        books.append(books[-1] + rng.integers(-step, step + 1, books[-1].shape) * (rng.random((64, 1)) < 0.2))
        state, doubt = vc.assign(x, state, books)
        want = vc.distances(x, books[-1])
        assert np.array_equal(state["code"], want.argmin(axis=1))
        scanned.append(doubt.mean())
    assert min(scanned) < 0.6


def test_net_displacement_is_used():
    """Entries that move away and back cost nothing, whatever the sum of their moves."""
    x = np.array([[0, 0], [100, 100]])
    there, back = np.array([[0, 0], [100, 100]]), np.array([[60, 0], [100, 160]])
    state = vc.rescan(x, there, 0)
    state, doubt = vc.assign(x, state, [there, back, there])
    assert not doubt.any() and state["stamp"].tolist() == [0, 0]


def test_large_numbers_stay_exact():
    x = np.array([[vc.LARGEST, -vc.LARGEST], [vc.LARGEST - 1, 3]])
    assert vc.distances(x, x[::-1].copy()).tolist() == [[1 + (vc.LARGEST + 3) ** 2, 0], [0, 1 + (vc.LARGEST + 3) ** 2]]


def test_awkward_tables(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = vc.compress(spark.createDataFrame([(1, [1.0] * 6, 1), (2, [1.0] * 8, 1)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in odd] == [(None, None)] * 2
    mixed = {r.vec_id: (r.code, r.error) for r in vc.compress(spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1), (3, [1e30] * 8, 2), (4, [], 2)], SCHEMA)).collect()}
    assert mixed[1] == ("00000000", 0) and mixed[2] == mixed[4] == (None, None) and mixed[3][0] == "01010101"


def test_many_labels_are_dealt(spark, monkeypatch):
    rows = table(3, 50)
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, vc.compress(df).collect()))
    monkeypatch.setattr(vc, "SENT_LABELS", 1)
    assert sorted(map(tuple, vc.compress(df).collect())) == want
