"""Katz backoff next to a plain version, and its probabilities added up."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmill.llm import katz

SCHEMA = "doc_id LONG, text STRING"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</s>"]


def plain(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    one, two = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            own = tokens(t)
            one.update(own)
            two.update(zip(["<s>", *own], own))
    total, kinds = sum(one.values()), len(one)
    d1 = katz.good_turing([0, *[sum(c == r for c in one.values()) for r in range(1, 7)]])
    d2 = katz.good_turing([0, *[sum(c == r for c in two.values()) for r in range(1, 7)]])
    low = lambda d, r: float(d.lowered(np.array([r]))[0])
    p = {w: low(d1, c) / total for w, c in one.items()}
    left = 1 - sum(p.values()) if total else 1.0
    follow = defaultdict(dict)
    for (v, w), c in two.items():
        follow[v][w] = c
    weight = {v: (1 - sum(low(d2, c) for c in f.values()) / sum(f.values())) / (1 - sum(p[w] for w in f)) for v, f in follow.items()}

    def prob(v, w):
        if w in follow.get(v, {}):
            return low(d2, follow[v][w]) / sum(follow[v].values())
        return weight.get(v, 1.0) * p.get(w, left)

    out = []
    for i, t in rows:
        own = tokens(t)
        out.append((str(i), bool(held(i)), len(own), sum(w in one for w in own), total,
                    sum(math.log10((one[w] + 1) / (total + kinds + 1)) for w in own), sum(math.log10(prob(v, w)) for v, w in zip(["<s>", *own], own))))
    return sorted(out), (one, follow, prob)


def texts(seed, n=150):
    rng = random.Random(seed)
    stems = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 3, 20, 60])
        rows.append((i, " ".join(rng.choices(stems, [1 / (k + 1) for k in range(60)], k=size)).upper() + ("\n only%d" % i if i % 5 == 0 else "")))
    return rows + [(3, rows[3][1]), (None, "w1 w2 unheard"), (901, None), (902, "\t\n"), (903, "hot pair " * 400), (904, "é w1 É w1")]


def check(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "word": F.lit(1), "held_out": F.lit("y")})
    scored, model = katz.learn_and_score(table)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scored.collect())
    want, parts = plain(rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return model, parts


@pytest.mark.parametrize("seed", [1, 2])
def test_scores_equal_the_plain_version(spark, seed):
    check(spark, texts(seed))


def test_parts_blocks_and_hot_words(spark, monkeypatch):
    monkeypatch.setattr(katz, "PART_TOKENS", 400)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 150)
    monkeypatch.setattr(katz, "HOT", 90)
    model, (one, follow, _) = check(spark, texts(3))
    assert max(c for f in follow.values() for c in f.values()) > 90
    assert model.pairs.agg(F.sum("n")).first()[0] == model.total == sum(one.values())
    assert model.pairs.groupBy("context", "word").count().where("count > 1").isEmpty()


def test_probabilities_add_up(spark):
    """Over all words and one unknown, after every context, from the written tables."""
    model, _ = check(spark, texts(4, 60))
    p = {r.word: float(model.uni.lowered(np.array([r.n]))[0]) / model.total for r in model.words.collect()}
    assert sum(p.values()) + model.left == pytest.approx(1, abs=1e-12)
    follow = defaultdict(dict)
    for r in model.pairs.collect():
        follow[r.context][r.word] = r.n
    contexts = {r.context: r for r in model.contexts.collect()}
    assert set(contexts) == set(follow)
    for v, f in follow.items():
        seen = sum(float(model.bi.lowered(np.array([c]))[0]) for c in f.values()) / contexts[v].n
        unseen = 10 ** contexts[v].backoff * (model.left + sum(x for w, x in p.items() if w not in f))
        assert seen + unseen == pytest.approx(1, abs=1e-9) and 0 < seen < 1


@pytest.mark.parametrize("n", [[0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 9, 9, 9, 9, 9, 9], [0, 1, 50, 2, 0, 7, 1], [0, 900, 300, 150, 90, 60, 40]])
def test_every_count_is_lowered(n):
    r = np.arange(1, 40)
    low = katz.good_turing(n).lowered(r)
    assert (low > 0).all() and (low < r).all()


def test_nothing_to_learn_from(spark):
    assert katz.learn_and_score(spark.createDataFrame([], SCHEMA))[0].collect() == []
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = katz.learn_and_score(spark.createDataFrame([(held, "a b")], SCHEMA))[0].first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
