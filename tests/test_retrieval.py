import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmill.operators import chunking, embedding, evaluation, retrieval
from opsmill.plans import text_queries
from opsmill.sources import tables

WORDS = "red green blue fast slow big small cat dog fish tree house".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = [(i, f"src{i % 3}", " ".join(rng.choices(WORDS, k=rng.randint(2, 9)))) for i in range(60)]
    rows += [(60 + i, "copy", "red cat") for i in range(30)]  # one text holds a third of the rows
    df = spark.createDataFrame(rows, "id INT, source STRING, text STRING").repartition(5)
    return rows, df.withColumn("vec", embedding.embed_tokens(F.col("text"), 16))


@pytest.fixture(scope="module")
def queries(spark):
    texts = [(1, "red cat"), (2, "big blue house house"), (3, "unseen"), (4, "slow fish")]
    df = spark.createDataFrame(texts, "query_id INT, text STRING")
    return texts, df.withColumn("vec", embedding.embed_tokens(F.col("text"), 16))


def distances(corpus, queries):
    docs = {r.id: np.array(r.vec, float) for r in corpus.select("id", "vec").collect()}
    asks = {r.query_id: np.array(r.vec, float) for r in queries.select("query_id", "vec").collect()}
    return {q: {d: round(float(((v - w) ** 2).sum()), 6) for d, w in docs.items()} for q, v in asks.items()}


def ranked(scores, k, sign=1):
    return [d for d, _ in sorted(scores.items(), key=lambda e: (sign * e[1], e[0]))[:k]]


def bm25(rows, text, k1=1.5, b=0.75):
    docs = {i: t.split() for i, _, t in rows}
    mean = sum(map(len, docs.values())) / len(docs)
    df = Counter(w for ws in docs.values() for w in set(ws))
    out = {}
    for i, ws in docs.items():
        tf, s = Counter(ws), 0.0
        for w in text.split():
            if tf[w]:
                s += math.log(1 + (len(docs) - df[w] + .5) / (df[w] + .5)) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(ws) / mean))
        if s > 0:
            out[i] = round(s, 6)
    return out


def hits(df, key="id"):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r[key])
    return out


@pytest.mark.parametrize("k", [1, 3, 200])
def test_nearest_equals_brute_force(corpus, queries, k):
    want = {q: ranked(d, k) for q, d in distances(corpus[1], queries[1]).items()}
    assert hits(retrieval.nearest(corpus[1], queries[1].select("query_id", "vec"), "id", k)) == want


def test_small_steps_and_blocks_give_the_same(corpus, queries, monkeypatch):
    want = {q: ranked(d, 3) for q, d in distances(corpus[1], queries[1]).items()}
    monkeypatch.setattr(retrieval, "MAX_SENT_QUERIES", 1)
    monkeypatch.setattr(retrieval, "QUERIES_PER_BLOCK", 2)
    monkeypatch.setattr(retrieval, "CORPUS_ROWS_PER_BLOCK", 25)
    assert hits(retrieval.nearest(corpus[1], queries[1].select("query_id", "vec"), "id", 3)) == want


@pytest.mark.parametrize("limit", [2048, 3])
def test_keyword_search_equals_brute_force(corpus, queries, monkeypatch, limit):
    monkeypatch.setattr(retrieval, "MAX_SENT_QUERIES", limit)
    got = hits(retrieval.keyword_search(corpus[1].select("id", "text"), queries[1].select("query_id", "text"), "id", 4))
    want = {q: ranked(bm25(corpus[0], t), 4, -1) for q, t in queries[0]}
    assert got == {q: w for q, w in want.items() if w}


@pytest.mark.parametrize("rows,cells,alpha,k", [(2048, 8_000_000, 0.3, 3), (3, 8_000_000, 0.3, 3), (2048, 20, 0.0, 200), (2048, 8_000_000, 1.0, 200)])
def test_hybrid_equals_brute_force(corpus, queries, monkeypatch, rows, cells, alpha, k):
    """Also with only the cell limit exceeded, and with more rows asked than there are."""
    monkeypatch.setattr(retrieval, "MAX_SENT_QUERIES", rows)
    monkeypatch.setattr(retrieval, "QUERIES_PER_BLOCK", 3)
    monkeypatch.setattr(retrieval, "MAX_SENT_CELLS", cells)
    monkeypatch.setattr(retrieval, "CELLS_PER_BLOCK", max(cells, 500))
    near = distances(corpus[1], queries[1])
    want = {}
    for q, t in queries[0]:
        d, s = near[q], bm25(corpus[0], t)
        lo, hi, top = min(d.values()), max(d.values()), max(s.values(), default=0)
        fused = {i: round(alpha * ((hi - x) / (hi - lo) if hi > lo else 1.0) + (1 - alpha) * (s.get(i, 0) / top if top else 0), 6)
                 for i, x in d.items()}
        want[q] = ranked(fused, k, -1)
    assert hits(retrieval.hybrid_search(corpus[1], queries[1], "id", k, alpha=alpha)) == want
    assert all(len(w) == min(k, 90) for w in want.values())


def test_null_and_empty_texts_have_zero_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a cat. A dog. A cat.")], "id INT, text STRING")
    got = {r.id: list(r.v) for r in df.select("id", embedding.embed_tokens(F.col("text"), 4).alias("v")).collect()}
    assert got[1] == got[2] == [0.0] * 4 and any(got[3])
    chunks = chunking.semantic(df.withColumnRenamed("id", "doc_id"))
    assert {r.doc_id for r in chunks.collect()} >= {3}


def test_filters_and_candidates_come_before_the_embedding(corpus, queries):
    near = distances(corpus[1], queries[1])
    sources = {i: s for i, s, _ in corpus[0]}
    got = hits(retrieval.filtered_search(corpus[1], queries[1].select("query_id", "vec"), "id", 3, where={"source": ["src1", "copy"]}, least=("id", 10)))
    assert got == {q: ranked({i: x for i, x in d.items() if sources[i] in ("src1", "copy") and i >= 10}, 3) for q, d in near.items()}
    texts = corpus[1].select("id", "text")
    one = hits(retrieval.rerank(texts, queries[1], "id", 5, 2, embed=lambda c: embedding.embed_tokens(c, 16)))
    assert one == hits(retrieval.rerank(corpus[1], queries[1], "id", 5, 2))


def test_rerank_orders_candidates_by_distance(corpus, queries):
    near = distances(corpus[1], queries[1])
    want = {}
    for q, t in queries[0]:
        first = ranked(bm25(corpus[0], t), 5, -1)
        if first:
            want[q] = ranked({i: near[q][i] for i in first}, 2)
    assert hits(retrieval.rerank(corpus[1], queries[1], "id", 5, 2)) == want


def test_copies_are_embedded_once_and_joined_back(spark, corpus):
    texts = corpus[1].select("id", "text")
    cache = texts.filter("text = 'red cat'").select(F.sha2("text", 256).alias("text_hash")).distinct()
    cache = cache.withColumn("vec", F.array(*[F.lit(0.5).cast("float")] * 16))
    vectors = embedding.embed_once(texts, cache, lambda c: embedding.embed_tokens(c, 16))
    assert vectors.count() == texts.select("text").distinct().count() and vectors.filter("cached").count() == 1
    joined = embedding.attach_vectors(texts, vectors)
    assert joined.count() == 90 and joined.filter("vec[0] = 0.5f and text = 'red cat'").count() == 30


def test_kept_vectors_are_never_made_again(spark, tmp_path):
    path = str(tmp_path / "vectors")
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "id LONG, text STRING")
    embed = lambda c: embedding.embed_tokens(c, 16)
    assert embedding.fill_cache(texts.where("id < 3"), path, embed) == (2, 2, 1)
    assert embedding.fill_cache(texts, path, embed) == (2, 4, 2)
    before = tables.read_published(spark, path).collect()
    assert embedding.fill_cache(texts, path, embed) == (0, 4, 2)
    embedding.compact_cache(spark, path)
    kept = tables.read_published(spark, path)
    assert sorted(map(str, kept.collect())) == sorted(map(str, before)) and tables.published_folders(spark, path) != []
    assert embedding.fill_cache(texts, path, embed) == (0, 4, 1)
    # Rows of null and empty texts keep their place.
    joined = {r.id: r.vec for r in embedding.attach_vectors(texts, kept).collect()}
    assert set(joined) == {1, 2, 3, 4, 5} and joined[1] == joined[3] and not any(joined[4])
    once = embedding.embed_once(texts, kept, embed)
    assert once.count() == 4 and once.where("not cached").isEmpty()
    assert embedding.attach_vectors(texts, embedding.embed_once(texts, kept.limit(0), embed)).count() == 5


def test_times_are_measured_per_model(spark):
    def load():
        import time

        def model(texts):
            time.sleep(0.05)
            return np.ones((len(texts), 3))
        return model

    df = spark.createDataFrame([(i, "a b") for i in range(10)], "id LONG, text STRING").coalesce(1)
    arms = {"slow": lambda c, timed: embedding.embed_with_model(c, load, timed), "fast": lambda c, timed: embedding.embed_tokens(c, 8, timed)}
    got = {r.model: r for r in embedding.embedder_times(embedding.compare_embedders(df, "id", arms)).collect()}
    assert got["slow"].n_texts == got["fast"].n_texts == 10 and got["slow"].tokens == 20
    assert got["slow"].seconds >= 0.05 > got["fast"].seconds > 0 and abs(got["slow"].seconds_per_text * 10 - got["slow"].seconds) < 1e-9


def test_model_hook_and_dimension_reduction(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "text STRING")

    def load():
        return lambda texts: np.array([[len(t), 3.0, 4.0] for t in texts])

    got = df.select(embedding.embed_with_model(F.col("text"), load).alias("v")).collect()
    assert [list(r.v) for r in got] == [[2.0, 3.0, 4.0], [4.0, 3.0, 4.0]]
    df = spark.createDataFrame([([3.0, 4.0, 9.0],), ([0.0, 0.0, 1.0],)], "v ARRAY<FLOAT>")
    got = [list(r.v) for r in df.select(embedding.reduce_dimension(F.col("v"), 2).alias("v")).collect()]
    assert got == [pytest.approx([0.6, 0.8]), [0.0, 0.0]]


def test_hit_test_works_both_ways(spark):
    rows = [(["src10"], ["src1"]), (["src1"], ["src10"]), (["a"], ["b"]), ([], ["b"]), (["a"], None)]
    df = spark.createDataFrame(rows, "e ARRAY<STRING>, r ARRAY<STRING>")
    assert [r[0] for r in df.select(evaluation.source_hit(F.col("e"), F.col("r"))).collect()] == [True, True, False, False, False]


def results(spark, rows):
    df = spark.createDataFrame(rows, "test_id INT, query STRING, arm STRING, category STRING, sources_match BOOLEAN, top_distance DOUBLE")
    return df.withColumns({"expected_sources": F.array(F.lit("s1")), "retrieved_sources": F.array("arm", F.lit("s2"), F.lit("s3"))})


def test_report_figures(spark):
    rows = [(1, "q", "a", "x", True, 1.0), (1, "q", "b", "x", False, 2.0), (2, "r", "a", "y", False, 1.0), (2, "r", "b", "y", True, 4.0)]
    df = results(spark, rows)
    assert evaluation.winner(df).first().arm == "a"  # equal accuracy: first name
    differ = evaluation.disagreement_examples(df, 1).collect()
    assert [r.outcomes for r in differ] == [["a:hit:a;s2", "b:miss:b;s2"]]
    assert evaluation.disagreements(df).count() == 2
    assert evaluation.recommendation(df, "a", "b").first().recommended == "b"
    pivot = {r.arm: (r.x, r.y) for r in evaluation.accuracy_pivot(df, "category", ["x", "y"]).collect()}
    assert pivot == {"a": (100.0, 0.0), "b": (0.0, 100.0)}
    change = evaluation.regressions(df.filter("arm = 'a'"), df.filter("arm = 'b'"))
    assert {r.test_id: r.change for r in change.collect()} == {1: "newly_failing", 2: "newly_passing"}


def test_recommendation_takes_the_better_arm_beyond_five_points(spark):
    rows = [(i, "q", arm, "x", hit, 1.0) for i in range(10) for arm, hit in (("paid", i < 9), ("free", i < 8))]
    assert evaluation.recommendation(results(spark, rows), "paid", "free").first().recommended == "paid"


def test_kappa(spark):
    rows = [(1, 1)] * 20 + [(1, 0)] * 5 + [(0, 1)] * 10 + [(0, 0)] * 15
    got = evaluation.cohen_kappa(spark.createDataFrame(rows, "a INT, b INT"), "a", "b").first()
    assert (got.observed, got.expected, round(got.kappa, 6)) == (0.7, 0.5, 0.4)


def test_turns_of_long_conversations_keep_all_their_hits(spark):
    rows = [(c, t, "user", f"word{(c * 7 + t) % 5} of turn") for c, t in ((4, 0), (4, 999), (4, 1000), (4, 2000), (5, 0), (5, 1000), (6, 0), (-1, 1000), (4, -1))]
    docs = [(d, f"word{d} of turn text", "en", "s") for d in range(5)]
    t = SimpleNamespace(conversations=spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING"),
                        documents=spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING"))
    ids = [r.query_id for r in text_queries.turn_queries(t).collect()]
    assert len(set(ids)) == len(rows) and {4000, 4999, 5000, 6000} <= set(ids)
    for build in (text_queries.nearest_for_turns, text_queries.keywords_for_turns, text_queries.hybrid_for_turns):
        got = build(t).collect()
        assert len(got) == 3 * len(rows)
        assert {q: sorted(r.rank for r in got if r.query_id == q) for q in ids} == {q: [1, 2, 3] for q in ids}


def test_pair_ids_are_unique(spark):
    pairs = [(a, b) for a in range(-12, 60) for b in range(-12, 60)] + [(2**30, 100_000), (2**30, 99_999), (2**30 + 1, 0)]
    table = spark.createDataFrame(pairs, "doc_id LONG, chunk_index LONG")
    got = {(r[0], r[1]): r[2] for r in table.select("doc_id", "chunk_index", text_queries.pair_id("doc_id", "chunk_index", 10)).collect()}
    assert len(set(got.values())) == len(pairs) and all(got[a, b] == 10 * a + b for a, b in pairs if a >= 0 and 0 <= b < 10)


def test_many_queries_meet_the_corpus_in_rounds_without_copies(spark, corpus, queries, monkeypatch):
    """Neither side is shuffled to the other: what is written is the corpus, the queries and k hits per query and task."""
    made = []
    monkeypatch.setattr(retrieval, "MAX_SENT_QUERIES", 1)
    monkeypatch.setattr(retrieval, "materialise", lambda df, name: made.append((name, df)) or df.localCheckpoint())
    want = {q: ranked(d, 3) for q, d in distances(corpus[1], queries[1]).items()}
    found = retrieval.nearest(corpus[1], queries[1].select("query_id", "vec"), "id", 3)
    assert hits(found) == want
    rows = {name: sum(df.count() for n, df in made if n == name) for name, _ in made}
    assert rows["corpus"] == 90 and rows["queries"] == 4 and rows["found"] <= 3 * 4 * 5


def test_single_precision_loses_no_near_row():
    """Distances far below the size of the vectors, copies among them."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    asked = rng.normal(1000, 1, (5, 8))
    vecs = np.vstack([asked + rng.normal(0, 1e-3, asked.shape) for _ in range(200)] + [asked])
    table = lambda key, m: pa.table({key: pa.array(range(len(m))), "vec": pa.array(list(m), pa.list_(pa.float64()))})
    exact = np.round(np.maximum((vecs * vecs).sum(1)[:, None] + (asked * asked).sum(1)[None] - 2 * np.einsum("ik,jk->ij", vecs, asked), 0), 6)
    best = list(retrieval._scan(iter([table("id", vecs)]), [retrieval.Queries(table("query_id", asked))], retrieval.Scorer("l2", 3, "id")))[0].to_pydict()
    for q in range(5):
        got = sorted(s for i, s in zip(best["query_id"], best["score"]) if i == q)
        assert got == pytest.approx(sorted(exact[:, q])[:3], abs=2e-6)


def test_vectors_are_added_up_in_bounded_steps(monkeypatch):
    import hashlib

    import pyarrow as pa
    lists = [["red", "cat"] * 40, None, [], ["é", "cat", "cat"], ["fish"], ["x"] * 9]
    sizes, add = [], embedding._row_sums
    monkeypatch.setattr(embedding, "TOKENS_PER_STEP", 12)
    monkeypatch.setattr(embedding, "_row_sums", lambda part, dim: sizes.append((len(part), len(part.flatten()))) or add(part, dim))
    got = embedding._add_up(pa.array(lists, pa.list_(pa.string())), 16).to_pylist()
    assert all(rows == 1 or tokens <= 12 for rows, tokens in sizes) and len(sizes) > 1
    for tokens, vec in zip(lists, got):
        want = np.zeros(16)
        for t in tokens or []:
            h = hashlib.md5(t.encode()).hexdigest()
            want[int(h[:7], 16) % 16] += 1 if h[7] < "8" else -1
        norm = np.sqrt((want * want).sum()) or 1.0
        assert vec == [float(x) for x in (want / norm).astype(np.float32)]


def test_both_arms_are_embedded_from_one_pass_over_the_text(spark, monkeypatch):
    docs = [(d, f"word{d} of text", "en", "s") for d in range(4)]
    t = SimpleNamespace(documents=spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING"),
                        benchmark=spark.createDataFrame([(1, "word1 of text")], "item_id LONG, text STRING"))
    written = []
    monkeypatch.setattr(text_queries, "materialise", lambda df, name: written.append(df.columns) or df.localCheckpoint())
    got = text_queries.results(t).collect()
    assert written == [["id", "source", "hash_64", "hash_256"]] and {r.arm for r in got} == {"hash_64", "hash_256"}
    assert all(r.sources_match and r.top_distance == 0 for r in got)


def test_bars_and_parts_lose_no_row(spark, monkeypatch):
    """Pilot rows, small parts and rounds, with skewed words, copies, repeated and null keys."""
    from opsmill.operators import postings
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    rows = [(i, "s", " ".join(rng.choices(words, odds, k=rng.randint(1, 40)))) for i in range(400)]
    rows += [(400 + i, "s", "w50 w1 w0") for i in range(40)]
    asked = [(q, " ".join(rng.choices(words, odds, k=rng.randint(1, 12)))) for q in range(30)] + [(30, "w50 w1"), (31, "none"), (32, None)]
    corpus = spark.createDataFrame(rows, "id INT, source STRING, text STRING").repartition(3).withColumn("vec", embedding.embed_tokens(F.col("text"), 16))
    queries = spark.createDataFrame(asked, "query_id INT, text STRING").withColumn("vec", embedding.embed_tokens(F.col("text"), 16))
    keyword = {q: ranked(bm25(rows, t or ""), 3, -1) for q, t in asked}
    near, hybrid = distances(corpus, queries), {}
    for q, t in asked:
        d, s = near[q], bm25(rows, t or "")
        lo, hi, top = min(d.values()), max(d.values()), max(s.values(), default=0)
        hybrid[q] = ranked({i: round(0.5 * ((hi - x) / (hi - lo) if hi > lo else 1.0) + 0.5 * (s.get(i, 0) / top if top else 0), 6) for i, x in d.items()}, 3, -1)
    for name, value in (("PILOT", 4), ("PILOT_ROWS", 20), ("MAX_SENT_QUERIES", 5)):
        monkeypatch.setattr(retrieval, name, value)
    monkeypatch.setattr(postings, "ENTRIES_PER_PART", 300)
    monkeypatch.setattr(postings, "QUERIES_PER_STEP", 4)
    assert hits(retrieval.keyword_search(corpus.select("id", "text"), queries.select("query_id", "text"), "id", 3)) == {q: w for q, w in keyword.items() if w}
    assert hits(retrieval.hybrid_search(corpus, queries, "id", 3)) == hybrid


def test_few_rows_are_scored_against_a_bar():
    """Frequent terms alone lead to no row, and of many copies k are held."""
    import pyarrow as pa
    from opsmill.operators import postings
    rng = np.random.default_rng(2)
    terms = [sorted({"a", "b", f"r{rng.integers(200)}"}) for _ in range(3000)] + [["a", "b"]] * 1000
    table = pa.table({"id": range(len(terms)), "terms": terms, "weights": [list(1 + 0.1 * rng.random(len(t))) if len(t) > 2 else [1.0, 1.0] for t in terms]})
    asked = pa.table({"query_id": range(50), "terms": [["a", "b", f"r{q}"] for q in range(50)], "factors": [[0.2, 0.3, 5.0]] * 50})
    made = postings.Asked(*postings.Asked.packed(asked, np.full(50, -np.inf)))
    part = postings.Part(next(postings.parts(iter([table]), made.vocabulary, "id")), len(made.vocabulary), 3)
    assert part.n <= 3003
    every = list(postings.search(part, made, 3, None))
    best = {}
    for q, at, value in ((q, a, v) for t in every for q, a, v in zip(*t, strict=True)):
        best.setdefault(q, []).append(value)
    made.bars = np.array([sorted(best[q])[-3] for q in range(50)])
    chosen = [(q, at) for q, at in postings._chosen(part, made, 3, None, None, 0, 50)]
    assert sum(len(at) for _, at in chosen) <= 50 * 5
    exact = {q: sorted((round(sum(f * w for t, w in zip(ts, ws) for u, f in zip(["a", "b", f"r{q}"], [0.2, 0.3, 5.0]) if t == u), 6)
                        for ts, ws in zip(table["terms"].to_pylist(), table["weights"].to_pylist())), reverse=True)[:3] for q in range(50)}
    got = {}
    for q, at, value in postings.search(part, made, 3, None):
        for i, v in zip(q, value):
            got.setdefault(int(i), []).append(float(v))
    assert {q: sorted(v, reverse=True)[:3] for q, v in got.items()} == {q: pytest.approx(v, abs=2e-6) for q, v in exact.items()}


def test_tokens_are_counted_inside_their_row(spark, monkeypatch, capsys):
    """No token is shuffled but those of rows that share their key."""
    monkeypatch.setattr(retrieval, "TOKENS_PER_STEP", 3)
    rows = [(1, "a b a"), (2, "c"), (3, None), (4, ""), (5, "b b b b")]
    listed = retrieval.token_lists(spark.createDataFrame(rows, "id INT, text STRING"), "id")
    got = {r.id: (dict(zip(r.terms, r.tf)), r.len) for r in listed.collect()}
    assert {i: c for i, (c, _) in got.items()} == {1: {"a": 2, "b": 1}, 2: {"c": 1}, 3: {}, 4: {}, 5: {"b": 4}} and [got[i][1] for i in (1, 4, 5)] == [3, 0, 4]
    weighted = retrieval.keyword_weights(listed, "id")
    capsys.readouterr()
    weighted.rows.explain()
    assert "Exchange" not in capsys.readouterr().out and weighted.n_docs == 5
    assert {r.term: r.df for r in weighted.frequencies.collect()} == {"a": 1, "b": 2, "c": 1}


def test_rows_that_share_their_key_are_one_document(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a c c"), (2, "a b"), (None, "b d"), (None, "d e"), (3, "e")]
    listed = retrieval.token_lists(spark.createDataFrame(rows, "id INT, text STRING"), "id")
    weighted = retrieval.keyword_weights(listed, "id")
    assert {r.term: r.df for r in weighted.frequencies.collect()} == {"a": 3, "b": 3, "c": 1, "d": 1, "e": 2}
    mean = 14 / 7
    w = lambda tf, n: tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * n / mean))
    got = {r.id: dict(zip(r.terms, r.weights)) for r in weighted.rows.collect()}
    assert got == {1: pytest.approx({"a": w(2, 2) + w(1, 3), "b": w(2, 2), "c": w(2, 3)}), 2: pytest.approx({"a": w(1, 2), "b": w(1, 2)}),
                   None: pytest.approx({"b": w(1, 2), "d": w(2, 2), "e": w(1, 2)}), 3: pytest.approx({"e": w(1, 1)})}
