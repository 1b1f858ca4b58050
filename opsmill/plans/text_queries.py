"""Queries for documents, chunks, embeddings, retrieval and evaluation."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from opsmill.functions.text import token_count
from opsmill.operators import chunking, embedding, evaluation, lookups, retrieval, returns
from opsmill.plans.policy_queries import vip_windows
from opsmill.plans.registry import Tables, query, step
from opsmill.session import materialise, scratch_path
from opsmill.sources.tables import load_corpus, parse_cases, read_published, save_clean, save_report

SIZE, OVERLAP = 500, 50
ARMS = {"hash_64": 64, "hash_256": 256}
CATEGORIES = ["policy_sop", "product_knowledge", "multi_source"]
DIFFICULTIES = ["easy", "hard"]


# --- oracle text ------------------------------------------------------------

def tok(c: str) -> str:
    return rf"regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"


def trim_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def preview_sql(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) > {n} THEN substr({c}, 1, {n}) || '...' ELSE {c} END"


def pack_steps(name: str, pieces: str, glue: str) -> None:
    """Oracle of the packing: one recursion step per piece and document.
    ``pieces`` has doc_id, k (from 1), t, n, g."""
    step(f"{name}_lists", f"""
SELECT doc_id, list(t ORDER BY k) AS t, list(n ORDER BY k) AS n, list(g ORDER BY k) AS g,
       list_prepend(0::BIGINT, list(c ORDER BY k)) AS c
FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS BIGINT) AS c FROM {pieces}) GROUP BY doc_id""")
    step(f"{name}_walk", f"""
SELECT doc_id, 1 AS i, 1 AS s, 0 AS a, 0 AS b FROM {name}_lists
UNION ALL
SELECT w.doc_id, w.i + 1,
       CASE WHEN w.i = 1 OR w.i > len(l.n) THEN w.s
            WHEN l.g[w.i] <> l.g[w.i - 1] THEN w.i
            WHEN l.c[w.i] - l.c[w.s] + l.n[w.i] > {SIZE} AND w.i > w.s THEN
              coalesce(list_filter(range(w.s, w.i), lambda x: l.c[w.i] - l.c[x] <= {OVERLAP}
                AND (l.c[w.i] - l.c[x] + l.n[w.i] <= {SIZE} OR l.c[w.i] = l.c[x]))[1], w.i)
            ELSE w.s END,
       CASE WHEN w.i > 1 AND w.i > w.s AND (w.i > len(l.n) OR l.g[w.i] <> l.g[w.i - 1]
                 OR l.c[w.i] - l.c[w.s] + l.n[w.i] > {SIZE}) THEN w.s ELSE 0 END,
       w.i
FROM {name}_walk w JOIN {name}_lists l ON l.doc_id = w.doc_id WHERE w.i <= len(l.n) + 1""")
    step(name, f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY b, a) - 1 AS chunk_index, text, len({tok('text')}) AS token_count
FROM (SELECT w.doc_id, a, b, {trim_sql(f"array_to_string(l.t[a:b - 1], {glue})")} AS text
      FROM {name}_walk w JOIN {name}_lists l ON l.doc_id = w.doc_id WHERE a > 0) WHERE text <> ''""")


step("line_pieces", f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k, x AS t, len({tok('x')}) AS n, 0 AS g
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS p
      FROM documents) WHERE x <> ''""")
pack_steps("chunks_fixed", "line_pieces", "chr(10)")

_before = "whole_piece"
step(_before, f"SELECT doc_id, [1] AS p, text AS t, {SIZE} AS n, 0::UBIGINT AS g FROM documents")
for _level, (_name, _sep) in enumerate([("para", "chr(10) || chr(10)"), ("line", "chr(10)"), ("stop", "'. '"),
                                        ("word", "' '"), ("char", "''")], start=1):
    _head = "x" if _name == "char" else f"CASE WHEN i = 1 THEN x ELSE {_sep} || x END"
    step(f"split_{_name}", f"""
SELECT doc_id, p, t, n, g FROM {_before} WHERE NOT (n >= {SIZE} AND contains(t, {_sep}))
UNION ALL
SELECT doc_id, p || [CAST(i AS INTEGER)], y, len({tok('y')}), hash(p) FROM (
  SELECT doc_id, p, i, {_head} AS y FROM (
    SELECT doc_id, p, unnest(string_split(t, {_sep})) AS x, generate_subscripts(string_split(t, {_sep}), 1) AS i
    FROM {_before} WHERE n >= {SIZE} AND contains(t, {_sep}))) WHERE y <> ''""")
    _before = f"split_{_name}"
step("tree_pieces", f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k, t, n, g FROM {_before}")
pack_steps("chunks_recursive", "tree_pieces", "''")


def embed_steps(name: str, source: str, dim: int) -> None:
    """Oracle of the hashed embedding: ``source`` has id, text."""
    step(f"{name}_w", f"""
SELECT id, b, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
  SELECT id, ('0x' || substr(md5(t), 1, 7))::BIGINT % {dim} AS b,
         sum(CASE WHEN substr(md5(t), 8, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS w
  FROM (SELECT id, unnest({tok('lower(text)')}) AS t FROM {source}) GROUP BY 1, 2) WHERE w <> 0""")
    step(f"{name}_v", f"""
SELECT id, list(coalesce(w, 0)::FLOAT::DOUBLE ORDER BY d) AS v
FROM (SELECT id, unnest(range({dim})) AS d FROM {source}) LEFT JOIN {name}_w USING (id) WHERE b IS NULL OR b = d GROUP BY id
""".replace("LEFT JOIN " + name + "_w USING (id) WHERE b IS NULL OR b = d", f"s LEFT JOIN (SELECT id AS wid, b, w FROM {name}_w) ON wid = id AND b = d"))


DIST = "round(list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6)"

step("doc_texts", "SELECT doc_id AS id, text FROM documents")
step("case_texts", "SELECT item_id AS id, text FROM benchmark")
step("chunk_texts", "SELECT doc_id * 100000 + chunk_index AS id, text FROM chunks_fixed")
step("chunk_sources", """
SELECT c.doc_id * 100000 + chunk_index AS id, source, c.text FROM chunks_fixed c JOIN documents d ON d.doc_id = c.doc_id""")
embed_steps("doc64", "doc_texts", 64)
for _d in (64, 256):
    embed_steps(f"case{_d}", "case_texts", _d)
    embed_steps(f"chunk{_d}", "chunk_texts", _d)
step("cases", """
SELECT b.item_id AS test_id, CASE b.item_id % 3 WHEN 0 THEN 'policy_sop' WHEN 1 THEN 'product_knowledge' ELSE 'multi_source' END AS category,
       CASE b.item_id % 2 WHEN 0 THEN 'easy' ELSE 'hard' END AS difficulty, b.text AS query,
       coalesce(list(DISTINCT source ORDER BY source) FILTER (WHERE source IS NOT NULL), []) AS expected_sources
FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id, b.text""")
for _d in (64, 256):
    step(f"hits{_d}", f"""
SELECT test_id, source, distance, rank FROM (
  SELECT q.id AS test_id, s.source, d AS distance, row_number() OVER (PARTITION BY q.id ORDER BY d, c.id) AS rank
  FROM (SELECT q.id, c.id AS cid, {DIST} AS d FROM case{_d}_v q, chunk{_d}_v c) x
  JOIN case{_d}_v q ON q.id = x.id JOIN chunk{_d}_v c ON c.id = x.cid JOIN chunk_sources s ON s.id = c.id) WHERE rank <= 3""")
step("results", """
SELECT *, coalesce(list_bool_or(list_transform(retrieved_sources, lambda r: coalesce(list_bool_or(
         list_transform(expected_sources, lambda e: contains(r, e) OR contains(e, r))), false))), false) AS sources_match
FROM (SELECT c.*, arm, retrieved_sources, top_distance FROM cases c JOIN (
  SELECT test_id, 'hash_64' AS arm, list(source ORDER BY rank) AS retrieved_sources, min(distance) AS top_distance FROM hits64 GROUP BY 1
  UNION ALL
  SELECT test_id, 'hash_256', list(source ORDER BY rank), min(distance) FROM hits256 GROUP BY 1) h USING (test_id))""")
step("label_means", """
SELECT label AS id, list(m ORDER BY i) AS v FROM (
  SELECT label, i, avg(x)::FLOAT::DOUBLE AS m FROM (
    SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1""")


# --- Spark bindings ---------------------------------------------------------

def fixed_chunks(t: Tables):
    return chunking.fixed_size(t.documents.select("doc_id", "source", "text"), SIZE, OVERLAP, separator="\n")


def recursive_chunks(t: Tables):
    return chunking.recursive(t.documents.select("doc_id", "source", "text"), SIZE, OVERLAP)


def pair_id(one, two, factor: int):
    """One number per pair of numbers: ``one * factor + two``, which is the id in
    SQL, where that is no other pair's, and else a number below zero (Cantor's
    pairing). A pair too large for a long is an error, never another pair's id."""
    one, two = F.col(one).cast("long"), F.col(two).cast("long")
    x, y = (F.when(c < 0, -2 * c - 1).otherwise(2 * c) for c in (one, two))
    both = x + y
    half = F.when(both % 2 == 0, F.shiftright(both, 1) * (both + 1)).otherwise(both * F.shiftright(both + 1, 1))
    return F.when((one >= 0) & (two >= 0) & (two < factor), one * factor + two).otherwise(-1 - (half + y))


def chunk_corpus(t: Tables):
    return fixed_chunks(t).select(pair_id("doc_id", "chunk_index", 100000).alias("id"), "source", "text")


def cases(t: Tables):
    """Benchmark items as cases. Expected are the sources of the documents
    that contain the whole item. Both sides meet on the hash of words inside the
    item, then the text itself decides: the second to the ninth word, fewer in a
    shorter item (its first and last word may be parts of longer ones). An item
    of one or two words has none inside and meets documents on its first word."""
    words = F.split("text", r"\s+")
    items = t.benchmark.withColumn("_w", words)
    inner = F.greatest(F.least(F.size("_w") - 2, F.lit(8)), F.lit(1))
    start = F.when(F.size("_w") > 2, 2).otherwise(1)
    anchors = items.select("item_id", inner.alias("n"), F.xxhash64(F.slice("_w", start, inner)).alias("h"))
    lengths = [r.n for r in anchors.select("n").distinct().collect()]  # eight at most
    docs = t.documents

    def grams(n):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - (n - 1), F.lit(1))),
                           lambda i: F.struct(F.lit(n).alias("n"), F.xxhash64(F.slice(F.col("_w"), i, n)).alias("h")))

    shingles = docs.select("doc_id", words.alias("_w")).select("doc_id", F.explode(F.concat(*map(grams, lengths or [8]))).alias("g"))
    pairs = shingles.select("doc_id", "g.n", "g.h").join(anchors, ["n", "h"]).select("doc_id", "item_id").distinct()
    found = (pairs.join(docs.select("doc_id", "source", "text"), "doc_id")
             .join(items.select("item_id", F.col("text").alias("query")), "item_id")
             .filter(F.contains("text", F.col("query"))).select("item_id", "source").distinct()
             .groupBy("item_id").agg(F.array_sort(F.collect_list("source")).alias("expected_sources")))
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("item_id") % 3 + 1).cast("int"))
    difficulty = F.when(F.col("item_id") % 2 == 0, "easy").otherwise("hard")
    return items.join(found, "item_id", "left").select(
        F.col("item_id").alias("test_id"), category.alias("category"), difficulty.alias("difficulty"),
        F.col("text").alias("query"),
        F.coalesce("expected_sources", F.array().cast("array<string>")).alias("expected_sources"))


def embedder(dim: int):
    return partial(embedding.embed_tokens, dim=dim)


def results(t: Tables):
    """Both arms read one written table of chunks with a vector per arm, for which
    a chunk is tokenised once."""
    listed = chunk_corpus(t).select("id", "source", embedding.feature_tokens(F.col("text")).alias("tokens"))
    corpus = materialise(listed.select("id", "source", *[embedding.embed_lists(F.col("tokens"), dim).alias(name) for name, dim in ARMS.items()]), "chunks")
    arms = {name: (corpus.select("id", "source", F.col(name).alias("vec")), embedder(dim)) for name, dim in ARMS.items()}
    return evaluation.run_cases(cases(t), arms, "id")


def turn_queries(t: Tables, dim: int = 64):
    """User turns of the conversations as queries."""
    q = t.conversations.filter("role = 'user'").select(pair_id("conv_id", "turn", 1000).alias("query_id"), "text")
    return q.withColumn("vec", embedding.embed_tokens(F.col("text"), dim))


def case_queries(t: Tables, dim: int = 64):
    q = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    return q.withColumn("vec", embedding.embed_tokens(F.col("text"), dim))


def embedded_documents(t: Tables, dim: int = 64):
    return t.documents.select("doc_id", "source", "lang", "text",
                               embedding.embed_tokens(F.col("text"), dim).alias("vec"))


# --- documents and chunks ---------------------------------------------------

@query("doc_1_strip_header", r"""
WITH l AS (SELECT doc_id, i, x, trim(x, E' \t\r\n\f') <> '' AND NOT starts_with(x, '#') AND NOT starts_with(x, '*') AS ok
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
     f AS (SELECT doc_id, coalesce(min(i) FILTER (WHERE ok), 1) AS first FROM l GROUP BY 1)
SELECT l.doc_id, string_agg(x, chr(10) ORDER BY i) AS text FROM l JOIN f ON f.doc_id = l.doc_id WHERE i >= first GROUP BY 1""")
def header(t: Tables):
    return t.documents.select("doc_id", chunking.strip_header(F.col("text")).alias("text"))


@query("doc_2_token_count", f"SELECT doc_id, len({tok('text')}) AS token_count FROM documents")
def counts(t: Tables):
    return t.documents.select("doc_id", token_count(F.col("text")).alias("token_count"))


@query("doc_3_fixed_chunks", "SELECT doc_id, chunk_index, text, token_count FROM chunks_fixed")
def fixed(t: Tables):
    return fixed_chunks(t).select("doc_id", "chunk_index", "text", "token_count")


@query("doc_3_token_windows", rf"""
WITH p AS (SELECT doc_id, regexp_extract_all(text, '\s*(?:[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s])') AS p FROM documents),
 w AS (SELECT doc_id, p, unnest(range(0, 1 + ceil(greatest(len(p) - {SIZE}, 0) / {SIZE - OVERLAP})::BIGINT)) AS k FROM p WHERE len(p) > 0),
 x AS (SELECT doc_id, k AS chunk_index, least({SIZE}, len(p) - k * {SIZE - OVERLAP}) AS token_count,
              coalesce(list_sum(list_transform(p[1:k * {SIZE - OVERLAP}], lambda t: length(t))), 0)::BIGINT AS before,
              array_to_string(p[k * {SIZE - OVERLAP} + 1:k * {SIZE - OVERLAP} + {SIZE}], '') AS raw FROM w),
 y AS (SELECT *, regexp_replace(raw, '^\s+', '') AS text FROM x)
SELECT doc_id, chunk_index, token_count, before + length(raw) - length(text) AS start_char, before + length(raw) AS end_char, text FROM y""")
def token_windows(t: Tables):
    made = chunking.fixed_size(t.documents.select("doc_id", "text"), SIZE, OVERLAP, mode="window")
    return made.select("doc_id", "chunk_index", "token_count", "start_char", "end_char", "text")


@query("doc_4_recursive_chunks", "SELECT doc_id, chunk_index, text, token_count FROM chunks_recursive")
def recursive(t: Tables):
    return recursive_chunks(t).select("doc_id", "chunk_index", "text", "token_count")


# Java's look-behind split has no RE2 twin: the end mark is moved behind a
# separator character that no text contains.
step("sentences", r"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, x AS sentence FROM (
  SELECT doc_id, unnest(s) AS x, generate_subscripts(s, 1) AS i
  FROM (SELECT doc_id, string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents)) WHERE x <> ''""")
step("around_texts", """
SELECT a.doc_id * 1000000 + a.pos AS id, string_agg(b.sentence, ' ' ORDER BY b.pos) AS text
FROM sentences a JOIN sentences b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - 1 AND a.pos + 1 GROUP BY a.doc_id, a.pos""")
embed_steps("around64", "around_texts", 64)
step("semantic_gaps", """
SELECT s.doc_id, s.pos, s.sentence, round(1 - d, 9) AS distance FROM sentences s LEFT JOIN (
  SELECT a.id, CASE WHEN any_value(n.id) IS NULL THEN NULL ELSE coalesce(sum(a.w * b.w), 0) END AS d
  FROM (SELECT id, b, w FROM around64_w UNION ALL SELECT id, -1, 0 FROM around_texts) a
  LEFT JOIN around_texts n ON n.id = a.id + 1 LEFT JOIN around64_w b ON b.id = a.id + 1 AND b.b = a.b GROUP BY a.id) x
  ON x.id = s.doc_id * 1000000 + s.pos""")


def semantic_sql(limit: str) -> str:
    return f"""
WITH b AS (SELECT g.*, coalesce(distance > lim, false) AS brk FROM semantic_gaps g
           JOIN (SELECT doc_id, round({limit}, 9) AS lim FROM semantic_gaps GROUP BY 1) l USING (doc_id)),
     c AS (SELECT *, coalesce(sum(brk::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunk_index FROM b)
SELECT doc_id, chunk_index, string_agg(sentence, ' ' ORDER BY pos) AS text FROM c GROUP BY 1, 2"""


@query("doc_5_semantic_percentile", semantic_sql("quantile_cont(distance, 0.95)"))
def semantic(t: Tables):
    return chunking.semantic(t.documents.select("doc_id", "text")).select("doc_id", "chunk_index", "text")


@query("doc_5_semantic_deviation", semantic_sql("avg(distance) + 1.5 * stddev_pop(distance)"))
def semantic_deviation(t: Tables):
    df = chunking.semantic(t.documents.select("doc_id", "text"), "standard_deviation", 1.5)
    return df.select("doc_id", "chunk_index", "text")


def side_by_side(t: Tables):
    docs = t.documents.select("doc_id", "text")
    return chunking.compare_strategies(docs, {
        "fixed_size": {"chunk_size": SIZE, "chunk_overlap": OVERLAP, "separator": "\n"},
        "recursive": {"chunk_size": SIZE, "chunk_overlap": OVERLAP}, "semantic": {}})


step("chunks_semantic", semantic_sql("quantile_cont(distance, 0.95)"))
step("chunks_both", f"""
SELECT doc_id, chunk_index, text, token_count, 'fixed_size' AS strategy FROM chunks_fixed
UNION ALL SELECT doc_id, chunk_index, text, token_count, 'recursive' FROM chunks_recursive
UNION ALL SELECT doc_id, chunk_index, text, len({tok('text')}), 'semantic' FROM chunks_semantic""")


@query("doc_6_compare_strategies", "SELECT strategy, doc_id, count(*) AS n_chunks, CAST(sum(token_count) AS BIGINT) AS n_tokens FROM chunks_both GROUP BY 1, 2")
def compare(t: Tables):
    return side_by_side(t).groupBy("strategy", "doc_id").agg(
        F.count("*").alias("n_chunks"), F.sum("token_count").alias("n_tokens"))


@query("doc_7_chunk_statistics", f"""
SELECT strategy, count(*) AS n_chunks, round(avg(token_count), 6) AS avg_tokens, min(token_count) AS min_tokens,
       max(token_count) AS max_tokens, round(avg(length(text)), 6) AS avg_chars,
       arg_min({preview_sql('text', 200)}, doc_id * 100000 + chunk_index) AS first_preview FROM chunks_both GROUP BY 1""")
def statistics(t: Tables):
    return chunking.chunk_statistics(side_by_side(t), ["doc_id", "chunk_index"])


@query("doc_8_keyword_chunks", f"""
SELECT strategy, count(*) AS n_chunks, arg_min({preview_sql('text', 300)}, doc_id * 100000 + chunk_index) AS example
FROM chunks_both WHERE contains(text, 'The ') OR contains(text, 'the ') GROUP BY 1""")
def keyword(t: Tables):
    return chunking.keyword_chunks(side_by_side(t), ["The ", "the "], ["doc_id", "chunk_index"])


@query("doc_9_corpus_statistics", r"""
SELECT doc_id, source, length(text) AS chars, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words FROM documents""")
def corpus(t: Tables):
    return chunking.corpus_statistics(t.documents.select("doc_id", "source", "text"))


# --- embeddings -------------------------------------------------------------

def slots(df, key):
    return (df.select(key, F.posexplode("vec").alias("slot", "weight")).filter("weight <> 0")
            .withColumn("weight", F.col("weight").cast("double")))


@query("emb_1_embed_documents", "SELECT id AS doc_id, b AS slot, round(w::FLOAT::DOUBLE, 6) AS weight FROM doc64_w")
def embed(t: Tables):
    return slots(embedded_documents(t), "doc_id")


@query("emb_2_embed_once", """
SELECT count(*) AS distinct_texts, count(*) FILTER (WHERE c) AS from_cache, count(*) FILTER (WHERE NOT c) AS embedded
FROM (SELECT text, bool_or(lang = 'en') AS c FROM documents GROUP BY text)""")
def once(t: Tables):
    docs = t.documents
    # The cache holds the vectors of an earlier run over the English documents.
    cache = (docs.filter("lang = 'en'").select(F.sha2("text", 256).alias("text_hash"), "text").distinct()
             .select("text_hash", embedding.embed_tokens(F.col("text")).alias("vec")))
    vectors = embedding.embed_once(docs.select("doc_id", "text"), cache, embedding.embed_tokens)
    return vectors.agg(F.count("vec").alias("distinct_texts"), F.count_if("cached").alias("from_cache"),
                       F.count_if(~F.col("cached")).alias("embedded"))


@query("emb_2_kept_cache", """
WITH n AS (SELECT count(DISTINCT text) + max((text IS NULL)::INT) AS n, count(DISTINCT CASE WHEN lang = 'en' THEN text END) AS en FROM documents)
SELECT 1 AS run, en AS embedded, en AS cache_size, 1 AS folders FROM n
UNION ALL SELECT 2, n - en, n, 2 FROM n UNION ALL SELECT 3, 0, n, 2 FROM n UNION ALL SELECT 4, 0, n, 1 FROM n""")
def kept_cache(t: Tables):
    """The English documents, then all, then all again, then all after compaction."""
    path = scratch_path(t.spark, "vectors")
    docs = t.documents.select("doc_id", "text")
    runs = []
    for run, texts in enumerate((t.documents.where("lang = 'en'").select("doc_id", "text"), docs, docs, docs), start=1):
        if run == 4:
            embedding.compact_cache(t.spark, path)
        runs.append((run, *embedding.fill_cache(texts, path, embedding.embed_tokens)))
    return t.spark.createDataFrame(runs, "run INT, embedded BIGINT, cache_size BIGINT, folders INT")


@query("emb_2_attach_vectors", "SELECT id AS doc_id, b AS slot, round(w::FLOAT::DOUBLE, 6) AS weight FROM doc64_w")
def attach(t: Tables):
    docs = t.documents.select("doc_id", "text")
    cache = t.spark.createDataFrame([], "text_hash STRING, vec ARRAY<FLOAT>")
    vectors = embedding.embed_once(docs, cache, embedding.embed_tokens)
    return slots(embedding.attach_vectors(docs, vectors), "doc_id")


step("usage_log", """
SELECT CASE event_type WHEN 'view' THEN 'text-embedding-3-small' WHEN 'click' THEN 'text-embedding-3-large' ELSE event_type END AS model,
       CAST(floor(value * 10) AS BIGINT) AS tokens, value / 1000 AS seconds, event_type = 'purchase' OR value < 5 AS cached FROM events""")


@query("emb_3_usage_statistics", """
SELECT *, round(total_tokens / 1000.0 * CASE model WHEN 'text-embedding-3-large' THEN 0.00013 ELSE 0.00002 END, 6) AS total_cost,
       round(total_time / greatest(embed_count, 1), 6) AS avg_time_per_embed
FROM (SELECT model, CAST(coalesce(sum(tokens) FILTER (WHERE NOT cached), 0) AS BIGINT) AS total_tokens,
             round(coalesce(sum(seconds) FILTER (WHERE NOT cached), 0), 6) AS total_time,
             count(*) FILTER (WHERE NOT cached) AS embed_count, count(*) FILTER (WHERE cached) AS cache_hits FROM usage_log GROUP BY 1)""")
def usage(t: Tables):
    log = t.events.select(
        F.when(F.col("event_type") == "view", "text-embedding-3-small")
        .when(F.col("event_type") == "click", "text-embedding-3-large").otherwise(F.col("event_type")).alias("model"),
        F.floor(F.col("value") * 10).alias("tokens"), (F.col("value") / 1000).alias("seconds"),
        ((F.col("event_type") == "purchase") | (F.col("value") < 5)).alias("cached"))
    return embedding.usage_statistics(log)


@query("emb_4_reduce_dimension", """
SELECT vec_id, i - 1 AS slot, round((x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)))::FLOAT::DOUBLE, 6) AS weight
FROM (SELECT vec_id, unnest(embedding[1:16])::DOUBLE AS x, generate_subscripts(embedding[1:16], 1) AS i FROM embeddings)""")
def reduced(t: Tables):
    df = t.embeddings.select("vec_id", embedding.reduce_dimension(F.col("embedding"), 16).alias("vec"))
    return slots(df, "vec_id")


@query("emb_5_compare_embedders", f"""
SELECT id AS item_id, model, dim AS embedding_dim, round(v[1], 6) AS s1, round(v[2], 6) AS s2, round(v[3], 6) AS s3, round(v[4], 6) AS s4, round(v[5], 6) AS s5,
       n AS tokens, round(n / 1000.0 * 0.00002, 6) AS cost
FROM (SELECT id, 'hash_64' AS model, 64 AS dim, v FROM case64_v UNION ALL SELECT id, 'hash_256', 256, v FROM case256_v)
JOIN (SELECT item_id, len({tok('text')}) AS n FROM benchmark) ON item_id = id""")
def compare_embedders(t: Tables):
    df = embedding.compare_embedders(t.benchmark.select("item_id", "text"), "item_id",
                                     {n: embedder(d) for n, d in ARMS.items()})
    return df.select("item_id", "model", "embedding_dim", "tokens", "cost",
                     *[F.element_at("embedding_sample", i).cast("double").alias(f"s{i}") for i in range(1, 6)])


# Measured times differ from run to run, so there is no oracle.
@query("emb_5_embedder_times")
def embedder_times(t: Tables):
    df = embedding.compare_embedders(t.documents.select("doc_id", "text"), "doc_id", {n: embedder(d) for n, d in ARMS.items()})
    return embedding.embedder_times(df)


# --- retrieval --------------------------------------------------------------

def label_queries(t: Tables):
    """One query vector per label: the mean of its vectors."""
    means = (t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
             .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).cast("float").alias("m"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("e")))
    return means.select(F.col("label").alias("query_id"), F.col("e.m").alias("vec"))


step("label_hits", f"""
SELECT query_id, vec_id, d AS distance, rank FROM (SELECT q.id AS query_id, c.id AS vec_id, d, row_number() OVER (PARTITION BY q.id ORDER BY d, c.id) AS rank
FROM (SELECT q.id, c.id AS cid, {DIST} AS d FROM label_means q, (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings) c) x
JOIN label_means q ON q.id = x.id JOIN (SELECT vec_id AS id FROM embeddings) c ON c.id = x.cid) WHERE rank <= 3""")


@query("ret_1_nearest_vectors", "SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM label_hits")
def nearest_vectors(t: Tables):
    corpus = t.embeddings.select("vec_id", F.col("embedding").alias("vec"))
    return retrieval.nearest(corpus, label_queries(t), "vec_id")


@query("ret_1_nearest_chunks", f"""
SELECT query_id, id, source, rank, round(d, 6) AS distance, {preview_sql('text', 200)} AS text_preview FROM (
  SELECT x.qid AS query_id, s.id, s.source, s.text, d, row_number() OVER (PARTITION BY x.qid ORDER BY d, s.id) AS rank
  FROM (SELECT q.id AS qid, c.id AS cid, {DIST} AS d FROM case64_v q, chunk64_v c) x JOIN chunk_sources s ON s.id = x.cid) WHERE rank <= 3""")
def nearest_chunks(t: Tables):
    # Written once: the scan reads the texts, and the hits fetch theirs again.
    corpus = materialise(chunk_corpus(t), "chunks").withColumn("vec", embedding.embed_tokens(F.col("text")))
    hits = retrieval.nearest(corpus, case_queries(t).select("query_id", "vec"), "id")
    return retrieval.with_previews(hits).select("query_id", "id", "source", "rank", "distance", "text_preview")


step("case_queries", "SELECT item_id AS query_id, text FROM benchmark")
step("turn_queries", "SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user'")


def bm25_step(name: str, queries: str) -> None:
    step(name, f"""
SELECT query_id, doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / avgl)) * qn), 6) AS score
FROM (SELECT query_id, term, count(*) AS qn FROM (SELECT query_id, unnest({tok('lower(text)')}) AS term FROM {queries}) GROUP BY 1, 2) q
JOIN (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({tok('lower(text)')}) AS term FROM documents) GROUP BY 1, 2) d USING (term)
JOIN (SELECT doc_id, len({tok('text')}) AS l FROM documents) USING (doc_id)
JOIN (SELECT term, ln(1 + ((SELECT count(*) FROM documents) - df + 0.5) / (df + 0.5)) AS idf
      FROM (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({tok('lower(text)')}) AS term FROM documents) GROUP BY 1)) USING (term)
CROSS JOIN (SELECT avg(len({tok('text')})) AS avgl FROM documents) GROUP BY 1, 2""")


bm25_step("bm25", "case_queries")
bm25_step("turn_bm25", "turn_queries")
step("turn_texts", "SELECT query_id AS id, text FROM turn_queries")
embed_steps("turn64", "turn_texts", 64)


@query("ret_2_keyword_search", """
SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM bm25) WHERE rank <= 3""")
def keyword_search(t: Tables):
    return retrieval.keyword_search(t.documents.select("doc_id", "text"),
                                    case_queries(t).select("query_id", "text"), "doc_id")


step("doc_distances", f"""
SELECT q.id AS query_id, c.id AS doc_id, {DIST} AS d FROM case64_v q, doc64_v c""")


step("turn_distances", f"""
SELECT q.id AS query_id, c.id AS doc_id, {DIST} AS d FROM turn64_v q, doc64_v c""")


@query("ret_1_turns", """
SELECT query_id, doc_id, round(d, 6) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, doc_id) AS rank FROM turn_distances) WHERE rank <= 3""")
def nearest_for_turns(t: Tables):
    corpus = embedded_documents(t).select("doc_id", "vec")
    return retrieval.nearest(corpus, turn_queries(t).select("query_id", "vec"), "doc_id")


@query("ret_2_turns", """
SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM turn_bm25) WHERE rank <= 3""")
def keywords_for_turns(t: Tables):
    return retrieval.keyword_search(t.documents.select("doc_id", "text"), turn_queries(t).select("query_id", "text"), "doc_id")


@query("ret_3_turns", """
WITH r AS (SELECT query_id, min(d) AS lo, max(d) AS hi FROM turn_distances GROUP BY 1),
 m AS (SELECT query_id, max(score) AS top FROM turn_bm25 GROUP BY 1),
 f AS (SELECT x.query_id, x.doc_id, round(0.5 * CASE WHEN hi > lo THEN (hi - d) / (hi - lo) ELSE 1 END + 0.5 * coalesce(coalesce(score, 0) / top, 0), 6) AS score
       FROM turn_distances x JOIN r ON r.query_id = x.query_id LEFT JOIN m ON m.query_id = x.query_id
       LEFT JOIN turn_bm25 b ON b.query_id = x.query_id AND b.doc_id = x.doc_id)
SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f) WHERE rank <= 3""")
def hybrid_for_turns(t: Tables):
    return retrieval.hybrid_search(embedded_documents(t).select("doc_id", "text", "vec"), turn_queries(t), "doc_id")


@query("ret_3_hybrid_search", """
WITH r AS (SELECT query_id, min(d) AS lo, max(d) AS hi FROM doc_distances GROUP BY 1),
 m AS (SELECT query_id, max(score) AS top FROM bm25 GROUP BY 1),
 f AS (SELECT x.query_id, x.doc_id, round(0.5 * (hi - d) / (hi - lo) + 0.5 * coalesce(score, 0) / top, 6) AS score
       FROM doc_distances x JOIN r ON r.query_id = x.query_id JOIN m ON m.query_id = x.query_id
       LEFT JOIN bm25 b ON b.query_id = x.query_id AND b.doc_id = x.doc_id)
SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f) WHERE rank <= 3""")
def hybrid(t: Tables):
    return retrieval.hybrid_search(embedded_documents(t).select("doc_id", "text", "vec"), case_queries(t), "doc_id")


@query("ret_4_filtered_search", """
SELECT query_id, doc_id, source, d AS distance, rank FROM (SELECT x.*, source, row_number() OVER (PARTITION BY query_id ORDER BY d, x.doc_id) AS rank
FROM doc_distances x JOIN documents o ON o.doc_id = x.doc_id WHERE lang = 'en' AND source IN ('src1', 'src10')) WHERE rank <= 3""")
def filtered(t: Tables):
    corpus = embedded_documents(t).select("doc_id", "source", "lang", "vec")
    hits = retrieval.filtered_search(corpus, case_queries(t).select("query_id", "vec"), "doc_id",
                                     where={"lang": ["en"], "source": ["src1", "src10"]})
    return hits.select("query_id", "doc_id", "source", "distance", "rank")


@query("ret_5_rerank", """
SELECT query_id, doc_id, d AS distance, rank FROM (SELECT c.query_id, c.doc_id, d, row_number() OVER (PARTITION BY c.query_id ORDER BY d, c.doc_id) AS rank
FROM (SELECT * FROM bm25 WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 20) c
JOIN doc_distances x ON x.query_id = c.query_id AND x.doc_id = c.doc_id) WHERE rank <= 3""")
def rerank(t: Tables):
    return retrieval.rerank(t.documents.select("doc_id", "text"), case_queries(t), "doc_id", embed=embedding.embed_tokens)


# --- evaluation -------------------------------------------------------------

@query("evl_1_document_cases", """
SELECT category, count(*) AS n_cases FROM cases WHERE category IN ('policy_sop', 'product_knowledge', 'multi_source') GROUP BY 1""")
def case_counts(t: Tables):
    return evaluation.category_counts(cases(t))


@query("evl_2_run_cases", """
SELECT test_id, category, difficulty, arm, array_to_string(expected_sources, ',') AS expected_sources,
       array_to_string(retrieved_sources, ',') AS retrieved_sources, top_distance FROM results""")
def run_cases(t: Tables):
    return results(t).select("test_id", "category", "difficulty", "arm", "expected_sources", "retrieved_sources", "top_distance")


@query("evl_3_source_hit", "SELECT test_id, arm, sources_match FROM results")
def hits(t: Tables):
    return results(t).select("test_id", "arm", "sources_match")


@query("evl_4_accuracy", "SELECT arm, round(avg(sources_match::INT), 6) AS accuracy FROM results GROUP BY 1")
def accuracy(t: Tables):
    return evaluation.accuracy(results(t))


def pivot_sql(column: str, values: list[str]) -> str:
    cells = ", ".join(f"round(avg(sources_match::INT * 100) FILTER (WHERE {column} = '{v}'), 1) AS {v}" for v in values)
    return f"SELECT arm, {cells} FROM results GROUP BY arm"


@query("evl_5_accuracy_by_category", pivot_sql("category", CATEGORIES))
def by_category(t: Tables):
    return evaluation.accuracy_pivot(results(t), "category", CATEGORIES)


@query("evl_6_accuracy_by_difficulty", pivot_sql("difficulty", DIFFICULTIES))
def by_difficulty(t: Tables):
    return evaluation.accuracy_pivot(results(t), "difficulty", DIFFICULTIES)


@query("evl_7_mean_distance", "SELECT arm, round(avg(top_distance), 6) AS avg_distance FROM results GROUP BY 1")
def mean_distance(t: Tables):
    return evaluation.mean_distance(results(t))


@query("evl_8_run_costs", """
SELECT event_type AS arm, round(avg(value) FILTER (WHERE value >= 10), 6) AS avg_latency_ms,
       round(coalesce(sum(value / 1000) FILTER (WHERE value < 10), 0), 6) AS batch_seconds, round(sum(value / 50000), 6) AS total_cost
FROM events GROUP BY 1""")
def costs(t: Tables):
    log = t.events.select(F.col("event_type").alias("arm"), F.when(F.col("value") >= 10, "query").otherwise("batch").alias("kind"),
                          (F.col("value") / 1000).alias("seconds"), (F.col("value") / 50000).alias("cost"))
    return evaluation.run_costs(log)


step("differences", """
SELECT test_id, query, array_to_string(expected_sources, ',') AS expected_sources,
       count(*) FILTER (WHERE sources_match) AS n_hit, count(*) AS n_arms,
       string_agg(arm || ':' || CASE WHEN sources_match THEN 'hit' ELSE 'miss' END || ':'
                  || array_to_string(retrieved_sources[1:2], ';'), ',' ORDER BY arm) AS outcomes
FROM results GROUP BY 1, 2, 3 HAVING count(DISTINCT sources_match) > 1""")


@query("evl_9_disagreements", "SELECT * FROM differences")
def disagreements(t: Tables):
    return evaluation.disagreements(results(t))


@query("evl_9_examples", "SELECT * FROM differences ORDER BY test_id LIMIT 5")
def examples(t: Tables):
    return evaluation.disagreement_examples(results(t))


@query("evl_10_winner", """
SELECT arm, round(avg(sources_match::INT), 6) AS accuracy, round(avg(top_distance), 6) AS avg_distance, count(*) AS n_cases
FROM results GROUP BY arm ORDER BY avg(sources_match::INT) DESC, arm LIMIT 1""")
def best(t: Tables):
    return evaluation.winner(results(t))


@query("evl_11_recommendation", """
WITH a AS (SELECT avg(sources_match::INT * 100.0) FILTER (WHERE arm = 'hash_256') AS p, avg(sources_match::INT * 100.0) FILTER (WHERE arm = 'hash_64') AS f FROM results)
SELECT round(p, 6) AS paid_accuracy, round(f, 6) AS free_accuracy, round(p - f, 6) AS gap_points,
       CASE WHEN p - f >= 5 THEN 'hash_256' ELSE 'hash_64' END AS recommended FROM a""")
def recommend(t: Tables):
    return evaluation.recommendation(results(t), "hash_256", "hash_64")


@query("evl_12_precision_recall", """
SELECT arm, round(avg(n / 3.0), 6) AS precision_at_k, round(avg(n * 1.0 / nullif(len(expected_sources), 0)), 6) AS recall_at_k
FROM (SELECT *, len(list_intersect(list_distinct(retrieved_sources), expected_sources)) AS n FROM results) GROUP BY 1""")
def precision(t: Tables):
    return evaluation.precision_recall(results(t))


@query("evl_13_kappa", """
WITH l AS (SELECT quality AS a, 1 - toxic AS b FROM labels),
 p AS (SELECT count(*) AS total, avg((a = b)::INT) AS po FROM l),
 e AS (SELECT sum(ra * 1.0 * rb) / (SELECT total * total FROM p) AS pe FROM (SELECT a AS g, count(*) AS ra FROM l GROUP BY 1) x
       JOIN (SELECT b AS g, count(*) AS rb FROM l GROUP BY 1) y USING (g))
SELECT total, round(po, 6) AS observed, round(pe, 6) AS expected, round((po - pe) / nullif(1 - pe, 0), 6) AS kappa FROM p, e""")
def kappa(t: Tables):
    return evaluation.cohen_kappa(t.labels.withColumn("not_toxic", 1 - F.col("toxic")), "quality", "not_toxic")


@query("evl_14_regressions", """
SELECT test_id, a.sources_match AS was, b.sources_match AS now, CASE WHEN a.sources_match AND NOT b.sources_match THEN 'newly_failing'
       WHEN NOT a.sources_match AND b.sources_match THEN 'newly_passing' ELSE 'unchanged' END AS change
FROM results a JOIN results b USING (test_id) WHERE a.arm = 'hash_64' AND b.arm = 'hash_256'""")
def regressions(t: Tables):
    r = materialise(results(t).select("test_id", "arm", "sources_match"), "runs")
    return evaluation.regressions(r.filter("arm = 'hash_64'"), r.filter("arm = 'hash_256'"))


# --- sources and sinks over text and results --------------------------------

@query("src_2_load_corpus", """
SELECT lang, count(*) AS n_documents, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(ascii(text)) AS BIGINT) AS first_letters
FROM documents WHERE text <> '' GROUP BY 1""")
def load(t: Tables):
    """Documents are written as text files, some a file, and loaded file by file."""
    path = scratch_path(t.spark, "corpus")
    end = "\u0001\n"
    t.documents.where("text <> ''").select("lang", F.concat("text", F.lit("\u0001")).alias("value")).write.option(
        "maxRecordsPerFile", 100).partitionBy("lang").text(path)
    files = load_corpus(t.spark, path)
    texts = files.select(F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang"), F.explode(F.filter(F.split("text", end), lambda x: x != "")).alias("text"))
    return texts.groupBy("lang").agg(F.count("*").alias("n_documents"), F.sum(F.length("text")).alias("n_chars"), F.sum(F.ascii("text")).alias("first_letters"))


@query("src_3_parse_cases", """
SELECT test_id AS id, category, difficulty, query, array_to_string(expected_sources, ',') AS expected_sources,
       '{"n_sources":' || len(expected_sources) || '}' AS expected_data FROM cases""")
def parsed_cases(t: Tables):
    c = cases(t).select(F.col("test_id").alias("id"), "category", "difficulty", "query", "expected_sources",
                        F.struct(F.size("expected_sources").alias("n_sources")).alias("expected_data"))
    parsed = parse_cases(c.select(F.to_json(F.struct(*c.columns)).alias("value")))
    return parsed.select(F.col("id").cast("bigint").alias("id"), "category", "difficulty", "query",
                         "expected_sources", "expected_data")


@query("snk_1_replace_tables", """
SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS units,
       round(sum(order_value::DECIMAL(18, 6))::DOUBLE, 4) AS total_revenue FROM orders_f GROUP BY 1""")
def write_orders(t: Tables):
    path = scratch_path(t.spark, "clean")
    save_clean(t.products, t.customers, t.valued_lines, path)
    value = F.col("order_value").cast("decimal(18, 6)")
    return read_published(t.spark, f"{path}/orders").groupBy("order_month").agg(
        F.count("*").alias("n_lines"), F.sum("quantity").alias("units"), F.sum(value).alias("total_revenue"))


@query("snk_2_nested_report", """
SELECT test_id, arm, sources_match, len(retrieved_sources) AS n_retrieved, top_distance FROM results""")
def write_report(t: Tables):
    path = scratch_path(t.spark, "report")
    save_report(results(t), path)
    schema = "test_id BIGINT, arm STRING, sources_match BOOLEAN, top_distance DOUBLE, retrieved ARRAY<STRUCT<rank: INT, source: STRING>>"
    return t.spark.read.schema(schema).json(path).select(
        "test_id", "arm", "sources_match", F.size("retrieved").alias("n_retrieved"), "top_distance")


def product_facts(t: Tables):
    # Merged, as either side may be too many rows for the driver.
    goods = t.products.select("product_id", "name", "category", "price", "stock_level")
    return goods.join(t.raw_products.select("product_id", "discontinued").hint("merge"), "product_id")


step("pack_facts", """
SELECT d.*, p.name AS product_name, p.category, p.price, p.stock_level, p.discontinued, c.state, o.total_orders,
       s.order_value, s.carrier, CAST(s.ordered_at AS VARCHAR) AS ordered_at, CAST(s.delivered_on AS VARCHAR) AS delivered_on,
       concat_ws(' ', replace(inputs ->> '$.item_condition', '_', ' '), 'return of', CASE WHEN p.discontinued THEN 'discontinued' END,
                 coalesce(lower(string_split(p.category, ' ')[1]), 'unknown'), 'product', replace(inputs ->> '$.window_rule', '_', ' '), 'window',
                 decision, coalesce(replace(refund_form, '_', ' '), 'no refund')) AS request_text
FROM decided d LEFT JOIN (SELECT c.product_id, c.name, c.category, c.price, c.stock_level, r.discontinued
                          FROM products_c c JOIN raw_products r ON r.product_id = c.product_id) p ON p.product_id = d.product_id
LEFT JOIN customers_c c ON c.customer_id = d.customer_id
LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS total_orders FROM orders_c WHERE customer_id > 0 GROUP BY 1) o
       ON o.customer_id = d.customer_id AND c.customer_id IS NOT NULL
LEFT JOIN shipments s ON s.order_id = d.order_id""")
step("pack_texts", "SELECT row_number() OVER (ORDER BY text) AS id, text FROM (SELECT DISTINCT request_text AS text FROM pack_facts)")
embed_steps("pack64", "pack_texts", 64)


@query("pol_34_evidence_pack", f"""
WITH x AS (SELECT q.id AS qid, c.id AS cid, {DIST} AS d FROM pack64_v q, chunk64_v c),
 h AS (SELECT qid, s.source, s.text, d, row_number() OVER (PARTITION BY qid ORDER BY d, cid) AS rank FROM x JOIN chunk_sources s ON s.id = cid),
 e AS (SELECT t.text AS request_text, string_agg(source, ',' ORDER BY rank) AS sources, round(min(d), 6) AS top_distance,
              min({preview_sql('h.text', 200)}) FILTER (WHERE rank = 1) AS top_preview
       FROM h JOIN pack_texts t ON t.id = qid WHERE rank <= 3 GROUP BY 1)
SELECT order_id, line_no, product_id, customer_id, decision, refund_form, approval, rules, product_name, category, stock_level, discontinued,
       state, total_orders, round(order_value, 6) AS order_value, carrier, ordered_at, delivered_on, request_text, sources, top_distance, top_preview
FROM pack_facts LEFT JOIN e USING (request_text)""")
def evidence(t: Tables):
    goods = product_facts(t)
    people = t.customers.select("customer_id", "state").join(lookups.customer_orders(t.lines).select("customer_id", "total_orders"), "customer_id", "left")
    orders = t.shipments.select("order_id", "order_value", "carrier", "ordered_at", "delivered_on")

    def retrieve(texts):
        # Written once: the scan reads the texts, and the hits fetch theirs again.
        corpus = materialise(chunk_corpus(t), "chunks").withColumn("vec", embedding.embed_tokens(F.col("text")))
        asked = texts.select("query_id", embedding.embed_tokens(F.col("text")).alias("vec"))
        return retrieval.with_previews(retrieval.nearest(corpus, asked, "id"))

    df = returns.evidence_pack(returns.decide(vip_windows(t), t.raw_products), goods, people, orders, retrieve, "id")
    best = F.col("evidence")[0]
    return df.select("order_id", "line_no", "product_id", "customer_id", "decision", "refund_form", "approval", "rules",
                     F.col("product.name").alias("product_name"), "product.category", "product.stock_level", "product.discontinued",
                     "customer.state", "customer.total_orders", "order.order_value", "order.carrier", "order.ordered_at", "order.delivered_on",
                     "request_text", F.col("evidence.source").alias("sources"), best["distance"].alias("top_distance"), best["text_preview"].alias("top_preview"))
