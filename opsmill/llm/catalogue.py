"""The queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from opsmill.llm import chat, classifier, decontaminate, katz, minhash, pieces, pii, quality_rules, spelling, substring, toxicity, url_filter, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@query
def op4_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", *[F.col(f"quality.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "lost_chars", "base_failed", "kept")])


_RULES = quality_rules.LineRules()
_PHRASES = " + ".join(f"contains(lower(line), '{p}')::INT" for p in quality_rules.BOILERPLATE)
_LEAD = rf"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{0,{_RULES.max_lead_words}}}[^\x20\x09-\x0D]{{0,2}}(?:{'|'.join(quality_rules.BOILERPLATE)})"
ORACLES["op4_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1) GROUP BY doc_id
), ln AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), v AS (
  SELECT *, {_PHRASES} AS phrases, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS sym, len(regexp_extract_all(line, '(?:^|[\x20\t])[|>](?:[\x20\t]|$)')) AS bars,
         len(regexp_extract_all(line, '\p{{Lu}}')) AS up, len(regexp_extract_all(line, '\p{{L}}')) AS letters,
         len(list_filter(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: regexp_matches(x, '[^!]!+$'))) AS bangs FROM ln
), f AS (
  SELECT doc_id, chars, nth, nth > 1 OR sym > 0.1::DOUBLE * chars OR (words >= 3 AND bars > 0.2::DOUBLE * words)
         OR (regexp_matches(line, '\p{{Lu}}{{4}}') AND letters >= 12 AND up > 0.6::DOUBLE * letters)
         OR (words >= 3 AND bangs > 0.3::DOUBLE * words)
         OR (phrases > 0 AND ({_RULES.words_per_phrase} * phrases >= words OR regexp_matches(lower(line), '{_LEAD}'))) AS gone FROM v
), l AS (
  SELECT doc_id, count(*) FILTER (nth > 1) AS n_dup, count(*) FILTER (gone) AS n_gone, coalesce(sum(chars) FILTER (gone), 0)::BIGINT AS lost
  FROM f GROUP BY doc_id
), q AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_gone, 0)::BIGINT AS n_removed_lines, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN l USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q)
SELECT *, NOT base_failed AND lost_chars <= 0.3::DOUBLE * word_chars AS kept FROM b
"""


# The rules the contract of op6 fixes, and a list of hosts to block, most of which the corpus lacks.
URL_RULES = tuple(url_filter.Rule(v, h, p) for v, h, p in (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/")))
LISTED_SITES = ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x", "quick-loans", "fake-shop", "phish-net")
LISTED_PREFIXES = ("", "www.", "m.", "blog.", "shop.", "cdn.", "news.")
LISTED_DOMAINS = ("example.com", "example.net", "example.org", "example.edu")
LISTED_HOSTS = tuple(f"{p}{s}.{d}" for s in LISTED_SITES for p in LISTED_PREFIXES for d in LISTED_DOMAINS)


@query
def op6_url_filter(spark: SparkSession, root: str) -> DataFrame:
    pages = table(spark, root, "pages").select("page_id", "url")
    listed = spark.createDataFrame([(h,) for h in LISTED_HOSTS], "host STRING")
    return url_filter.judge(pages, URL_RULES, listed).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op6_url_filter"] = f"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT h.page_id, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS b
  FROM h JOIN rules r ON (h.host = r.host OR h.host LIKE '%.' || r.host) AND starts_with(h.path, r.path)
  GROUP BY h.page_id
)
SELECT h.page_id, h.host, h.path, b.rule AS rule,
       coalesce(b.verdict, CASE WHEN h.host IN ({", ".join(f"'{h}'" for h in LISTED_HOSTS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN best USING (page_id)
"""


@query
def op7_chat_format(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.expand(rows.unionByName(own)))


ORACLES["op7_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         18 + length(replace(replace(role, '\', '\\'), '|', '\|'))
         + length(regexp_replace(replace(text, '\', '\\'), '(<|\[)(\||/?s>|/?INST\])', '\1\\\2', 'g')) AS len
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), s AS (
  SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


@query
def op2_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    hits = decontaminate.scan(docs.select("doc_id", F.col("text").alias("body")), table(spark, root, "benchmark"), "body")
    n_hit = F.aggregate("word_spans", F.lit(0), lambda n, s: n + s.end - s.start)
    return hits.select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_DECON_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
ORACLES["op2_decontaminate"] = f"""
WITH b AS (SELECT item_id, {_DECON_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS win, item_id
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), d AS (SELECT doc_id, {_DECON_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, i, s.size, array_to_string(w[i:i + s.size - 1], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT size FROM bw) s
  WHERE i + s.size - 1 <= len(w)
), hit AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw ON bw.win = dw.win AND bw.size = dw.size),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query
def op3_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    kept = substring.remove_copies(docs, with_text=False)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op3_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM win) WHERE k > 1
), gone AS (
  SELECT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM dup) GROUP BY ALL
), kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
  ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.p = x.p GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op1_minhash(spark: SparkSession, root: str) -> DataFrame:
    return minhash.classes(table(spark, root, "documents").select("doc_id", "text"))


ORACLES["op1_minhash"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), g AS (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links),
r AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.id),
f AS (SELECT id, min(c) AS component_id FROM r GROUP BY id),
cls AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY sig) AS class_id
  FROM (SELECT doc_id, md5(string_agg(sh, chr(1) ORDER BY sh)) AS sig FROM s GROUP BY doc_id)
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(class_id, d.doc_id) AS class_id, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN cls USING (doc_id) JOIN f ON f.id = d.doc_id
"""


@query
def op5_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    made = pieces.round_trip(spark, docs)
    return made.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@query
def op8_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    return classifier.score_documents(table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "labels"))


@query
def op9_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.score_documents(table(spark, root, "documents").select("doc_id", "text"), table(spark, root, "labels"))


@query
def op10_pii(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", F.col("text").alias("body"))
    found = pii.detect(docs, pii.fit(docs, "body"), "body")
    show = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("pii", lambda s: s.base)

    def count(kind):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS],
        F.sha2(show(base), 256).alias("base_sha256"), show(F.col("pii")).alias("spans"))


_CRC_TABLE = ("list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], "
              "lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def crc32_sql(text: str, crc_table: str = "crc_table") -> str:
    """crc32 of the UTF-8 bytes of ``text`` as a DuckDB expression; ``crc_table`` is a list of 256 numbers."""
    digits = f"hex(encode({text}))"
    codes = f"list_transform(range(length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, x: xor(c >> 8, {crc_table}[(xor(c, x) & 255) + 1])), 4294967295)"


@query
def op11_katz_backoff(spark: SparkSession, root: str) -> DataFrame:
    scored, _ = katz.learn_and_score(table(spark, root, "documents").select("doc_id", "text"))
    # Engines add up in different orders.
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def _discounts(name: str, counts: str) -> str:
    """CTEs: ``name``_p (the trend's power) and ``name`` (r, low) for r up to SMALL, from a table of counts."""
    most = katz.SMALL
    return f"""{name}_n AS (SELECT r, (SELECT count(*) FROM {counts} WHERE n = r) AS k FROM (SELECT unnest(range(1, {most + 2})) AS r)),
{name}_p AS (SELECT least(coalesce(regr_slope(ln(k), ln(r)), -2), -1.1) + 1 AS power FROM {name}_n WHERE k > 0),
{name} AS (
  SELECT a.r, CASE WHEN b.k > 0 AND a.k > 0 AND (a.r + 1) * b.k / a.k < a.r THEN (a.r + 1) * b.k / a.k ELSE a.r * pow(1 + 1 / a.r, power) END AS low
  FROM {name}_n a JOIN {name}_n b ON b.r = a.r + 1, {name}_p
)"""


def _lowered(name: str, counts: str) -> str:
    """A table of counts with ``low``, the lowered count."""
    return f"""SELECT t.*, coalesce(d.low, t.n * pow(1 + 1 / t.n, power)) AS low FROM {counts} t LEFT JOIN {name} d ON d.r = t.n, {name}_p"""


ORACLES["op11_katz_backoff"] = rf"""
WITH c AS (SELECT {_CRC_TABLE} AS crc_table),
d AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce({crc32_sql("doc_id::VARCHAR")} % 7 = 2, false) AS held_out,
         list_append(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[\x20\x09-\x0D]+'), lambda x: x <> ''), ' end') AS w FROM documents, c
), t AS MATERIALIZED (SELECT row, held_out, unnest(list_prepend(' start', w[:-2])) AS v, unnest(w) AS w FROM d),
one AS MATERIALIZED (SELECT w, count(*) AS n FROM t WHERE NOT held_out GROUP BY w),
two AS MATERIALIZED (SELECT v, w, count(*) AS n FROM t WHERE NOT held_out GROUP BY v, w),
{_discounts("uni", "one")}, {_discounts("bi", "two")},
lone AS (SELECT coalesce(sum(n), 0)::BIGINT AS total, count(*) AS kinds FROM one),
p AS MATERIALIZED (SELECT w, n, low / total AS p FROM ({_lowered("uni", "one")}), lone),
rest AS (SELECT CASE WHEN count(*) = 0 THEN 1.0 ELSE 1 - sum(p) END AS p FROM p),
pair AS MATERIALIZED ({_lowered("bi", "two")}),
ctx AS (
  SELECT v, sum(pair.n) AS n, sum(pair.n - pair.low) / sum(pair.n) / (1 - sum(p.p)) AS weight FROM pair JOIN p USING (w) GROUP BY v
), s AS (
  SELECT t.row, count(*) AS n_tokens, count(p.n) AS n_known, sum(log10(coalesce(p.n, 0) + 1)) AS base,
         sum(CASE WHEN pair.n IS NOT NULL THEN log10(pair.low / ctx.n) ELSE log10(coalesce(ctx.weight, 1)) + log10(coalesce(p.p, rest.p)) END) AS score
  FROM t LEFT JOIN p ON p.w = t.w LEFT JOIN pair ON pair.v = t.v AND pair.w = t.w LEFT JOIN ctx ON ctx.v = t.v, rest GROUP BY t.row
)
SELECT doc_id, held_out, n_tokens, n_known, total AS train_tokens, round(base - n_tokens * log10(total + kinds + 1), 6) AS base_score, round(score, 6) AS score
FROM d JOIN s USING (row), lone
"""


@query
def op12_vector_codes(spark: SparkSession, root: str) -> DataFrame:
    return vector_codes.compress(table(spark, root, "embeddings"))


def _vector_rounds() -> str:
    """Codebooks c0 to c4 and assignments a0 to a4 as CTEs."""
    out = []
    for k in range(vector_codes.ROUNDS + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT x.row, x.p, min(struct_pack(d := list_sum(list_transform(range(1, len(x.e) + 1), lambda i: (x.e[i] - c.c[i]) * (x.e[i] - c.c[i])))::BIGINT, j := c.j)) AS b
  FROM x JOIN c{k} c ON c.p = x.p GROUP BY x.row, x.p
)""")
        if k < vector_codes.ROUNDS:
            out.append(f"""m{k} AS (
  SELECT p, j, list(m ORDER BY i) AS c FROM (
    SELECT p, j, i, floor(sum(v)::DOUBLE / count(*))::BIGINT AS m FROM (
      SELECT a.p, a.b.j AS j, unnest(x.e) AS v, generate_subscripts(x.e, 1) AS i FROM a{k} a JOIN x ON x.row = a.row AND x.p = a.p)
    GROUP BY p, j, i) GROUP BY p, j
), c{k + 1} AS MATERIALIZED (SELECT c.p, c.j, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.j = c.j)""")
    return ",\n".join(out)


ORACLES["op12_vector_codes"] = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE}::DOUBLE * x)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT row, p, e[p * len(e) // {vector_codes.PARTS} + 1:(p + 1) * len(e) // {vector_codes.PARTS}] AS e FROM v, (SELECT unnest(range({vector_codes.PARTS})) AS p)
), c0 AS MATERIALIZED (SELECT p, row - 1 AS j, e AS c FROM x WHERE row <= {vector_codes.ENTRIES}),
{_vector_rounds()},
s AS (
  SELECT row, string_agg(printf('%02x', b.j), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error FROM a{vector_codes.ROUNDS} GROUP BY row
), h AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{vector_codes.ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN s USING (row), h
"""


@query
def op13_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return spelling.variants(table(spark, root, "documents").select("doc_id", "text"))


ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE c AS (SELECT {_CRC_TABLE} AS crc_table),
r AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY ALL
), h AS (SELECT run, k, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM r, c),
w AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), p AS (
  SELECT x.word AS a, y.word AS b, y.n AS n FROM d x JOIN d y ON x.i = y.i AND x.d = y.d AND x.word <> y.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.d = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.d = w.word
), b AS (SELECT a AS word, count(*) AS n_near, max(n) AS best_n FROM p GROUP BY a),
f AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 10 * w.n THEN b.best_n END AS form_n,
         CASE WHEN b.best_n >= 10 * w.n THEN (SELECT min(p.b) FROM p WHERE p.a = w.word AND p.n = b.best_n) END AS form
  FROM w LEFT JOIN b USING (word)
), up AS (
  SELECT word, word AS root FROM f UNION SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up USING (word) JOIN f g ON g.word = up.root WHERE g.form IS NULL
"""


@query
def pipeline(spark: SparkSession, root: str) -> DataFrame:
    return corpus_pipeline.run(spark, root)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
