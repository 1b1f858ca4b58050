"""Chat, URL, tokeniser, classifier, toxicity and PII operators."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsmill.llm import chat, classifier, pieces, pii, tagger, toxicity, url_filter

SCHEMA = "doc_id LONG, text STRING"


# --- chat -------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be <|end|>\n kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "a\\<|turn:x|>\n"), (1, 3, "user", "more"),
    (2, 5, "user", None), (2, 6, "assistant", ""), (2, 6, "assistant", "twice"), (2, 6, "assistant", "twice"), (3, 0, "user", "alone"),
    (None, 0, "assistant", "no id"), (4, None, "odd|>\nrole\\", "x"), (4, 1, None, "y"), (4, 2, "assistant", "z" * 5000),
]


def test_chat_reads_back_what_it_wrote(spark):
    table = spark.createDataFrame(TURNS, "conv_id LONG, turn LONG, role STRING, text STRING").withColumns({"example": F.lit(1), "last": F.lit(2)})
    examples = chat.expand(table)
    by = {}
    for c, t, r, x in TURNS:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    by = {c: sorted(v) for c, v in by.items()}
    assert examples.count() == sum(max(1, sum(r == "assistant" for _, r, _ in v) + (v[-1][1] != "assistant" and any(r == "assistant" for _, r, _ in v))) for v in by.values())
    for r in examples.withColumns({"turns": chat.read_turns(F.col("text")), "loss": chat.read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end"))}).collect():
        own = by[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in own[:len(r.turns)]]
        assert r.loss == (own[len(r.turns) - 1][2] if own[len(r.turns) - 1][1] == "assistant" else "")
    for r in chat.digests(examples).collect():
        assert r.n_turns == len(by[r.conv_id])
        assert r.loss_chars == sum(len(x) for _, role, x in by[r.conv_id] if role == "assistant")
    assert chat.digests(chat.expand(table.limit(0))).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "\\\\<|", "<|end|>\n", "<s></s>[INST][/INST]", "[/INST]<<|>", "<\\|end|>"])
def test_escapes_are_reversible(spark, text):
    r = spark.createDataFrame([(text,)], "t STRING").select(chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e"))).first()
    assert r.u == text and not re.search(r"<\||</?s>|\[/?INST\]", r.e)


# --- urls -------------------------------------------------------------------

def test_url_parts_rules_and_listed_hosts(spark):
    urls = ["http://A.Example.ORG/es/x?y", "https://example.org/en/12#z", "http://notexample.org/es/", "x.com/fr/", None, "", "ftp://M.com/de/?q", "a://b.com/fr/1",
            "http://bad.net/x", "http://www.bad.net", "http://bad.net?x=/fr/", "http://good.net/", "http:///p", "s://h/é/日?x"]
    rules = tuple(url_filter.Rule(*r) for r in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")))
    table = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id LONG, url STRING").withColumns({"host": F.lit("x"), "verdict": F.lit(0), "shard": F.lit(1)})
    listed = spark.createDataFrame([("bad.net",), ("bad.net",), (None,), ("elsewhere.net",)], "host STRING")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table, rules, listed).collect()}
    assert got == {
        0: ("a.example.org", "/es/x", "example.org/es/", "block"), 1: ("example.org", "/en/12", "example.org/en/1", "block"),
        2: ("notexample.org", "/es/", "org/", "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
        6: ("m.com", "/de/", "com/de/", "block"), 7: ("b.com", "/fr/1", "com/fr/", "allow"), 8: ("bad.net", "/x", None, "block"),
        9: ("www.bad.net", "", None, "allow"), 10: ("bad.net", "", None, "block"), 11: ("good.net", "/", None, "allow"), 12: ("", "/p", None, "allow"),
        13: ("h", "/é/日", None, "allow")}
    assert url_filter.judge(table.limit(0), rules, listed).count() == 0
    assert url_filter.judge(table, (), listed.limit(0)).where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("shards,room", [(1, 32 << 20), (7, 500)])
def test_cascade_is_exact_for_the_universe(spark, monkeypatch, shards, room):
    monkeypatch.setattr(url_filter, "MAX_SENT_BYTES", room)
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)  # many false positives, so many levels
    hosts = spark.range(4000).select(F.concat(F.lit("h"), "id", F.lit(".net")).alias("host"))
    listed = hosts.where(F.crc32("host") % 3 == 0)
    cascade = url_filter.build(hosts, listed, shards).cache()
    assert cascade.agg(F.max("level")).first()[0] >= 2
    marked = url_filter.mark_listed(hosts, "host", cascade, shards)
    assert marked.where(F.col("listed") != (F.crc32("host") % 3 == 0)).count() == 0


# --- pieces -----------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(pieces.default_path(), 0.7)


ODD = ["", " ", "  a", "a  ", "▁ literal ▁▁", "日本語 テキスト", "😀é\u0301", "line\nline\n\n x", "\t\r\n", "<0x0A> <s> </s>", "x" * 300, "the the the", "\x00\x01"]


def test_pieces_decode_to_the_text_and_follow_the_row_key(spark, vocabulary):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, "the " * 400), (None, "the same"), (None, "the same")]
    rows += [(100 + i, "".join(rng.choice("abcdeé \n▁日") for _ in range(rng.randrange(200)))) for i in range(30)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"pieces": F.lit(1), "decoded": F.lit(2), "__key": F.lit(3)}).drop("__key")
    made = pieces.decode(pieces.encode(table, vocabulary, F.col("doc_id")), vocabulary)
    got = made.collect()
    assert len(got) == len(rows) and all(r.decoded == r.text for r in got)
    assert all((r.pieces is None) == (r.text is None) for r in got)
    again = {(r.doc_id, r.text): r.pieces for r in pieces.encode(table.repartition(7), vocabulary, F.col("doc_id")).collect()}
    assert all(again[r.doc_id, r.text] == r.pieces for r in got)
    other = pieces.encode(table.where("doc_id = 91"), vocabulary, F.col("doc_id"), seed=1).first()
    assert other.pieces != again[91, "the " * 400]
    assert pieces.encode(table.limit(0), vocabulary, F.col("doc_id")).count() == 0


def test_draws_follow_the_lattice(vocabulary):
    unit, n = " there", 40_000
    ways = Counter()

    def walk(j, ids, w):
        if j == 0:
            ways[tuple(reversed(ids))] += w
        for i, piece, weight in pieces.arcs(unit, vocabulary)[j] if j else ():
            walk(i, [*ids, piece], w * weight)

    walk(len(unit), [], 1.0)
    total = sum(ways.values())
    ids, sizes = pieces.sample([unit] * n, np.arange(n, dtype=np.int64), pieces._Lookup(vocabulary))
    seen, at = Counter(), 0
    for k in sizes.tolist():
        seen[tuple(ids[at:at + k].tolist())] += 1
        at += k
    for way, w in ways.items():
        share = w / total
        assert abs(seen[way] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4
    assert set(seen) <= set(ways)


def test_short_and_long_units_are_filtered_alike(vocabulary, monkeypatch):
    units = [" the", "there", "  x", "\n", " überall", "abcabcabc"]
    lookup = pieces._Lookup(vocabulary)
    together = pieces.sample(units, np.arange(len(units), dtype=np.int64), lookup)
    monkeypatch.setattr(pieces, "LONG_UNIT", 0)
    alone = pieces.sample(units, np.arange(len(units), dtype=np.int64), lookup)
    assert together[0].tolist() == alone[0].tolist() and together[1].tolist() == alone[1].tolist()


# --- classifier -------------------------------------------------------------

def test_discriminant_equals_the_densities(spark):
    rng = np.random.default_rng(0)
    d = len(classifier.FEATURES)
    x = np.vstack([rng.normal(0, 1, (60, d)), rng.normal(1.5, 2, (80, d))])
    y = np.array([0] * 60 + [1] * 80)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "x ARRAY<DOUBLE>, y INT")
    model = classifier.fit(rows, 0.3)
    pooled = np.diag(sum(np.cov(x[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))) + classifier.RIDGE
    logs = []
    for c in (0, 1):
        cov = 0.7 * np.cov(x[y == c].T, bias=True) + np.diag(0.3 * pooled)
        e = x - x[y == c].mean(axis=0)
        logs.append(np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", e, np.linalg.inv(cov), e))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -30, 30))), atol=1e-6)


def test_quality_scores_of_odd_rows(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(f"{'Ab' if i % 2 else 'xy###'}{rng.randrange(50)}" for _ in range(40)) + ".") for i in range(80)]
    docs += [(900, None), (901, ""), (902, " \n"), (None, "x"), (3, docs[3][1]), (903, "é" * 50_000)]
    table = spark.createDataFrame(docs, SCHEMA).withColumns({"x": F.lit(1), "id": F.lit(2), "y": F.lit(0)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (5, None), (6, 7)], "doc_id LONG, quality INT")
    got = classifier.score_documents(table, labels).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id is not None and r.doc_id < 80:
            assert r.predicted == r.doc_id % 2
    few = classifier.score_documents(table, labels.limit(0)).collect()
    assert {r.score for r in few} == {0.5} and len(few) == len(docs)
    assert classifier.score_documents(table.limit(0), labels).count() == 0


def test_a_list_much_longer_than_the_corpus(spark):
    """Listed hosts that the corpus lacks make no shard larger."""
    pages = spark.createDataFrame([(1, "http://h7.net/a"), (2, "http://other.net/"), (3, "x://" + "h" * 100_000 + ".net/" + "p" * 100_000)], "page_id LONG, url STRING")
    listed = spark.range(30_000).select(F.concat(F.lit("h"), "id", F.lit(".net")).alias("host"))
    hosts = pages.select(url_filter.split_url(F.col("url"))[0].alias("host"))
    cascade = url_filter.build(hosts, listed, 1).collect()
    assert [(r.level, r.size) for r in cascade][0] == (0, 64) and sum(len(r.bits) for r in cascade) < 100
    got = {r.page_id: (r.verdict, len(r.path)) for r in url_filter.judge(pages, (), listed).collect()}
    assert got == {1: ("block", 2), 2: ("allow", 1), 3: ("allow", 100_001)}


def test_rules_of_equal_length(spark):
    """The longer path decides, then the text."""
    rules = tuple(url_filter.Rule(*r) for r in (("block", "b.aa.com", "/"), ("allow", "aa.com", "/xx"), ("block", "aa.com", "/x")))
    pages = spark.createDataFrame([(1, "http://b.aa.com/xx"), (2, "http://b.aa.com/y"), (3, "http://aa.com/x")], "page_id LONG, url STRING")
    none = spark.createDataFrame([], "host STRING")
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules, none).collect()} == {
        1: ("aa.com/xx", "allow"), 2: ("b.aa.com/", "block"), 3: ("aa.com/x", "block")}


# --- toxicity ---------------------------------------------------------------

def test_folding():
    assert toxicity.fold("Th1s  is\u200b а C1οWN!") == toxicity.fold("this is a clown")
    assert toxicity.fold(None) == toxicity.fold(" ,. ") == ""


def test_toxicity_learns_folds_and_excepts(spark):
    rng = random.Random(5)
    bad, plain = ("grobnak", "zurfel"), [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(plain, k=60)
        if i % 4 == 0:
            words[rng.randrange(60)] = bad[i % 3 % 2]
            words[rng.randrange(60)] = bad[0] + "s"
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, "You GR0BN4K of a zurf3l"), (901, None), (902, ""), (903, "grobnak bin " * 3), (904, "gr\u043ebnak"), (None, "worda"), (900, "You GR0BN4K of a zurf3l")]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"weight": F.lit(1), "y": F.lit(0)})
    names = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id LONG, toxic INT")
    got = toxicity.score_documents(table, names, exceptions=("grobnak bin",)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.predicted for r in got}
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert (by[900], by[901], by[902], by[903], by[904], by[None]) == (1, 0, 0, 0, 1, 0)
    assert {r.predicted for r in toxicity.score_documents(table, names.limit(0)).collect()} == {0}
    assert toxicity.score_documents(table.limit(0), names).count() == 0


@pytest.mark.parametrize("word", [
    "ｇｒｏｂｎａｋ", "\U0001d420\U0001d42b\U0001d428\U0001d41b\U0001d427\U0001d41a\U0001d424", "gröbnäk", "gro\u0301bnak", "GRÖBNAK",
    "grob-nak", "g.r.o.b.n.a.k", "(gr0b_nak)", "grobnak", "go!grobnak"])
def test_each_disguise_of_a_word_meets_the_lexicon(word):
    auto = toxicity._automaton({"grobnak": 3.0}, ())
    assert toxicity.match(f"you {word}, you", auto)[1:] == (1, 3.0)


def test_signs_as_letters_and_words_parted_by_signs():
    auto = toxicity._automaton({toxicity.fold("idiot").strip(): 3.0, "trash": 2.0, "hate": 1.0}, ("trash can",))
    for text, hits in (("!d!ot", 0), ("id!ot", 1), ("idio+", 1), ("id-iot", 1), ("i.d.i.o.t", 1), ("hello!idiot", 1), ("id-iot id-iot", 2),
                       ("a trash-can", 0), ("trash can", 0), ("hate-mail", 1), ("ha+e", 1), ("well-known as usual!", 0), ("1+1 a-b", 0)):
        assert toxicity.match(text, auto)[1] == hits, text


def test_exceptions_hold_for_disguised_words():
    auto = toxicity._automaton({"trash": 2.0, "id ": 1.0}, ("trash can",))
    for text, hits in (("trash can", 0), ("tr\u00e1sh can", 0), ("trash c\u00e1n", 0), ("tra-sh can", 0), ("tra-sh ca.n", 0), ("trash can trash", 1), ("-- tr\u00e1sh -- can", 0),
                       ("tr\u00e1sh cannot", 1), ("no trash, can trash", 1), ("id idle", 1), ("my trash cans", 1)):
        assert toxicity.match(text, auto)[1] == hits, text


def plain_lexicon(rows):
    """Entry to weight, row by row."""
    total = Counter(y for _, y in rows)
    p, n = total[1], total[0]
    seen = {y: Counter() for y in (0, 1)}
    for text, y in rows:
        words = set(toxicity.fold(text).split())
        own = set()
        for w in words:
            own |= {w[:k] for k in range(4, 11) if len(w) >= k}
            if len(w) < 4 or len(w) > 10:
                own.add(w + " ")
        seen[y].update(own)
    kept = {}
    for e in sorted(seen[1], key=lambda e: (len(e), e)):
        a, b = seen[1][e], seen[0][e]
        weight = math.log((a + 0.5) / (p + 1)) - math.log((b + 0.5) / (n + 1))
        share = (a + b) / (p + n)
        gain = 2 * sum(k * math.log(k / (t * s)) for k, t, s in ((a, p, share), (b, n, share), (p - a, p, 1 - share), (n - b, n, 1 - share)) if k) if share < 1 else 0
        if a < 4 or weight < 2 or gain < 20:
            continue
        if weight > max((kept[e[:k]] for k in range(4, len(e)) if e[:k] in kept), default=-math.inf) + 0.7:
            kept[e] = weight
    return kept


def test_toxicity_scores_equal_a_plain_version(spark):
    rng = random.Random(8)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}{'x' * (i % 12)}" for i in range(20) for j in range(20)]
    rows, labels = [], []
    for i in range(500):
        words = rng.choices(plain, k=rng.randint(5, 80))
        if i % 3 == 0 and rng.random() < 0.9:
            words += rng.choices(["zug", "grobnakistically", "grobnakery", "m\u00fcggle"], k=2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    table = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in toxicity.score_documents(table, spark.createDataFrame(labels, "doc_id LONG, toxic INT")).collect()}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    fit = [(t, labels[i][1]) for i, t in rows if i not in held]
    lexicon = plain_lexicon(fit)
    assert {"zug ", "grob"} <= set(lexicon)
    found = toxicity.learn(spark.createDataFrame(fit, "text STRING, y INT"), sum(y for _, y in fit), sum(1 - y for _, y in fit))
    assert set(found) == set(lexicon) and all(abs(found[e] - lexicon[e]) < 1e-9 for e in found)

    def shape(text):
        line = toxicity.fold(text).split()
        weight = 0.0
        for w in line:
            weight += max((v for e, v in lexicon.items() if (w + " ").startswith(e)), default=0.0)
        return [1.0, math.log1p(weight), math.log1p(100 * weight / max(1, len(line)))]

    x, y = np.array([shape(t) for t, _ in fit]), np.array([v for _, v in fit], float)
    scores = {i: got[i].score for i, _ in rows}
    # The scores are a logistic of the shape, at the minimum of the penalised loss.
    logit = np.array([math.log(scores[i] / (1 - scores[i])) for i, _ in rows])
    b, left, _, _ = np.linalg.lstsq(np.array([shape(t) for _, t in rows]), logit, rcond=None)
    assert left.sum() < 1e-12
    slope = x.T @ (y - 1 / (1 + np.exp(-(x @ b)))) - 0.05 * b
    assert np.abs(slope).max() < 1e-6
    assert {i for i in got if got[i].held_out} == held and all(r.predicted == int(r.score >= 0.3) for r in got.values())


# --- personal data ----------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            out += [(kind, m.start(), m.end())] * ok
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    fixed = ["a@b@c.d.e@f.g", "x@y", "1.2.3.4.5.6.7.8.9", "001.2.3.255 256.1.1.1", "4111 1111-1111 1111", "4111111111111111", "+1 (212) 555-0100.", "+12", "a.b+c@d-e.f-g.", "@a.b", "+1 2 +3 456 789 01"]
    for _ in range(4000):
        fixed.append("".join(rng.choice("aB9@.+- ()1é") for _ in range(rng.randrange(40))))
    for t in fixed:
        assert pii.base_spans(t) == brute_spans(t), t


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in tagger._start(5, 3).items()}
    x, tags = rng.integers(0, tagger.N_KINDS, (3, 7)), rng.integers(0, 5, (3, 7))
    _, g = tagger._gradients(p, x, tags)
    for name in p:
        flat = np.flatnonzero(np.abs(g[name]).ravel() > 1e-3)[:4]
        for i in flat:
            loss = []
            for e in (1e-3, -1e-3):
                q = {k: v.copy() for k, v in p.items()}
                q[name].flat[i] += e
                loss.append(tagger._gradients(q, x, tags)[0])
            assert abs((loss[0] - loss[1]) / 2e-3 - g[name].flat[i]) < 0.03 * max(1, abs(g[name].flat[i]))


@pytest.fixture(scope="module")
def model():
    return pii.train(pii._made(700), 8)


def test_tagger_finds_held_out_spans(spark, model):
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(120):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        left = " ".join(words[:30]) + ' token = "'
        rows.append((i, left + value + '" ' + " ".join(words[30:]) if i % 2 else " ".join(words)))
        want[i] = [("secret", len(left), len(left) + 40)] * (i % 2)
    rows += [(900, None), (901, ""), (902, "call +1 (212) 555-0100 now"), (None, "x 1.2.3.4"), (902, "call +1 (212) 555-0100 now"), (903, "9" * 20_000), (904, "In 1999 and 2004, 12 of 40 pages.")]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"pii": F.lit(1), "kind": F.lit(2)})
    got = {}
    for r in pii.detect(table, model).collect():
        got[r.doc_id] = [(s.kind, s.start, s.end) for s in r.pii]
        text = dict(rows)[r.doc_id] or ""
        assert [(s.kind, s.start, s.end) for s in r.pii if s.base] == brute_spans(text)
    hits = sum(got[i] == want[i] for i in range(120))
    assert hits >= 110
    assert got[902] == [("phone", 5, 22)] and got[900] == got[901] == got[904] == []
    assert pii.detect(table.limit(0), model).count() == 0


def test_masking(spark):
    rows = [(1, "é a@b.c, 1.2.3.4!", 3), (2, None, None), (3, "", 0), (4, "plain", 5)]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_chars INT")
    spans = F.when(F.col("doc_id") == 1, F.array(F.struct(F.lit("email").alias("kind"), F.lit(2).alias("start"), F.lit(7).alias("end")),
                                                  F.struct(F.lit("ip").alias("kind"), F.lit(9).alias("start"), F.lit(16).alias("end")),
                                                  F.struct(F.lit("card").alias("kind"), F.lit(9).alias("start"), F.lit(10).alias("end")))).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    assert [r[0] for r in table.select(pii.mask(F.col("text"), spans)).collect()] == ["é [EMAIL], [IP]!", None, "", "plain"]
    masked = pii.mask_documents(table)
    assert masked.columns == table.columns and {r.doc_id: (r.text, r.n_chars) for r in masked.collect()}[1] == ("é [EMAIL], [IP]!", 16)


@pytest.mark.parametrize("value", [
    "Tr0ub4dor&3", "correct-horse-battery", "1234567890123456", "eight888", "x" * 80, "hunter!p@ss.word1", "a@b.cd.ef", "4111111111111111"])
@pytest.mark.parametrize("name", ["password = ", "Secret: ", "API_KEY="])
def test_every_labelled_secret_is_found_and_masked(spark, model, name, value):
    far = "plain words of the text " * 12
    text = f'{far}{name}"{value}" {far}'
    a, b = len(far + name) + 1, len(far + name) + 1 + len(value)
    assert pii.secret_spans(text) == [("secret", a, b)]
    [spans] = pii.find([text], model.parameters)
    assert any(x <= a and b <= y for _, x, y, _ in spans)
    table = spark.createDataFrame([(1, text)], SCHEMA)
    masked = pii.detect(table, model).select(pii.mask(F.col("text"), F.col("pii"))).first()[0]
    whole = any(k != "secret" and (x, y) == (a, b) for k, x, y in pii.base_spans(text))
    kind = pii.base_spans(text)[0][0].upper() if whole else "SECRET"
    assert masked == f'{far}{name}"[{kind}]" {far}'


def test_quoted_words_that_no_name_calls_secret_stay(model):
    texts = ['the title: "introduction" of it', 'name = "frontend-service" here', 'password = "short"', 'password = "two words"', 'token = "' + "x" * 81 + '"']
    assert pii.find(texts, model.parameters) == [[]] * 5


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_tagger_finds_secrets_of_documents_it_was_not_fitted_on(spark):
    """Without the rule, at least nine of ten labelled secrets, and little else."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = pii.fit(docs.where(~held))
    texts = [r.text or "" for r in docs.where(held & (F.col("doc_id") < 6000)).collect()]
    found = pii.find(texts, model.parameters, rule=False)
    wanted = [(i, s) for i, t in enumerate(texts) for s in pii.secret_spans(t)]
    hit = sum(any(k == "secret" and (a, b) == s[1:] for k, a, b, _ in found[i]) for i, s in wanted)
    assert len(wanted) >= 20 and hit >= 0.9 * len(wanted)
    made = [(i, k, a, b) for i, spans in enumerate(found) for k, a, b, origin in spans if origin == "tagger" and k == "secret"]
    assert sum((k, a, b) in pii.secret_spans(texts[i]) for i, k, a, b in made) >= 0.9 * len(made)
    assert {o for spans in found for *_, o in spans} <= {"base", "tagger"}


def plain_viterbi(scores, moves):
    """The best path by trying them all; a kind goes on (even) only after it began (odd)."""
    from itertools import product

    def worth(path):
        return sum(scores[t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))

    def valid(path):
        return all(k == 0 or k % 2 or (t > 0 and path[t - 1] in (k - 1, k)) for t, k in enumerate(path))
    return max(filter(valid, product(range(scores.shape[1]), repeat=len(scores))), key=worth)


def test_decoding_and_windows_equal_plain_versions(model):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        scores, moves = rng.normal(size=(n, 5)).astype(np.float32), rng.normal(size=(5, 5)).astype(np.float32)
        assert tuple(tagger.viterbi(scores, moves)) == plain_viterbi(scores, moves)
    # Scores of a place: the mean over its windows, those near an edge counting less.
    windows = rng.normal(size=(3, pii.WIDTH, 11)).astype(np.float32)
    n = 2 * pii.STRIDE + pii.WIDTH
    total, weight = np.zeros((n, 11)), np.zeros(n)
    for k, w in enumerate(windows):
        for t in range(pii.WIDTH):
            u = min(t + 1, pii.WIDTH - t)
            total[k * pii.STRIDE + t] += u * w[t]
            weight[k * pii.STRIDE + t] += u
    tags = tagger.viterbi((total / weight[:, None]).astype(np.float32), model.parameters["T"]).tolist()
    spans = pii._decode(model.parameters, "a" * n, 0, windows)
    begun = [t for t in range(n) if tags[t] % 2 == 1]
    assert [a for _, a, _ in spans] == begun and all(pii.TAGGED[(tags[a] - 1) // 2] == k for k, a, _ in spans)
    assert all(tags[t] == tags[a] + 1 for _, a, b in spans for t in range(a + 1, b))
