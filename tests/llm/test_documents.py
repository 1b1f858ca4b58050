"""Document operators next to brute-force versions, with odd rows of every kind."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opsmill.llm import decontaminate, minhash, quality_rules, substring

BLANK = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id LONG, text STRING"


def prose(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def changed(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    base = prose(rng, 120)
    out = [(i, changed(rng, base, 1 + i % 3)) for i in range(40)]  # near copies
    out += [(100 + i, base) for i in range(30)]  # exact copies
    out += [(200 + i, prose(rng, rng.randrange(0, 80))) for i in range(40)]
    passage = prose(rng, 60)
    out += [(300 + i, f"{prose(rng, 15)}  {passage}\n{prose(rng, 9)}") for i in range(12)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "One two"), (404, "one TWO"), (405, "é ü ß 日本 😀"), (406, passage)]
    out += [(200, out[70][1]), (200, out[70][1]), (None, base), (None, None), (-5, changed(rng, base, 2))]
    out += [(500, " ".join(["same"] * 4000)), (501, passage + " " + passage)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"n": F.lit(1), "key": F.lit("k"), "items": F.lit("i"), "id": F.lit(9)})


def shingles(text):
    w = re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def groups(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i in parent}


def test_minhash_equals_all_pairs(rows, docs):
    want = groups(rows)
    got = minhash.classes(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == sorted((i, len(shingles(t))) for i, t in rows if i is not None)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_links_that_miss_the_bucket_lead_are_found(spark):
    """Chains: each text is close to the next one only, so most links are not with the least id."""
    rng = random.Random(9)
    text, rows = prose(rng, 150), []
    for i in range(60):
        rows.append((i, text))
        words = text.split()
        at = (i * 13) % 140
        words[at:at + 2] = [f"y{i}", f"z{i}"]
        text = " ".join(words)
    far = changed(rng, rows[0][1], 9)
    rows += [(100, far), (101, changed(rng, far, 1)), (102, changed(rng, rows[30][1], 14))]
    got = minhash.classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(rows)


def test_near_dedup_keeps_one_of_each_group(rows, docs):
    want = groups(rows)
    kept = minhash.clean_documents(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 2


def test_minhash_of_an_empty_table(spark):
    assert minhash.classes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert minhash.clean_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_substring(rows):
    seen, out = {}, {}
    docs = [((i if i is not None else 2**63 - 1), t) for i, t in rows]
    words = [(k, re.findall(BLANK, t or "")) for k, t in docs]
    for k, w in words:
        for p in range(len(w) - 19):
            win = tuple(w[p:p + 20])
            seen[win] = min(seen.get(win, (k, p)), (k, p))
    for k, w in words:
        gone = set()
        for p in range(len(w) - 19):
            if seen[tuple(w[p:p + 20])] < (k, p):
                gone |= set(range(p, p + 20))
        out[(k, len(w))] = (len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


@pytest.mark.parametrize("size", [substring.BUCKET_BYTES, 2000])
def test_substring_dedup_equals_brute_force(rows, docs, monkeypatch, size):
    monkeypatch.setattr(substring, "BUCKET_BYTES", size)  # small buckets settle often
    monkeypatch.setattr(substring, "PIECE_BYTES", 3000)
    got = substring.remove_copies(docs).collect()
    want = brute_substring(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_removed, r.kept_text) == want[(r.doc_id if r.doc_id is not None else 2**63 - 1, r.n_words)]
    assert sum(r.n_removed for r in got) > 1000


def test_substring_dedup_of_an_empty_table(spark):
    assert substring.remove_copies(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", "text", "n_words", "n_removed", "kept_text"]
    assert substring.remove_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_hits(text, items):
    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    own, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        size = min(10, len(w))
        for win in {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else ():
            for p in range(len(own) - size + 1):
                if tuple(own[p:p + size]) == win:
                    hit |= set(range(p, p + size))
                    found.add(str(i))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_CHARS, 200])
def test_decontamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rng = random.Random(2)
    items = [(i, prose(rng, n, 50)) for i, n in enumerate((25, 10, 4, 1, 12))] + [(9, None), (10, " .. "), (11, "Größe, é-9 ok"), (2, "w1 w1 w1")]
    bench = spark.createDataFrame(items, "item_id LONG, text STRING").withColumn("w", F.lit(1))
    docs = [(1, f"Aa, {items[0][1].upper()}! zz"), (2, items[0][1][40:]), (3, None), (4, ""), (5, "... ,"), (6, items[2][1] * 2),
            (7, "größe É-9 é 9 ok. grÖße"), (8, "größe é 9 OK w1 w1 w1 w1 w1"), (8, "größe é 9 OK w1 w1 w1 w1 w1"), (None, items[1][1].replace(" ", ",\n"))]
    docs += [(20 + i, prose(rng, 300, 50)) for i in range(5)]
    table = spark.createDataFrame(docs, SCHEMA).withColumns({"items": F.lit(3), "n_words": F.lit(-1)})
    got = sorted(((r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r.word_spans), r["items"], r.text, r.char_spans) for r in decontaminate.scan(table, bench).collect()), key=str)
    want = sorted(((i or 0, *brute_hits(t, items), t) for i, t in docs), key=str)
    assert [g[:5] for g in got] == [tuple(w) for w in want]
    for _, _, n, found, text, spans in got:
        parts = [text[s.start:s.end] for s in spans]
        assert sum(len(re.findall(r"[0-9A-Za-z\x80-\U0010FFFF]+", p)) for p in parts) == n
    clean = decontaminate.clean_documents(table, bench)
    assert clean.columns == table.columns and clean.count() == sum(not w[3] for w in want)
    assert decontaminate.scan(table.limit(0), bench).count() == 0
    assert decontaminate.clean_documents(table, bench.limit(0)).count() == len(docs)


def brute_quality(t):
    t = t or ""
    w = re.findall(BLANK, t)
    count = Counter(zip(w, w[1:], w[2:]))
    cover = {p for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(BLANK, x)]
    return sum(map(len, w)), len(w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_counts_equal_brute_force(spark, rows):
    more = [(700, "a b c a b c x"), (701, "a a a a"), (702, "x # y\n\nx # y\n \n# | <b>"), (703, "一 二 三 一 二 三"), (704, "\x0b a\x0cb\rc\r\na")]
    table = spark.createDataFrame(rows + more, SCHEMA).withColumn("quality", F.lit(7))
    got = defaultdict(list)
    for r in quality_rules.judge(table).select("doc_id", "quality.*").collect():
        got[r.doc_id].append((r.word_chars, r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    want = defaultdict(list)
    for i, t in rows + more:
        want[i].append(brute_quality(t))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_lines_are_judged_one_by_one(spark):
    good = "This is a plain line of prose, of a fair length, that any reader would keep in a corpus."
    lines = {good: True, "HOME | NEWS | SPORT | ABOUT": False, "buy### now*** cheap$$$ pills%%%": False, "STOP SHOUTING AT ALL THE READERS": False,
             "Wow!! What! Great!!": False, "Licensed under the Apache License, Version 2.0.": False, "ok": True}
    text = "\n".join([*lines, good, " "])
    r = quality_rules.judge(spark.createDataFrame([(1, text)], SCHEMA)).select("quality.*").first()
    assert r.cleaned == "\n".join(x for x, ok in lines.items() if ok)
    assert r.n_dup_lines == 1 and r.n_removed_lines == 6
    rng = random.Random(1)
    body = "\n".join(f"{prose(rng, 12, 5000)}." for i in range(9))
    table = spark.createDataFrame([(1, f"{body}\n{list(lines)[5]}", 0), (2, f"{body}\n" + "\n".join(f"A{i} | B{i} | C{i} | D{i} | EFG{i}" for i in range(60)), 0)], "doc_id LONG, text STRING, n_chars INT")
    kept = quality_rules.clean_documents(table).collect()
    assert [(r.doc_id, r.text, r.n_chars) for r in kept] == [(1, body, len(body))]
    assert quality_rules.clean_documents(table.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_the_batch(spark):
    import pyarrow as pa

    from opsmill.llm import words
    texts = ["ab cd", None, "", "cd  ab\u00e9 x", "ab"]
    whole = words.Words(pa.array(texts))
    assert [whole.data[a:b].tobytes() for a, b in zip(whole.starts, whole.ends)] == [w.encode() for t in texts for w in (t or "").split()]
    alone = [h for t in texts for h in words.Words(pa.array([t], pa.string())).hashes().tolist()]
    assert whole.hashes().tolist() == alone and len(set(alone)) == 4
    h = whole.hashes()
    for size in range(1, 7):
        assert words.windows(h, size).tolist() == [words.windows(h[i:i + size], size)[0] for i in range(len(h) - size + 1)]
        assert words.slide_min(h, size).tolist() == [h[i:i + size].min() for i in range(len(h) - size + 1)]
    assert hashlib.sha256(h.tobytes()).hexdigest() == hashlib.sha256(whole.hashes().tobytes()).hexdigest()


def test_no_link_of_a_small_set_is_missed():
    import pyarrow as pa
    rng, missed = random.Random(11), 0
    texts = []
    for i in range(60_000):  # of 8 and 7 words: 3 of 4 shingles shared
        words = [f"w{rng.randrange(10**9)}" for _ in range(8)]
        texts += [" ".join(words), " ".join(words[:7])]
    for n in range(3, minhash.SMALL + 1):  # all sizes of a union that a link allows
        for more in range(n // 3 + 1):
            for less in range(n - -(-3 * (n + more) // 4) + 1):
                words = [f"v{rng.randrange(10**9)}" for _ in range(n + 4 + more)]
                texts += [" ".join(words[:n + 4]), " ".join(words[less:])]
                a, b = ({tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for t in texts[-2:])
                assert 100 * len(a & b) >= 75 * len(a | b)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    made = [b for x in minhash._sign(iter([batch])) for b in x.column(x.schema.get_field_index("bands")).to_pylist()]
    assert len(made) == len(texts)
    bare = 0
    for a, b in zip(made[::2], made[1::2]):
        missed += not set(a) & set(b)
        bare += not set(a[:minhash.BANDS]) & set(b[:minhash.BANDS])
    assert missed == 0 and bare > 0


def test_long_lines_are_judged_by_their_phrases(spark):
    words = prose(random.Random(12), 60)
    lines = [
        ("This work is licensed under the Creative Commons licence, version four. " + words, True),
        ("We use cookies " + words, True), (words + " see our privacy policy and terms of use", True),
        (words + " and he said it was licensed under no name at all " + words, False), (words, False), ("All rights reserved", True)]
    assert all(len(x) > 200 for x, _ in lines[:-1])
    table = spark.createDataFrame(lines, "line STRING, want BOOLEAN")
    got = table.select("line", "want", quality_rules.line_fails(F.col("line"), quality_rules.LineRules()).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_items_without_id_are_found_as_in_the_sql(spark, tmp_path):
    import duckdb
    from opsmill.llm import catalogue
    from opsmill.plans import check
    texts = [" ".join(f"{c}{i}" for i in range(14)) for c in "abc"]
    spark.createDataFrame([(1, f"x {texts[0]} y"), (2, f"{texts[1]} z"), (3, "none"), (4, f"{texts[0]} {texts[1]} {texts[2]}")], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(None, texts[0]), (7, texts[1]), (None, texts[2]), (8, texts[2]), (None, None)], "item_id LONG, text STRING")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = catalogue.QUERIES["op2_decontaminate"](spark, str(tmp_path))
    cur = con.execute(catalogue.ORACLES["op2_decontaminate"])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, cur.fetchall())
    assert [r.doc_id for r in decontaminate.clean_documents(spark.read.parquet(f"{tmp_path}/documents.parquet"), items).collect()] == [3]


def test_one_huge_class_and_ids_of_several_texts(spark):
    """Most rows are copies of one text; an id with two texts ties their classes together."""
    copy, near, other = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "a b c d e f g h i j k l m n o p q r s t u v w x y Z!", "1 2 3 4 5 6 7 8 9 10"
    rows = [(i, copy) for i in range(100, 2100)] + [(50, near), (3, other), (4, other), (60, "lone words that nobody else has at all"), (1500, "1 2 3 4 5 6 7 8 9 10")]
    got = minhash.classes(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    # 1500 has the copied text and the other one, and near is similar to the copied one.
    assert all(by[i] == {(3, i == 3)} for i in [*range(100, 2100), 50, 3, 4]) and by[60] == {(60, True)}
    assert {r.class_id for r in got if r.doc_id in (100, 2099)} == {100}
