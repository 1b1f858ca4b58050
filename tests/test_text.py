import random
import re
import time

import pytest
from pyspark.sql import functions as F

from opsmill.functions.text import token_count, tokens
from opsmill.operators import chunking

TOKEN = re.compile(r"\w+|[^\w\s]")


def n_tokens(text):
    return len(TOKEN.findall(text))


def pack(parts, size, overlap, glue):
    """Greedy packing of parts with a carried tail, by brute force."""
    out, held = [], []
    total = lambda xs: sum(map(n_tokens, xs))
    for part in parts:
        if held and total(held) + n_tokens(part) > size:
            out.append(glue.join(held).strip())
            while total(held) > overlap or (total(held) + n_tokens(part) > size and total(held) > 0):
                held.pop(0)
        held.append(part)
    return [x for x in [*out, glue.join(held).strip()] if x]


TEXTS = [
    "one two three four five. six seven\neight nine ten eleven\ntwelve\n\nthirteen fourteen fifteen",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z",
    "short", "", "   \n\n  ", "word. " * 40, "x" * 3 + "\n\n\n" + "y z\n" * 9,
]


@pytest.mark.parametrize(("size", "overlap"), [(5, 0), (8, 3), (10, 9), (3, 1)])
def test_fixed_size_equals_brute_force(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id INT, text STRING")
    rows = chunking.fixed_size(df, size, overlap, separator="\n").orderBy("doc_id", "chunk_index").collect()
    for i, text in enumerate(TEXTS):
        want = pack([p for p in text.split("\n") if p], size, overlap, "\n")
        assert [r.text for r in rows if r.doc_id == i] == want


@pytest.mark.parametrize(("size", "overlap"), [(6, 0), (8, 2), (12, 5)])
def test_recursive_chunks_fit_and_cover(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id INT, text STRING")
    rows = chunking.recursive(df, size, overlap).orderBy("doc_id", "chunk_index").collect()
    for i, text in enumerate(TEXTS):
        mine = [r for r in rows if r.doc_id == i]
        assert [r.chunk_index for r in mine] == list(range(len(mine)))
        assert all(0 < r.token_count <= size for r in mine)
        joined = " ".join(r.text for r in mine)
        assert set(TOKEN.findall(text)) == set(TOKEN.findall(joined))
        if overlap == 0:
            assert "".join(joined.split()) == "".join(text.split())


def test_recursive_splits_at_the_largest_boundary(spark):
    text = "aaa bbb ccc. ddd eee fff. ggg hhh iii. jjj kkk lll\nshort line\n\nnew paragraph here with words ok"
    df = spark.createDataFrame([(1, text)], "doc_id INT, text STRING")
    got = [r.text for r in chunking.recursive(df, 8, 3).orderBy("chunk_index").collect()]
    assert got == ["aaa bbb ccc. ddd eee fff", ". ggg hhh iii. jjj kkk lll", "short line",
                   "new paragraph here with words ok"]


def test_a_text_without_separators_falls_to_characters(spark):
    df = spark.createDataFrame([(1, "abcde")], "doc_id INT, text STRING")
    assert [r.text for r in chunking.recursive(df, 4, 0).orderBy("chunk_index").collect()] == ["abcd", "e"]


def test_a_paragraph_above_the_size_stays_whole(spark):
    df = spark.createDataFrame([(1, "a b\n\n" + "w " * 30 + "\n\nc d")], "doc_id INT, text STRING")
    assert [r.token_count for r in chunking.fixed_size(df, 10, 2).orderBy("chunk_index").collect()] == [2, 30, 2]


def test_header_is_dropped_only_before_content(spark):
    texts = ["# T\n*date*\n\nBody\n# not header", "# only\n* marks", "Body", "\n\nBody"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING").orderBy("i")
    got = [r.t for r in df.select("i", chunking.strip_header(F.col("text")).alias("t")).collect()]
    assert got == ["Body\n# not header", "# only\n* marks", "Body", "Body"]


def test_semantic_keeps_every_sentence(spark):
    texts = ["Cats purr. Cats sleep. Cats eat fish. Stocks fell today! Markets closed lower. Bonds rose?", "One only.", "", "No stop"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    for kind, amount in (("percentile", 50.0), ("standard_deviation", 0.5)):
        rows = chunking.semantic(df, kind, amount).orderBy("doc_id", "chunk_index").collect()
        for i, text in enumerate(texts):
            assert " ".join(r.text for r in rows if r.doc_id == i) == text
        assert sum(r.doc_id == 0 for r in rows) > 1


def test_tokens_of_chunks_are_those_of_their_text(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "é_1", "İ", "Σ", "!", ".", ". ", "? ", " ", "  ", "\n", "\n\n", "\t", "w" * 9]) for _ in range(n)) for n in (0, 3, 40, 400)]
    df = spark.createDataFrame([*enumerate(texts), (9, "ab" * 30), (10, None), (11, "İ İ. b")], "doc_id INT, text STRING")
    made = [chunking.fixed_size(df, 7, 3, separator=s, separator_tokens=n) for s, n in (("\n", 0), (" ", 2), (".", 1), ("", 0))]
    made += [chunking.recursive(df, 7, 3), chunking.recursive(df, 7, 3, ("\n", "a")), chunking.recursive(df, 7, 0, ("",)), chunking.semantic(df, amount=50.0)]
    for chunks in made:
        rows = chunks.select("text", "token_count", token_count(F.col("text")).alias("n")).collect()
        assert len(rows) > 3 and all(r.token_count == r.n for r in rows)


def test_packing_reads_a_piece_a_few_times_however_many_there_are(spark):
    # Each carried tail used to read all pieces of the text for each of its own.
    def seconds(n):
        df = spark.createDataFrame([(1, "w " * n)], "doc_id INT, text STRING")
        start = time.perf_counter()
        assert chunking.recursive(df, 50, 20).agg(F.sum("token_count")).first()[0] > n
        return time.perf_counter() - start

    seconds(1000)
    few = min(seconds(1000) for _ in range(2))
    assert seconds(20_000) < few + 6


def test_tokens_are_the_same_for_every_character(spark):
    codes = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([("".join(f"a{chr(c)}{chr(c)} {chr(c)}a" for c in codes[i:i + 500]),) for i in range(0, len(codes), 500)], "t STRING")
    plain = F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"), F.lit(0))
    assert df.filter(tokens(F.col("t")) != plain).count() == 0


def test_unknown_names_raise(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id INT, text STRING")
    with pytest.raises(ValueError):
        chunking.chunk_documents(df, "other")
    with pytest.raises(ValueError):
        chunking.semantic(df, "other")


def test_statistics_and_keywords(spark):
    df = spark.createDataFrame([(1, "VIP rule here. " * 10), (2, "plain text")], "doc_id INT, text STRING")
    both = chunking.compare_strategies(df, {"fixed_size": {"chunk_size": 8, "separator": "."}, "recursive": {"chunk_size": 8, "chunk_overlap": 0}})
    stats = {r.strategy: r for r in chunking.chunk_statistics(both, ["doc_id", "chunk_index"]).collect()}
    assert set(stats) == {"fixed_size", "recursive"} and stats["recursive"].max_tokens <= 8
    hits = {r.strategy: r.n_chunks for r in chunking.keyword_chunks(both, ["VIP", "vip"], ["doc_id", "chunk_index"]).collect()}
    for strategy in stats:
        assert hits[strategy] == sum("VIP" in r.text for r in both.filter(F.col("strategy") == strategy).collect()) > 0


def test_token_count_is_unicode_aware(spark):
    df = spark.createDataFrame([("Für élève, naïve_1!",), ("",)], "t STRING")
    assert [r[0] for r in df.select(token_count(F.col("t"))).collect()] == [5, 0]


def test_token_windows_cover_the_text(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "one", " a, b! ", "x " * 9, "".join(rng.choice("ab_ .,\n\té") for _ in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    for size, overlap in ((10, 3), (10, 0), (7, 6), (1, 0), (5000, 50)):
        by = {}
        for r in chunking.fixed_size(docs, size, overlap, mode="window").collect():
            by.setdefault(r.doc_id, []).append(r)
        for i, text in enumerate(texts):
            found = [(m.start(), m.end()) for m in re.finditer(r"\w+|[^\w\s]", text or "")]
            rows = sorted(by.get(i, []), key=lambda r: r.chunk_index)
            want = []
            for k in range(0, len(found), size - overlap):
                own = found[k:k + size]
                want.append((len(want), len(own), own[0][0], own[-1][1], text[own[0][0]:own[-1][1]]))
                if k + size >= len(found):
                    break
            assert [(r.chunk_index, r.token_count, r.start_char, r.end_char, r.text) for r in rows] == want
    with pytest.raises(ValueError):
        chunking.token_windows(docs, 5, 5)
    with pytest.raises(ValueError):
        chunking.fixed_size(docs, mode="odd")
