"""The whole pipeline next to a plain version of its stages."""

import os
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from opsmill.llm import pieces, pii, quality_rules

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
WORD = r"[^\x20\x09-\x0D]+"


def line_fails(line):
    words, visible = re.findall(WORD, line), re.sub(r"[\x20\x09-\x0D]", "", line)
    symbols = len(re.findall(r"[#*$%&|<>]", line))
    bars = len(re.findall(r"(?:^|[\x20\t])[|>](?:[\x20\t]|$)", line))
    upper, letters = len(regex.findall(r"\p{Lu}", line)), len(regex.findall(r"\p{L}", line))
    bangs = sum(bool(re.search(r"[^!]!+$", w)) for w in words)
    low = line.lower()
    phrases = [p for p in quality_rules.BOILERPLATE if p in low]
    lead = any(re.search(rf"^[\x20\x09-\x0D]*(?:{WORD}[\x20\x09-\x0D]+){{0,4}}[^\x20\x09-\x0D]{{0,2}}{re.escape(p)}", low) for p in phrases)
    return (symbols > 0 and (symbols > 0.1 * len(visible) or (len(words) >= 3 and bars > 0.2 * len(words)))
            or bool(regex.search(r"\p{Lu}{4}", line)) and letters >= 12 and upper > 0.6 * letters
            or len(words) >= 3 and bangs > 0.3 * len(words)
            or bool(phrases) and (lead or 35 * len(phrases) >= len(words)))


def clean(text):
    """The text without failing lines, or None for a rejected document."""
    words = re.findall(WORD, text or "")
    threes = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if threes[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    good = [x for x in dict.fromkeys(lines) if not line_fails(x)]
    size = lambda t: sum(map(len, re.findall(WORD, t)))
    lost = size(text or "") - size("\n".join(good)) if len(good) < len(lines) else 0
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words) or lost > 0.3 * size(text):
        return None
    return "\n".join(good)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def first_of_groups(docs):
    """Ids of documents that are the least of those reachable over similar ones."""
    sets = {}
    for i, t in docs.items():
        w = re.findall(WORD, lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in docs}
    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    return {i for i in ids if group[i] == i}


def hit(text, windows):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if x]
    return any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))


def masked(text, spans):
    out, at = "", 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += text[at:a] + f"[{kind.upper()}]"
            at = b
    return out + text[at:]


def test_run_equals_a_plain_version(spark):
    table = spark.read.parquet(f"{ROOT}/documents.parquet")
    docs = {r.doc_id: t for r in table.collect() if (t := clean(r.text)) is not None}
    docs = {i: docs[i] for i in first_of_groups(docs)}
    windows = set()
    for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect():
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text or "")) if x]
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    docs = {i: t for i, t in docs.items() if not hit(t, windows)}
    model = pii.fit(spark.createDataFrame(list(docs.items()), "doc_id LONG, text STRING"))
    found = pii.find(list(docs.values()), model.parameters)
    docs = {i: masked(t, s) for (i, t), s in zip(docs.items(), found)}

    made = corpus_pipeline.run(spark, ROOT)
    vocabulary = pieces.load(pieces.default_path())
    got = {r.doc_id: r.decoded for r in pieces.decode(made.select("doc_id", "pieces"), vocabulary).collect()}
    assert 50 < len(docs) < table.count() and set(got) == set(docs)
    assert got == docs
    assert made.where(~F.col("lossless") | (F.size("pieces") != F.col("n_pieces"))).isEmpty()
