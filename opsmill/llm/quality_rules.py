"""Quality rules: line-first cleaning, as column expressions only.

Each line is judged on its own (symbols, shouting, navigation, boilerplate,
copies of an earlier line). Failing lines are removed, and a document that
loses too much of its text is rejected, as is one that is too short or repeats
its own three-word windows. No shuffle: a document stays in its row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.llm.names import free

BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Fixed phrases of licence, consent and page furniture lines.
BOILERPLATE = (
    "licensed under", "released under", "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "accept cookies", "use cookies", "public license", "sign up for our newsletter", "subscribe to our", "lorem ipsum",
    "javascript is disabled", "enable javascript", "click here to", "skip to content", "back to top", "share this",
)


@dataclass(frozen=True)
class LineRules:
    """Limits. Shares are of a line's characters or words, ``max_lost`` of a
    document's word characters. Prose may quote a boilerplate phrase, so a line with one
    fails if it comes after ``max_lead_words`` words at most, or if the line
    has a different phrase for every ``words_per_phrase`` words or fewer."""

    max_symbol_share: float = 0.10
    max_upper_share: float = 0.60
    min_upper_letters: int = 12
    max_bang_share: float = 0.30
    max_bar_share: float = 0.20
    words_per_phrase: int = 35
    max_lead_words: int = 4
    max_lost: float = 0.30
    min_words: int = 50
    max_repeat_percent: int = 50


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def repeat_words(joined: Column) -> Column:
    """Words of ``joined`` (words joined by one space) that lie in a three-word window found twice or more. Only a text
    whose windows are not all different has them sorted with their places, so
    that equal ones are neighbours."""

    def places(windows):
        def twice(s):
            return _let(F.transform(s, lambda x: F.substring_index(x, " ", 3)), lambda k: F.filter(
                F.transform(s, lambda x, j: F.when(
                    (F.get(k, j) == F.get(k, j + 1)) | ((j > 0) & (F.get(k, j) == F.get(k, F.greatest(j - 1, F.lit(0))))),
                    F.substring_index(x, " ", -1).cast("int"))),
                lambda p: p.isNotNull()))
        return _let(F.sort_array(F.transform(windows, lambda x, i: F.concat_ws(" ", x, i.cast("string")))), twice)

    def covered(found):
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(F.sort_array(found), start, lambda a, p: F.struct(
            p.alias("last"), (a.n + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a.n)

    windows = F.regexp_extract_all(joined, F.lit("(?=([^ ]++ [^ ]++ [^ ]++))[^ ]++ "), F.lit(1))
    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(places(w))))


def line_fails(line: Column, rules: LineRules) -> Column:
    """True for a line that any rule removes; a line without words passes.
    A cheap test goes before each count."""

    def share(pattern: str, part: str, most: float, least: int = 1) -> Column:
        return (_count(line, part) >= least) & (_count(line, pattern) > most * _count(line, part))

    visible, word = "[^\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]+"
    marked = line.rlike(SYMBOLS) & (
        share(SYMBOLS, visible, rules.max_symbol_share)
        | share("(?:^|[\\x20\\t])[|>](?:[\\x20\\t]|$)", word, rules.max_bar_share, 3))
    shouts = line.rlike("\\p{Lu}{4}") & share("\\p{Lu}", "\\p{L}", rules.max_upper_share, rules.min_upper_letters)
    bangs = line.contains("!") & share("[^\\x20\\x09-\\x0D!]!+(?![^\\x20\\x09-\\x0D])", word, rules.max_bang_share, 3)
    lead = f"^{BLANK[:-1]}*(?:{word}{BLANK}){{0,{rules.max_lead_words}}}{visible}{{0,2}}(?:{'|'.join(BOILERPLATE)})"
    phrase = _let(F.lower(line), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]) & (
        low.rlike(lead)
        | (rules.words_per_phrase * reduce(add, [low.contains(p).cast("int") for p in BOILERPLATE]) >= _count(line, word))))
    return marked | shouts | bangs | phrase


def judge(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``quality``: word_chars, n_words,
    n_symbols, n_dup_lines, n_repeat_words, n_lines, n_removed_lines, lost_chars,
    base_failed, kept and cleaned (the text without failing lines and later copies).

    Null and empty texts have zero counts and are not kept. Rows are never
    merged: repeated rows are judged alike. Other columns pass through; a
    column named ``quality`` is replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # Arrays are held in lambda variables, so none is built twice.
    def filled(t):
        return F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def measure(t):
        return _let(_words(t), lambda w: _let(F.array_join(w, " "), lambda j: F.struct(
            (F.length(j) - F.greatest(F.size(w) - 1, F.lit(0))).cast("long").alias("word_chars"),
            F.size(w).cast("long").alias("n_words"),
            F.when(t.rlike(SYMBOLS), _count(t, SYMBOLS)).otherwise(0).cast("long").alias("n_symbols"),
            repeat_words(j).cast("long").alias("n_repeat_words"))))

    def clean(ls):
        return _let(F.array_distinct(ls), lambda once: _let(F.filter(once, lambda x: ~line_fails(x, rules)), lambda good: F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(once)).cast("long").alias("n_dup_lines"),
            (F.size(ls) - F.size(good)).cast("long").alias("n_removed_lines"),
            F.array_join(good, "\n").alias("cleaned"))))

    def verdict(m, c):
        left = F.length(F.regexp_replace(c.cleaned, BLANK, ""))
        lost = F.when(c.n_removed_lines == 0, F.lit(0).cast("long")).otherwise(m.word_chars - left)
        failed = (m.n_words < rules.min_words) | (100 * m.n_repeat_words > rules.max_repeat_percent * m.n_words)
        return _let(lost, lambda gone: F.struct(
            m.word_chars.alias("word_chars"), m.n_words.alias("n_words"), m.n_symbols.alias("n_symbols"),
            c.n_dup_lines.alias("n_dup_lines"), m.n_repeat_words.alias("n_repeat_words"), c.n_lines.alias("n_lines"),
            c.n_removed_lines.alias("n_removed_lines"), gone.alias("lost_chars"), failed.alias("base_failed"),
            (~failed & (gone <= rules.max_lost * m.word_chars)).alias("kept"), c.cleaned.alias("cleaned")))

    whole = _let(body, lambda t: _let(measure(t), lambda m: _let(filled(t), lambda ls: _let(clean(ls), lambda c: verdict(m, c)))))
    # The guard always holds. It is not deterministic, so the optimizer never
    # copies this costly expression into a filter or a second column.
    return docs.withColumn("quality", F.when(F.monotonically_increasing_id() >= 0, whole))


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Documents that pass, with their cleaned text; columns stay as they are
    (``n_chars``, where there is one, follows the text)."""
    own = {n: free("own_quality", docs.columns) if n.lower() == "quality" else n for n in docs.columns}
    kept = judge(docs.withColumnsRenamed({n: o for n, o in own.items() if n != o}), rules).where("quality.kept")
    kept = kept.withColumn("text", F.col("quality.cleaned"))
    if "n_chars" in own:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{o}`").alias(n) for n, o in own.items()])
