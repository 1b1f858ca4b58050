"""Document preparation and chunking.

Documents are rows with ``text`` and any other columns; each strategy returns
one row per chunk with the other columns kept. Splitting and packing are
Catalyst expressions over the row's own text: no shuffle and no Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmill.functions.columns import strip
from opsmill.functions.text import TOKEN, preview, split_literal, token_count, words
from opsmill.operators.embedding import feature_tokens, neighbour_distances

SEPARATORS = ("\n\n", "\n", ". ", " ", "")
# A text may have more tokens in lower case: a dotted capital I becomes two characters. Latin letters
# but for that one, and general punctuation, stay what they are; texts with others are counted as written.
CASE_COUNTS = r"[\u0130\u0250-\u1FFF\u2070-\x{10FFFF}]"


def strip_header(text: Column) -> Column:
    """Drop lines before the first line that is not blank and starts with
    neither ``#`` nor ``*``; a text without such a line stays whole."""
    lines = F.split(text, "\n", -1)
    content = F.transform(lines, lambda x: (strip(x) != "") & ~x.startswith("#") & ~x.startswith("*"))
    first = F.array_position(content, True)
    return F.when(first > 1, F.array_join(F.slice(lines, first.cast("int"), F.size(lines)), "\n")).otherwise(text)


def corpus_statistics(docs: DataFrame) -> DataFrame:
    return docs.select(*[c for c in docs.columns if c != "text"],
                       F.length("text").alias("chars"), F.size(words(F.col("text"))).alias("words"))


def _piece(text: Column, group: Column) -> Column:
    return F.struct(text.alias("t"), token_count(text).alias("n"), group.alias("g"))


def _split_once(pieces: Column, separator: str, level: int, size: int) -> Column:
    """Split every piece of ``size`` tokens or more at ``separator``, which
    stays at the head of the following part. Parts of one piece share a group."""
    def parts(p, k):
        group = F.lit(level * 2 ** 32) + k
        if separator == "":
            texts = F.split(p["t"], "")
        else:
            texts = F.transform(split_literal(p["t"], separator),
                                lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(separator), x)))
        return F.transform(F.filter(texts, lambda x: x != ""), lambda x: _piece(x, group))

    big = lambda p: (p["n"] >= size) & F.contains(p["t"], F.lit(separator))
    return F.flatten(F.transform(pieces, lambda p, k: F.when(big(p), parts(p, k)).otherwise(F.array(p))))


def _pack(pieces: Column, size: int, overlap: int, sep_tokens: int) -> Column:
    """Half-open index ranges of pieces that go together, with their tokens and group.

    A range closes when the next piece would exceed ``size`` or belongs to
    another group; within a group the next range starts at the longest tail of
    the closed one that fits in ``overlap`` tokens and leaves room."""
    def tail(start, end, room):
        def grow(acc, p):
            total = acc["total"] + p["n"] + F.when(acc["start"] < end, sep_tokens).otherwise(0)
            fits = acc["open"] & (total <= overlap) & ((total + sep_tokens <= room) | (total == 0))
            return F.when(fits, F.struct((acc["start"] - 1).alias("start"), total.alias("total"), F.lit(True).alias("open"))).otherwise(
                F.struct(acc["start"].alias("start"), acc["total"].alias("total"), F.lit(False).alias("open")))
        first = F.struct(end.alias("start"), F.lit(0).alias("total"), F.lit(True).alias("open"))
        # Only the closed range is read, so that a closing costs no more than its pieces.
        return F.aggregate(F.reverse(F.slice(pieces, start + 1, end - start)), first, grow)

    def closing(s):
        return F.array(F.struct(s["start"].alias("a"), s["i"].alias("b"), s["total"].alias("n"), s["g"].alias("g")))

    def add(s, p):
        held = s["i"] > s["start"]
        fresh = held & (p["g"] != s["g"])
        over = held & (s["total"] + p["n"] + sep_tokens > size)
        closed = F.when(fresh | over, F.concat(s["out"], closing(s))).otherwise(s["out"])
        kept = (F.when(fresh, F.struct(s["i"].alias("start"), F.lit(0).alias("total"), F.lit(True).alias("open")))
                .when(over, tail(s["start"], s["i"], F.lit(size) - p["n"]))
                .otherwise(F.struct(s["start"].alias("start"), s["total"].alias("total"), F.lit(True).alias("open"))))
        return F.struct(kept.alias("k"), closed.alias("out"), (s["i"]).alias("i"), p["n"].alias("n"), p["g"].alias("g"))

    def settle(s):
        k = s["k"]
        total = k["total"] + s["n"] + F.when(k["start"] < s["i"], sep_tokens).otherwise(0)
        return F.struct(k["start"].alias("start"), total.alias("total"), (s["i"] + 1).alias("i"),
                        s["g"].alias("g"), s["out"].alias("out"))

    none = F.array().cast("array<struct<a:int,b:int,n:int,g:bigint>>")
    init = F.struct(F.lit(0).alias("start"), F.lit(0).alias("total"), F.lit(0).alias("i"),
                    F.lit(-1).cast("bigint").alias("g"), none.alias("out"))
    # ``add`` names the tail once so that it is computed once per closing.
    once = lambda s, p: F.element_at(F.transform(F.array(add(s, p)), settle), 1)
    last = lambda s: F.when(s["i"] > s["start"], F.concat(s["out"], closing(s))).otherwise(s["out"])
    return F.aggregate(pieces, init, once, last)


def _emit(df: DataFrame, texts: Column, strategy: str, metadata: dict, trim: bool = True) -> DataFrame:
    """One row per non-empty chunk text, numbered in order. An entry of ``texts`` has the text ``t``
    and its tokens ``n``, null where they have still to be counted."""
    meta = F.create_map(*[F.lit(str(x)) for item in metadata.items() for x in item])
    # Blanks hold no tokens, so trimming leaves their number as it is.
    kept = F.filter(F.transform(texts, lambda x: F.struct(strip(x["t"]).alias("t"), x["n"].alias("n"))) if trim else texts, lambda x: x["t"] != "")
    keep = [c for c in df.columns if c != "text" and not c.startswith("_")]
    rows = df.select(*keep, F.posexplode(kept).alias("chunk_index", "_c"))
    return rows.select(*keep, "chunk_index", F.col("_c.t").alias("text"), F.coalesce("_c.n", token_count(F.col("_c.t"))).alias("token_count"),
                       F.lit(strategy).alias("strategy"), meta.alias("metadata"))


def _pack_and_emit(df: DataFrame, size: int, overlap: int, glue: str, sep_tokens: int, strategy: str, counted) -> DataFrame:
    """``counted`` tells of a group whether a chunk has just the tokens of its pieces."""
    df = df.withColumn("_ranges", _pack(F.col("_pieces"), size, overlap, sep_tokens))
    texts = F.transform("_ranges", lambda r: F.struct(
        F.array_join(F.transform(F.slice(F.col("_pieces"), r["a"] + 1, r["b"] - r["a"]), lambda p: p["t"]), glue).alias("t"),
        F.when(counted(r["g"]), r["n"] - (r["b"] - r["a"] - 1) * sep_tokens).alias("n")))
    return _emit(df, texts, strategy, {"chunk_size": size, "overlap": overlap})


def fixed_size(docs: DataFrame, chunk_size: int = 500, chunk_overlap: int = 50, separator: str = "\n\n",
               separator_tokens: int = 0, mode: str = "pack") -> DataFrame:
    """Pack the parts between ``separator`` up to the size; a part above the
    size stays whole. With ``mode='window'`` see ``token_windows``."""
    if mode == "window":
        return token_windows(docs, chunk_size, chunk_overlap)
    if mode != "pack":
        raise ValueError(f"unknown mode: {mode}")
    parts = F.filter(split_literal(F.col("text"), separator), lambda x: x != "")
    df = docs.withColumn("_pieces", F.transform(parts, lambda x: _piece(x, F.lit(0).cast("bigint"))))
    # Blanks between parts keep their tokens apart and have none.
    blank = separator != "" and set(separator) <= set(" \t\n\x0b\f\r")
    return _pack_and_emit(df, chunk_size, chunk_overlap, separator, separator_tokens, "fixed_size", lambda g: F.lit(blank))


def token_windows(docs: DataFrame, chunk_size: int = 500, chunk_overlap: int = 50) -> DataFrame:
    """Windows of ``chunk_size`` tokens, each beginning ``chunk_size - chunk_overlap`` tokens
    after the last, up to the one that reaches the end (which may be shorter). The text
    is cut out of the document as it stands: start_char to end_char (exclusive), from the
    first token of the window to its last. Texts without tokens, or null, have none.

    A token goes with the blanks before it, so joined tokens are the text, and offsets are
    sums of lengths: per stride first, so long documents are not added up again and again."""
    step = chunk_size - chunk_overlap
    if step <= 0 or chunk_overlap < 0:
        raise ValueError("the overlap must be smaller than the size")
    n = F.size("_tokens")
    count = F.when(n > 0, F.ceil(F.greatest(n - chunk_size, F.lit(0)) / step).cast("int") + 1).otherwise(0)
    numbers = F.when(F.col("_count") > 0, F.sequence(F.lit(0), F.col("_count") - 1)).otherwise(F.array().cast("array<int>"))

    def chars(k):
        return F.aggregate(F.slice("_tokens", k * step + 1, F.lit(step)), F.lit(0), lambda s, x: s + F.length(x))

    def window(k):
        before = F.aggregate(F.slice("_strides", F.lit(1), k), F.lit(0), lambda s, x: s + x)
        return F.struct(k.alias("chunk_index"), before.alias("before"), F.array_join(F.slice("_tokens", k * step + 1, F.lit(chunk_size)), "").alias("raw"),
                        F.least(F.lit(chunk_size), n - k * step).alias("token_count"))

    df = docs.withColumn("_tokens", F.coalesce(F.regexp_extract_all("text", F.lit(rf"\s*(?:{TOKEN})"), F.lit(0)), F.array().cast("array<string>")))
    df = df.withColumn("_count", count).withColumn("_numbers", numbers).withColumn("_strides", F.transform("_numbers", chars))
    keep = [c for c in docs.columns if c != "text"]
    df = df.select(*keep, F.explode(F.transform("_numbers", window)).alias("_w"))
    text = F.regexp_replace("_w.raw", r"^\s+", "")
    start = F.col("_w.before") + F.length("_w.raw") - F.length("text")
    df = df.withColumn("text", text).withColumn("start_char", start)
    return df.select(*keep, "_w.chunk_index", "text", "_w.token_count", "start_char", (F.col("start_char") + F.length("text")).alias("end_char"),
                     F.lit("token_window").alias("strategy"),
                     F.create_map(*[F.lit(str(x)) for x in ("chunk_size", chunk_size, "overlap", chunk_overlap)]).alias("metadata"))


def recursive(docs: DataFrame, chunk_size: int = 500, chunk_overlap: int = 50,
              separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """Split at the first separator present, then again inside parts that are
    still too long, and pack neighbouring parts of one split."""
    whole = F.array(F.struct(F.col("text").alias("t"), F.lit(chunk_size).alias("n"), F.lit(0).cast("bigint").alias("g")))
    df = docs.withColumn("_pieces", whole)
    for level, separator in enumerate(separators, start=1):
        df = df.withColumn("_pieces", _split_once(F.col("_pieces"), separator, level, chunk_size))
    # Parts of a split begin with its separator (but the first); unless that begins with a letter
    # or is empty, no token goes over from one to the next. Group 0 is the text itself, not counted.
    apart = [level for level, x in enumerate(separators, start=1) if x and not (x[0].isalnum() or x[0] == "_")]
    return _pack_and_emit(df, chunk_size, chunk_overlap, "", 0, "recursive", lambda g: F.shiftright(g, 32).isin(apart))


def with_sentences(docs: DataFrame, dim: int = 64, buffer: int = 1) -> DataFrame:
    """Adds ``_sentences``, ``_counts``, the lower-case tokens of each, and ``_distances``, the
    cosine distance of each to the next, both taken with ``buffer`` neighbours on each side.
    A document is one row, so nothing is shuffled."""
    sentences = F.filter(F.split("text", r"(?<=[.?!])\s+"), lambda x: x != "")
    df = docs.withColumn("_sentences", sentences)
    lists = F.transform("_sentences", feature_tokens)
    df = df.withColumn("_made", neighbour_distances(lists, dim, buffer))
    return df.withColumns({"_distances": F.transform("_made.distances", lambda x: F.round(x, 9)), "_counts": F.col("_made.counts")}).drop("_made")


def _percentile(values: Column, share: float) -> Column:
    """Percentile of an array, interpolated between its neighbours."""
    ordered, top = F.array_sort(values), F.size(values) - 1
    at = F.lit(share) * top
    low = F.floor(at).cast("int")
    below, above = F.get(ordered, low), F.get(ordered, F.least(low + 1, top))
    return below + (at - low) * (above - below)


def _mean_and_deviation(values: Column, amount: float) -> Column:
    n = F.size(values)
    mean = F.try_divide(F.aggregate(values, F.lit(0.0), lambda s, x: s + x), n)
    square = F.aggregate(values, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    return mean + amount * F.sqrt(F.try_divide(square, n))


def semantic(docs: DataFrame, threshold_type: str = "percentile", amount: float = 95.0,
             dim: int = 64, buffer: int = 1) -> DataFrame:
    """Break after a sentence whose distance to the next exceeds the document's
    percentile, or its mean plus ``amount`` standard deviations."""
    df = with_sentences(docs, dim, buffer)
    if threshold_type == "percentile":
        limit = _percentile(F.col("_distances"), amount / 100)
    elif threshold_type == "standard_deviation":
        limit = _mean_and_deviation(F.col("_distances"), amount)
    else:
        raise ValueError(f"unknown threshold type: {threshold_type}")
    df = df.withColumn("_limit", F.round(limit, 9))
    last = F.size("_distances")
    breaks = F.when(last > 0, F.filter(F.sequence(F.lit(1), last), lambda i: F.element_at("_distances", i) > F.col("_limit")))
    breaks = F.coalesce(breaks, F.array().cast("array<int>"))
    df = df.withColumn("_ranges", F.zip_with(F.concat(F.array(F.lit(0)), breaks), F.concat(breaks, F.array(F.size("_sentences"))),
                                             lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    def chunk(r):
        text = F.array_join(F.slice("_sentences", r["a"] + 1, r["b"] - r["a"]), " ")
        counted = F.aggregate(F.slice("_counts", r["a"] + 1, r["b"] - r["a"]), F.lit(0), lambda s, n: s + n)
        return F.struct(text.alias("t"), F.when(~F.rlike(text, F.lit(CASE_COUNTS)), counted).alias("n"))

    texts = F.transform("_ranges", chunk)
    return _emit(df, texts, "semantic", {"breakpoint_type": threshold_type, "breakpoint_amount": amount}, trim=False)


STRATEGIES = {
    "fixed_size": fixed_size,
    "recursive": recursive,
    "semantic": semantic,
}


def chunk_documents(docs: DataFrame, strategy: str = "recursive", **options) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown chunking strategy: {strategy}")
    return STRATEGIES[strategy](docs, **options)


def compare_strategies(docs: DataFrame, options: dict[str, dict] | None = None) -> DataFrame:
    """All named strategies side by side; ``options`` maps strategy to settings."""
    options = {s: {} for s in STRATEGIES} if options is None else options
    return reduce(DataFrame.unionByName, [chunk_documents(docs, s, **kw) for s, kw in options.items()])


def chunk_statistics(chunks: DataFrame, order: list[str]) -> DataFrame:
    first = F.min_by(preview(F.col("text")), F.struct(*order))
    return chunks.groupBy("strategy").agg(
        F.count("*").alias("n_chunks"), F.avg("token_count").alias("avg_tokens"),
        F.min("token_count").alias("min_tokens"), F.max("token_count").alias("max_tokens"),
        F.avg(F.length("text")).alias("avg_chars"), first.alias("first_preview"))


def keyword_chunks(chunks: DataFrame, keywords: list[str], order: list[str]) -> DataFrame:
    """Chunks per strategy that mention any keyword, with the first of them."""
    hit = reduce(lambda a, b: a | b, [F.contains("text", F.lit(k)) for k in keywords])
    return chunks.filter(hit).groupBy("strategy").agg(
        F.count("*").alias("n_chunks"), F.min_by(preview(F.col("text"), 300), F.struct(*order)).alias("example"))
