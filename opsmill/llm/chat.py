"""Chat formatting by prefix-target expansion, as column expressions only.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply is trainable. Turns are marked by a template whose
control strings are escaped inside texts, so the turns can be read back.

    <|turn:user|>\\nHello<|end|>\\n<|turn:assistant|>\\nHi<|end|>\\n
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MID, END = "<|turn:", "|>\n", "<|end|>\n"
# Escaped inside texts: this template's marks, and those that other templates
# use, so that a text can never be taken for markup downstream.
CONTROL = r"(<|\[)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """A backslash doubles; one goes into every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1\\\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def expand(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           target: str = "assistant") -> DataFrame:
    """One row per example: conv_id, example (from 0), text, loss_start,
    loss_end (code points into ``text``; what lies between is trainable).

    Turns go by turn number, then role, then text; repeated rows stay. Null
    roles and texts are empty; rows without conversation id form one
    conversation. Turns after the last reply, or a conversation without any,
    form a last example with an empty loss span, so no turn is lost. Other
    columns are not carried. A conversation is one document to the model, so
    its turns meet in one task; the rows are dealt once, by conversation.
    """
    rows = conversations.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"),
                 F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    turns = turns.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t.role == target).alias("reply"),
        F.concat(F.lit(OPEN), escape_role(t.role), F.lit(MID)).alias("head"),
        escape(t.text).alias("body"))).alias("turns"))
    places = F.filter(F.transform("turns", lambda t, i: F.when(t.reply | (i == F.size("turns") - 1), i)), lambda i: i.isNotNull())
    one = turns.select("conv_id", "turns", F.posexplode(places).alias("example", "at"))
    last = F.get("turns", F.col("at"))
    before = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("at")), lambda t: F.concat(t.head, t.body, F.lit(END))), "")
    one = one.select("conv_id", "example", last.alias("last"), F.concat(before, last.head).alias("context"))
    start = F.length("context")
    return one.select(
        "conv_id", "example", F.concat("context", "last.body", F.lit(END)).alias("text"), start.alias("loss_start"),
        (start + F.when(F.col("last.reply"), F.length("last.body")).otherwise(0)).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    parts = F.slice(F.split(text, r"<\|end\|>\n"), F.lit(1), F.size(F.split(text, r"<\|end\|>\n")) - 1)
    head = r"(?s)^<\|turn:((?:[^\\|]|\\.)*)\|>\n(.*)$"
    return F.transform(parts, lambda p: F.struct(
        unescape(F.regexp_extract(p, head, 1)).alias("role"), unescape(F.regexp_extract(p, head, 2)).alias("text")))


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """What is trainable, as it was written."""
    return unescape(F.substring(text, start + 1, end - start))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns and trainable text."""
    per = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss")))).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"))
    per = per.select("conv_id", read_turns(F.col("whole")).alias("turns"), F.array_join(F.col("losses.loss"), "").alias("loss"), "formatted_chars")
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return per.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
