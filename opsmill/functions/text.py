"""Token and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of letters, digits and underscores, or one other visible character. \w is
# a-z, A-Z, 0-9 and _, which are told faster than the classes that hold them.
TOKEN = r"[\w\p{L}\p{N}]+|\S"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def words(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def split_literal(text: Column, separator: str) -> Column:
    """Split on a literal string, keeping empty parts."""
    return F.split(text, "".join(f"\\{c}" if c in r"\.[]{}()*+-?^$|" else c for c in separator), -1)


def preview(text: Column, length: int = 200) -> Column:
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)
