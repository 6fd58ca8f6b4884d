"""Column helpers shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def whole(c: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(c, F.lit(""))


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, GAP), "")


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def n_of(c: Column, chars: str) -> Column:
    """How many characters of ``c`` are in ``chars``."""
    if len(chars) == 1:
        return (F.length(c) - F.length(F.replace(c, F.lit(chars), F.lit("")))).cast("long")
    return F.regexp_count(c, F.lit("[" + "".join(f"\\x{{{ord(x):x}}}" for x in chars) + "]")).cast("long")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; columns that callers have added stay behind, so that none can clash."""
    return df.select(*[df[n] for n in names])
