"""Finding lost messages in what was read, and what to do about it."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.envelope import position


class DataLossError(RuntimeError):
    """Messages that should have been read are gone."""


def report(message: str, fail: bool) -> None:
    """Raises if ``fail``, else warns."""
    text = f"Potential Data Loss: {message}"
    if fail:
        raise DataLossError(text)
    warnings.warn(text, RuntimeWarning, stacklevel=2)


def gaps(log: DataFrame) -> DataFrame:
    """Messages that don't follow the one before them in their ledger: __topic, position before and position.

    The next message of a batch has the next index; after a batch's last comes index 0 of the next entry.  The window is
    by ledger, so that a topic-partition is checked in parts; a ledger is bounded.
    """
    w = Window.partitionBy("__topic", "ledger").orderBy("entry", "batch_index")
    df = log.select("__topic", "ledger", "entry", "batch_index", "batch_size")
    df = df.withColumns({c: F.lag(c[5:]).over(w) for c in ("prev_entry", "prev_batch_index", "prev_batch_size")})
    inside = (F.col("entry") == F.col("prev_entry")) & (F.col("batch_index") == F.col("prev_batch_index") + 1)
    after = (F.col("entry") == F.col("prev_entry") + 1) & (F.col("batch_index") == 0) & (F.col("prev_batch_index") == F.col("prev_batch_size") - 1)
    return df.filter(F.col("prev_entry").isNotNull() & ~(inside | after)).select("__topic", "ledger", "prev_entry", "prev_batch_index", "entry", "batch_index")


def wrong_starts(log: DataFrame, start: DataFrame) -> DataFrame:
    """Topic-partitions whose first message isn't in the entry that was asked for; the message itself is delivered."""
    first = log.groupBy("__topic").agg(F.min(position()).alias("first"))
    s = start.select(F.col("__topic").alias("_t"), F.col("ledger").alias("asked_ledger"), F.col("entry").alias("asked_entry"))
    met = first.join(s, F.col("__topic") == F.col("_t"))
    wrong = (F.col("first.ledger") != F.col("asked_ledger")) | (F.col("first.entry") != F.col("asked_entry"))
    return met.filter(wrong).select("__topic", "asked_ledger", "asked_entry", F.col("first.ledger").alias("ledger"), F.col("first.entry").alias("entry"))
