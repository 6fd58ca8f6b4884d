"""Sessions of messages by the gaps between them, in a stream, with late messages counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(messages: DataFrame, key: str, at: str, gap: str, delay: str) -> DataFrame:
    """key, start, end, n and total (of ``value``) of runs of messages that come within ``gap`` of each other.

    Sessions that a message joins are merged in the state, which holds one row a session.  A session is given once the
    watermark, ``delay`` behind the newest message, has passed its end; messages whose own session would have ended
    before the watermark are dropped as late (:func:`dropped`).  The watermark is in milliseconds, as all of Spark's are.

    A message that isn't late may come within the gap of a session that has been given and left the state; it is given as
    a session of its own then, which overlaps that one.  :func:`joined` makes them one.
    """
    timed = messages.withWatermark(at, delay)
    w = timed.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def joined(given: DataFrame, key: str) -> DataFrame:
    """The sessions of all messages taken, from those that :func:`sessions` has given: those of a key that overlap are one.

    A session is covered by its messages from start to end, so that two sessions overlap just where messages of theirs come within the gap.
    """
    by = Window.partitionBy(key).orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    parts = given.withColumn("apart", F.coalesce((F.col("start") >= before).cast("long"), F.lit(1))).withColumn("k", F.sum("apart").over(by))
    return parts.groupBy(key, "k").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.sum("total").alias("total")).drop("k")


def dropped(query: StreamingQuery) -> int:
    """How many rows a run of a query has dropped as late."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state after each batch of a run."""
    return [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress if p.stateOperators]
