"""Joins of streams with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within(stream: DataFrame, key: str, at: str, span: str, delay: str, keep: list[str]) -> DataFrame:
    """``stream`` joined with itself: messages of one ``key`` and those that come up to ``span`` after them, left_ and right_ ``keep``.

    Both sides are one source, so that each row is read once and one offset is logged.  ``at`` has a watermark of
    ``delay``; as times are bounded on both sides, a row's state goes once the watermark says that no partner can come.
    A message doesn't meet itself: of messages at the same time, the left one is that with the lesser ``keep``.
    """
    known = stream.filter(F.col(key).isNotNull()).withWatermark(at, delay)

    def side(name: str) -> DataFrame:
        return known.select(F.col(key).alias(f"{name}_key"), F.col(at).alias(f"{name}_at"), *[F.col(c).alias(f"{name}_{c}") for c in keep])

    a, b = side("left"), side("right")
    later = (F.col("right_at") >= F.col("left_at")) & (F.col("right_at") <= F.col("left_at") + F.expr(f"interval {span}"))
    order = lambda x: F.struct(f"{x}_at", *[f"{x}_{c}" for c in keep])
    return a.join(b, (F.col("left_key") == F.col("right_key")) & later & (order("left") < order("right")))


def same_window(stream: DataFrame, key: str, at: str, window: str, delay: str) -> DataFrame:
    """``stream`` joined with itself by ``key`` and tumbling window: key and window of every pair, each row with itself too.

    Equality of windows of event time bounds the state: a window's rows go once the watermark has passed its end.
    """
    timed = stream.filter(F.col(key).isNotNull()).withWatermark(at, delay)
    a = timed.select(F.col(key).alias("key"), F.window(at, window).alias("w"))
    b = timed.select(F.col(key).alias("key2"), F.window(at, window).alias("w2"))
    return a.join(b, (F.col("key") == F.col("key2")) & (F.col("w") == F.col("w2"))).select("key", "w")
