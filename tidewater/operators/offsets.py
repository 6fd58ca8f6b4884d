"""Offset algebra: earliest, latest, given positions and times, per topic-partition; ranges and their validity.

Offsets are DataFrames of (__topic, ledger, entry, batch_index): one row per topic-partition, joined on it.  A position
inside a batch stands for the whole batch: reads begin and end with entries.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.envelope import POSITION, position

SCHEMA = "__topic string, ledger long, entry long, batch_index long"
#: How JSON times say earliest and latest.
TIME_EARLIEST, TIME_LATEST = -1, -2


def entry(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}ledger").alias("ledger"), F.col(f"{prefix}entry").alias("entry"))


def _best(log: DataFrame, best: Column) -> DataFrame:
    return log.groupBy("__topic").agg(best.alias("p")).select("__topic", *[F.col(f"p.{c}").alias(c) for c in POSITION])


def earliest(log: DataFrame) -> DataFrame:
    return _best(log, F.min(position()))


def latest(log: DataFrame) -> DataFrame:
    return _best(log, F.max(position()))


def at_or_after(log: DataFrame, given: DataFrame) -> DataFrame:
    """The first message at or after given positions; the batch index of a given position doesn't count.

    Topic-partitions with no message there get their latest one.
    """
    g = given.select(F.col("__topic").alias("_t"), entry().alias("_from"))
    met = log.join(g, F.col("__topic") == F.col("_t"))
    first = F.min(F.when(entry() >= F.col("_from"), position()))
    return _best(met, F.coalesce(first, F.max(position())))


def at_time(log: DataFrame, times: DataFrame) -> DataFrame:
    """The first message published at or after ``ms`` (epoch milliseconds) of each topic-partition, else its latest.

    ``times`` has (__topic, ms); -1 stands for earliest and -2 for latest.
    """
    t = times.select(F.col("__topic").alias("_t"), "ms")
    met = log.join(t, F.col("__topic") == F.col("_t"))
    after = F.unix_micros("__publishTime") >= F.col("ms") * 1000
    wanted = F.when((F.col("ms") == TIME_EARLIEST) | ((F.col("ms") > 0) & after), position())
    return _best(met, F.coalesce(F.min(wanted), F.max(position())))


def with_default(given: DataFrame, default: DataFrame) -> DataFrame:
    """Given offsets, and those of ``default`` for topic-partitions not given."""
    g = given.select(F.col("__topic").alias("_t"), position().alias("_p"))
    both = default.select("__topic", position().alias("_d")).join(g, F.col("__topic") == F.col("_t"), "left")
    p = F.coalesce("_p", "_d")
    return both.select("__topic", *[p[c].alias(c) for c in POSITION])


def unknown_topics(given: DataFrame, partitions: DataFrame) -> DataFrame:
    """Topics with given offsets that aren't among the selected topic-partitions; there must be none."""
    return given.select("__topic").join(partitions.select("__topic").distinct(), "__topic", "left_anti")


def ranges(start: DataFrame, end: DataFrame) -> DataFrame:
    """__topic, start and end positions, and ``validity`` of the range: 'ok', 'end before start', 'no start' or 'no end'."""
    s = start.select("__topic", position().alias("start"))
    e = end.select(F.col("__topic").alias("_t"), position().alias("end"))
    both = s.join(e, F.col("__topic") == F.col("_t"), "full")
    validity = F.when(F.col("start").isNull(), "no start").when(F.col("end").isNull(), "no end").when(F.col("end") < F.col("start"), "end before start").otherwise("ok")
    return both.select(F.coalesce("__topic", "_t").alias("__topic"), "start", "end", validity.alias("validity"))


def read(log: DataFrame, start: DataFrame | None = None, end: DataFrame | None = None, inclusive: bool = True) -> DataFrame:
    """Messages from ``start`` to ``end``, with all of the end's batch.

    A start that a user gave is read with (``inclusive``); one at which a query stopped is not.
    """
    out = log
    if start is not None:
        s = start.select(F.col("__topic").alias("_s"), entry().alias("_from"), position().alias("_after"))
        keep = entry() >= F.col("_from") if inclusive else position() > F.col("_after")
        out = out.join(s, F.col("__topic") == F.col("_s")).filter(keep).drop("_s", "_from", "_after")
    if end is not None:
        e = end.select(F.col("__topic").alias("_e"), entry().alias("_to"))
        out = out.join(e, F.col("__topic") == F.col("_e")).filter(entry() <= F.col("_to")).drop("_e", "_to")
    return out


def to_json(offsets: dict[str, tuple[int, int, int]]) -> str:
    """Offsets as JSON, topics in order."""
    return json.dumps({t: list(map(int, p)) for t, p in sorted(offsets.items())}, separators=(",", ":"))


def from_json(text: str) -> dict[str, tuple[int, int, int]]:
    """Offsets from JSON: topic -> [ledger, entry] or [ledger, entry, batch index]."""
    try:
        out = {t: tuple(int(x) for x in p) for t, p in json.loads(text).items()}
    except (ValueError, TypeError, AttributeError) as e:
        raise ValueError(f'expected offsets like {{"topic-A":[23,0,0]}}, got {text}') from e
    if any(len(p) not in (2, 3) for p in out.values()):
        raise ValueError(f"a position has a ledger, an entry and, if in a batch, an index: {text}")
    return {t: (*p, 0)[:3] for t, p in out.items()}


def times_from_json(text: str) -> dict[str, int]:
    """Times from JSON: topic -> epoch milliseconds."""
    try:
        return {t: int(v) for t, v in json.loads(text).items()}
    except (ValueError, TypeError, AttributeError) as e:
        raise ValueError(f'expected times like {{"topic-A":1000}}, got {text}') from e


def frame(spark: SparkSession, offsets: dict[str, tuple[int, int, int]]) -> DataFrame:
    """A small table of given offsets."""
    return spark.createDataFrame([(t, *p) for t, p in offsets.items()], SCHEMA)
