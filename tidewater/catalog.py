"""The engine's registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import topics
from tidewater.plans import io_queries, log_queries, record_queries, stream_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = log_queries.QUERIES | io_queries.QUERIES | stream_queries.QUERIES | record_queries.QUERIES
ORACLE: dict[str, str] = log_queries.ORACLE | io_queries.ORACLE | stream_queries.ORACLE | record_queries.ORACLE


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all topics that match a pattern, from earliest to latest, counted and summed by hour and type."""
    log = topics.select_topics(log_queries.log(spark, sf_dir), pattern="topic://main/default/.*")
    out = log.groupBy(F.window("__publishTime", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return out.select(F.unix_micros("w.start").alias("window_us"), "event_type", "n", "total")
