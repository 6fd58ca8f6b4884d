"""Choosing topics: one, a list, or a pattern; their partitions, and how those change between two looks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.envelope import base_topic


def full_name(topic: str, root: str = "topic://main/default/") -> str:
    return topic if "://" in topic else root + topic


def select_topics(log: DataFrame, topic: str | None = None, topics: str | None = None, pattern: str | None = None) -> DataFrame:
    """Messages of the chosen topics and all their partitions.

    A pattern has to match the whole name after ``://``, without the partition's suffix.  Each form is a predicate on
    ``__topic``, so that directories of other topics are pruned where the log is laid out by it.
    """
    name = F.col("__topic")
    if topic is not None:
        wanted = full_name(topic.strip())
        return log.filter((name == wanted) | (base_topic(name) == wanted))
    if topics is not None:
        wanted = [full_name(t.strip()) for t in topics.split(",") if t.strip()]
        return log.filter(name.isin(wanted) | base_topic(name).isin(wanted))
    local = full_name(pattern).split("://", 1)[1]
    return log.filter(F.regexp_extract(base_topic(name), "://(.*)$", 1).rlike(f"^(?:{local})$"))


def partitions(log: DataFrame) -> DataFrame:
    """topic, partitions: how many topic-partitions each topic has."""
    return log.select(base_topic(F.col("__topic")).alias("topic"), "__topic").groupBy("topic").agg(F.count_distinct("__topic").alias("partitions"))


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """__topic and change ('new' or 'deleted') between two tables of topic-partitions.

    New ones are read from the earliest message; deleted ones are lost data.
    """
    a, b = before.select("__topic").distinct(), now.select("__topic").distinct()
    return b.join(a, "__topic", "left_anti").withColumn("change", F.lit("new")).unionByName(a.join(b, "__topic", "left_anti").withColumn("change", F.lit("deleted")))
