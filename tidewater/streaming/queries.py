"""Streaming queries over a topic log, in Structured Streaming's own operators."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewater.sources.topic_log import TopicLog


def stream(spark: SparkSession, **options: str) -> DataFrame:
    spark.dataSource.register(TopicLog)
    return spark.readStream.format("tidewater").options(**options).load()


def windowed_counts(messages: DataFrame, watermark: str, window: str, *keys: str) -> DataFrame:
    """Counts by tumbling windows of the publish time; windows end when the watermark has passed them."""
    late = messages.withWatermark("__publishTime", watermark)
    return late.groupBy(F.window("__publishTime", window), *keys).agg(F.count("*").alias("n"))


def deduplicated(messages: DataFrame, watermark: str, *keys: str) -> DataFrame:
    """Each key once within the watermark; the sink writes at least once, so readers that need each once do this."""
    return messages.withWatermark("__publishTime", watermark).dropDuplicatesWithinWatermark(list(keys))


def measured(messages: DataFrame, name: str, payload_bytes: Column) -> DataFrame:
    """``messages``, with the metrics numInputRows and numInputBytes observed for each batch."""
    return messages.observe(name, F.count(F.lit(1)).alias("numInputRows"), F.sum(payload_bytes).alias("numInputBytes"))


class Metrics(StreamingQueryListener):
    """Collects what measured() observes, by batch."""

    def __init__(self, name: str):
        self.name, self.batches, self._lock = name, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                self.batches[event.progress.batchId] = {"numInputRows": row["numInputRows"], "numInputBytes": row["numInputBytes"] or 0}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def until_done(query: StreamingQuery) -> None:
    """Runs a query until it has read all there is, then stops it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
