"""Queries that publish events to topics and read them back, in batch and as streams; the result is again the events table's."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import avro, schemas
from tidewater.functions.envelope import PARTITION
from tidewater.sources import parquet_log, topic_tables
from tidewater.sources.places import shared_folder
from tidewater.streaming.replay import drained, replayed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def outgoing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows for the sink: routed by type and user, keyed by user."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    topic = F.concat("event_type", F.lit(PARTITION), F.pmod("user_id", F.lit(4)).cast("string"))
    at = F.col("ts").cast("timestamp")
    return df.select(topic.alias("__topic"), F.col("user_id").cast("string").alias("__key"), at.alias("__eventTime"), F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("__messageProperties"), "event_id", "value", "props")


def shown(df: DataFrame) -> DataFrame:
    return df.select("event_id", "value", F.decode("__key", "UTF-8").alias("msg_key"), F.unix_micros("__eventTime").alias("event_us"), F.col("__messageProperties")["k"].alias("k"), F.col("__topic").alias("topic"))


_ALL = "SELECT event_id, value, CAST(user_id AS VARCHAR) AS msg_key, epoch_us(ts) AS event_us, json_extract_string(props, '$.k') AS k, 'topic://main/default/' || event_type || '-partition-' || (user_id % 4) AS topic FROM events"


#: The value columns of outgoing().
VALUES = T.StructType().add("event_id", "long").add("value", "double").add("props", "string")


@query(_ALL)
def sink_roundtrip(spark, sf_dir):
    """Events published to topics and read back."""
    path = shared_folder(spark, "topics")
    topic_tables.publish(outgoing(spark, sf_dir), path)
    return shown(topic_tables.scan(spark, path, VALUES, pattern=".*"))


def _streamed(messages: DataFrame, out: str) -> None:
    drained(shown(messages).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint"))


@query(_ALL)
def stream_restart(spark, sf_dir):
    """Two runs of one streaming query; half of the messages come while it is stopped."""
    path, out, df = shared_folder(spark, "topics"), shared_folder(spark, "stream"), outgoing(spark, sf_dir)
    for half in (0, 1):
        topic_tables.publish(df.filter(F.col("event_id") % 2 == half), path)
        _streamed(topic_tables.follow(spark, path, VALUES, pattern=".*"), out)
    return spark.read.parquet(f"{out}/rows")


@query(_ALL + " WHERE event_type = 'view'")
def stream_admission(spark, sf_dir):
    """A stream of one topic that takes a bounded number of bytes a batch, until all are read."""
    path, out = shared_folder(spark, "topics"), shared_folder(spark, "stream")
    topic_tables.publish(outgoing(spark, sf_dir), path)
    limit = max(1, topic_tables.n_bytes(spark, path, topic="view") // 4)
    _streamed(topic_tables.follow(spark, path, VALUES, max_bytes=limit, topic="view"), out)
    return spark.read.parquet(f"{out}/rows")


@query(_ALL)
def stream_publish(spark, sf_dir):
    """Events published by a stream, each batch once, and read back from the topics."""
    out, df = shared_folder(spark, "published"), outgoing(spark, sf_dir)
    sink = topic_tables.TopicSink(out)
    run = lambda s: drained(s.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint"))
    replayed(df, F.col("event_id") % 3, 3, run)
    return shown(sink.read(spark))


@query("SELECT event_id, user_id, value, props, epoch_us(ts) AS ts_us, CASE WHEN event_id % 3 <> 0 THEN event_type END AS maybe FROM events")
def avro_roundtrip(spark, sf_dir):
    """Each row to an Avro record's bytes and back."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = df.select("event_id", "user_id", "value", "props", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("maybe"))
    schema = schemas.to_avro(df.schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = avro.encoder(schema)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                put(row, data := bytearray())
                out.append(bytes(data))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["payload"])

    kind = T.StructType([*df.schema.fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        get, arrow = avro.decoder(schema), to_arrow_schema(kind)
        for batch in batches:
            rows = [get(avro.Input(b)) for b in batch.column(0).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    out = df.mapInArrow(encode, "payload binary").mapInArrow(decode, kind)
    return out.select("event_id", "user_id", "value", "props", F.unix_micros("ts").alias("ts_us"), "maybe")


@query(
    "SELECT 'topic://main/default/' || event_type || '-partition-' || (user_id % 4) AS topic, count(*) AS n, count(DISTINCT user_id) AS keys, max(epoch_us(ts)) AS last_us "
    "FROM events WHERE event_type IN ('view', 'click') GROUP BY 1"
)
def stored_log_scan(spark, sf_dir):
    """Topics scanned in a batch, folders of others pruned."""
    path = shared_folder(spark, "topics")
    topic_tables.publish(outgoing(spark, sf_dir), path)
    df = topic_tables.scan(spark, path, VALUES, pattern="(?:view|click)")
    return df.groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"), F.count_distinct("__key").alias("keys"), F.max(F.unix_micros("__eventTime")).alias("last_us"))


#: A value of each primitive kind from an event, in Spark's words and in DuckDB's.
_PRIMITIVES = {
    "boolean": ("BOOLEAN", "event_id % 3 = 0", "event_id % 3 = 0"),
    "tinyint": ("INT8", "cast(user_id % 100 - 50 as tinyint)", "user_id % 100 - 50"),
    "smallint": ("INT16", "cast(event_id % 30000 - 15000 as smallint)", "event_id % 30000 - 15000"),
    "int": ("INT32", "cast(-user_id * 1000 as int)", "-user_id * 1000"),
    "bigint": ("INT64", "event_id * -1000000007", "event_id * -1000000007"),
    "string": ("STRING", "concat('é', props)", "'é' || props"),
}


@query(" UNION ALL ".join(f"SELECT '{kind}' AS kind, CAST({sql} AS VARCHAR) AS v FROM events" for kind, (_, _, sql) in _PRIMITIVES.items()))
def primitive_roundtrip(spark, sf_dir):
    """Topics of one primitive value each, written as the kind's bytes and read back by its schema."""
    df, path = spark.read.parquet(f"{sf_dir}/events.parquet"), shared_folder(spark, "topics")
    payloads = F.array(*[F.struct(F.lit(name).alias("__topic"), parquet_log.payload(F.expr(sql), kind).alias("payload")) for name, (kind, sql, _) in _PRIMITIVES.items()])
    topic_tables.publish(df.select(F.inline(payloads)), path)
    parts = []
    for name, (kind, _, _) in _PRIMITIVES.items():
        one = parquet_log.values(topic_tables.scan(spark, path, T.StructType().add("payload", "binary"), topic=name), {"type": kind})
        parts.append(one.select(F.lit(name).alias("kind"), F.col("value").cast("string").alias("v")))
    return reduce(DataFrame.union, parts)
