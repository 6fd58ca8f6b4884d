"""Queries over the log view of the events table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import envelope, json_records
from tidewater.operators import admission, loss, offsets, sink, topics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
T0 = 1_704_888_000_000  # 2024-01-10 12:00 UTC, in milliseconds
T1 = 1_705_752_000_000  # ten days later

LOG = f"""
WITH raw AS (
  SELECT event_id, user_id, event_type, value, props, ts, '{envelope.ROOT}' || event_type || '{envelope.PARTITION}' || (user_id % 4) AS topic,
    json_extract_string(props, '$.k') AS k, octet_length(encode(props)) + 8 AS n_bytes, epoch_us(ts) AS publish_us
  FROM events),
seqs AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY ts, event_id) - 1 AS seq FROM raw),
log AS (
  SELECT *, (seq // {envelope.BATCH}) // {envelope.LEDGER_ENTRIES} AS ledger, (seq // {envelope.BATCH}) % {envelope.LEDGER_ENTRIES} AS entry,
    seq % {envelope.BATCH} AS batch_index, CASE WHEN event_id % 10 <> 0 THEN publish_us END AS event_us
  FROM seqs)
"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = LOG + sql
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.log_view(events(spark, sf_dir))


def starts_at(df: DataFrame, seq: int) -> DataFrame:
    """The position of the message numbered ``seq`` in every topic-partition that has it."""
    return df.filter(F.col("seq") == seq).select("__topic", *envelope.POSITION)


def ids(df: DataFrame) -> DataFrame:
    return df.select(F.col("__topic").alias("topic"), "event_id", "ledger", "entry", "batch_index")


def times(df: DataFrame, ms) -> DataFrame:
    return df.select("__topic").distinct().withColumn("ms", ms)


@query("SELECT topic, event_id, CAST(user_id AS VARCHAR) AS msg_key, value, publish_us, event_us, k, ledger, entry, batch_index FROM log")
def envelope_projection(spark, sf_dir):
    df = log(spark, sf_dir)
    return df.select(F.col("__topic").alias("topic"), "event_id", F.decode("__key", "UTF-8").alias("msg_key"), "value", F.unix_micros("__publishTime").alias("publish_us"), F.unix_micros("__eventTime").alias("event_us"), F.col("__messageProperties")["k"].alias("k"), *envelope.POSITION)


@query("SELECT event_id, ledger, entry, batch_index, CAST(user_id % 4 AS INTEGER) AS part FROM log")
def message_id_roundtrip(spark, sf_dir):
    df = log(spark, sf_dir).select("event_id", envelope.position_of(F.col("__messageId")).alias("p"), envelope.partition_of(F.col("__topic")).alias("part"))
    return df.select("event_id", "p.ledger", "p.entry", "p.batch_index", "part")


@query("SELECT topic, count(*) AS n FROM log WHERE event_type = 'purchase' GROUP BY topic")
def topic_single(spark, sf_dir):
    return topics.select_topics(log(spark, sf_dir), topic="purchase").groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"))


@query("SELECT topic, count(*) AS n FROM log WHERE event_type = 'click' OR topic = 'topic://main/default/view-partition-1' GROUP BY topic")
def topic_list(spark, sf_dir):
    return topics.select_topics(log(spark, sf_dir), topics=" click, ,view-partition-1").groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"))


@query("SELECT topic, count(*) AS n FROM log WHERE regexp_full_match(event_type, '(?:si.*|err?or)') GROUP BY topic")
def topic_pattern(spark, sf_dir):
    return topics.select_topics(log(spark, sf_dir), pattern="topic://main/default/(?:si.*|err?or)").groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"))


@query("SELECT 'topic://main/default/' || event_type AS topic, count(DISTINCT topic) AS partitions FROM log GROUP BY 1")
def partition_counts(spark, sf_dir):
    return topics.partitions(log(spark, sf_dir))


_EDGE = "SELECT topic, {f}(ledger, seq) AS ledger, {f}(entry, seq) AS entry, {f}(batch_index, seq) AS batch_index FROM log GROUP BY topic"


@query(_EDGE.format(f="arg_min"))
def earliest_offsets(spark, sf_dir):
    return offsets.earliest(log(spark, sf_dir)).withColumnRenamed("__topic", "topic")


@query(_EDGE.format(f="arg_max"))
def latest_offsets(spark, sf_dir):
    return offsets.latest(log(spark, sf_dir)).withColumnRenamed("__topic", "topic")


@query("SELECT topic, event_id, ledger, entry, batch_index FROM log WHERE seq >= 8")
def range_specific_inclusive(spark, sf_dir):
    df = log(spark, sf_dir)
    return ids(offsets.read(df, start=offsets.at_or_after(df, starts_at(df, 10))))


@query("SELECT topic, event_id, ledger, entry, batch_index FROM log WHERE seq > 10")
def range_resume_exclusive(spark, sf_dir):
    df = log(spark, sf_dir)
    return ids(offsets.read(df, start=starts_at(df, 10), inclusive=False))


@query("SELECT topic, event_id, ledger, entry, batch_index FROM log WHERE seq <= 11")
def range_end_of_batch(spark, sf_dir):
    df = log(spark, sf_dir)
    return ids(offsets.read(df, end=starts_at(df, 9)))


_AT = "first_at AS (SELECT topic, coalesce(min(seq) FILTER (WHERE publish_us >= {t}), max(seq)) AS s FROM log GROUP BY topic)"


@query(f", {_AT.format(t=T0 * 1000)} SELECT log.topic, event_id, ledger, entry, batch_index FROM log JOIN first_at USING (topic) WHERE seq >= s - s % 4")
def range_by_time(spark, sf_dir):
    df = log(spark, sf_dir)
    return ids(offsets.read(df, start=offsets.at_time(df, times(df, F.lit(T0)))))


_MAP = f"""CASE WHEN topic LIKE '%-partition-0' THEN {T0 * 1000} WHEN topic LIKE '%-partition-1' THEN {T1 * 1000} WHEN topic LIKE '%-partition-2' THEN -1 ELSE -2 END"""


@query(
    f""", first_at AS (SELECT topic, CASE WHEN max({_MAP}) = -1 THEN min(seq) WHEN max({_MAP}) = -2 THEN max(seq)
      ELSE coalesce(min(seq) FILTER (WHERE publish_us >= {_MAP}), max(seq)) END AS s FROM log GROUP BY topic)
    SELECT log.topic, event_id, ledger, entry, batch_index FROM log JOIN first_at USING (topic) WHERE seq >= s - s % 4"""
)
def range_by_time_map(spark, sf_dir):
    df = log(spark, sf_dir)
    part = envelope.partition_of(F.col("__topic"))
    ms = F.when(part == 0, T0).when(part == 1, T1).when(part == 2, offsets.TIME_EARLIEST).otherwise(offsets.TIME_LATEST)
    return ids(offsets.read(df, start=offsets.at_time(df, times(df, ms))))


@query(f", {_AT.format(t=T1 * 1000)} SELECT log.topic, event_id, ledger, entry, batch_index FROM log JOIN first_at USING (topic) WHERE seq <= s - s % 4 + 3")
def ending_time(spark, sf_dir):
    df = log(spark, sf_dir)
    return ids(offsets.read(df, end=offsets.at_time(df, times(df, F.lit(T1)))))


@query("SELECT topic, min(ledger) FILTER (WHERE seq = p) AS ledger, min(entry) FILTER (WHERE seq = p) AS entry, min(batch_index) FILTER (WHERE seq = p) AS batch_index FROM (SELECT *, CASE WHEN event_type = 'click' THEN 8 ELSE 0 END AS p FROM log) GROUP BY topic")
def offset_defaults_merge(spark, sf_dir):
    df = log(spark, sf_dir)
    given = starts_at(df.filter(F.col("event_type") == "click"), 8)
    return offsets.with_default(given, offsets.earliest(df)).withColumnRenamed("__topic", "topic")


@query("SELECT topic, CASE WHEN event_type = 'view' THEN 'no start' WHEN event_type = 'click' THEN 'no end' WHEN event_type = 'error' THEN 'end before start' ELSE 'ok' END AS validity FROM (SELECT DISTINCT topic, event_type FROM log)")
def range_validity(spark, sf_dir):
    df = log(spark, sf_dir)
    start = starts_at(df.filter("event_type <> 'view' and event_type <> 'error'"), 5).unionByName(starts_at(df.filter("event_type = 'error'"), 15))
    end = starts_at(df.filter("event_type <> 'click'"), 10)
    return offsets.ranges(start, end).select(F.col("__topic").alias("topic"), "validity")


@query("SELECT topic, CASE WHEN event_type = 'signup' THEN 'new' ELSE 'deleted' END AS change FROM (SELECT DISTINCT topic, event_type FROM log WHERE event_type IN ('signup', 'error'))")
def new_and_deleted_partitions(spark, sf_dir):
    df = log(spark, sf_dir)
    return topics.changes(df.filter("event_type <> 'signup'"), df.filter("event_type <> 'error'")).withColumnRenamed("__topic", "topic")


_GAPS = """, kept AS (SELECT * FROM log WHERE {w}),
lagged AS (SELECT *, lag(seq) OVER (PARTITION BY topic, ledger ORDER BY seq) AS p FROM kept)
SELECT topic, ledger, (p // 4) % 25 AS prev_entry, p % 4 AS prev_batch_index, entry, batch_index FROM lagged WHERE p IS NOT NULL AND seq <> p + 1"""


@query(_GAPS.format(w="event_id % 97 <> 0"))
def gap_detection(spark, sf_dir):
    return loss.gaps(log(spark, sf_dir).filter("event_id % 97 <> 0")).withColumnRenamed("__topic", "topic")


@query(_GAPS.format(w="true"))
def no_gap(spark, sf_dir):
    return loss.gaps(log(spark, sf_dir)).withColumnRenamed("__topic", "topic")


@query("SELECT topic, ledger - ledger AS asked_ledger, min(entry) - 0 - min(entry) AS asked_entry, min(ledger) AS ledger, arg_min(entry, seq) AS entry FROM (SELECT * FROM log WHERE seq >= 12) WHERE ledger = 0 GROUP BY topic, ledger")
def wrong_starts(spark, sf_dir):
    df = log(spark, sf_dir)
    return loss.wrong_starts(df.filter("seq >= 12"), offsets.earliest(df)).withColumnRenamed("__topic", "topic")


@query(
    """, led AS (SELECT topic, ledger, max(entry) + 1 AS entries, sum(n_bytes) AS bytes FROM log GROUP BY topic, ledger),
shares AS (SELECT 40000 // count(DISTINCT topic) AS share FROM led),
rest AS (SELECT led.*, share, greatest(1, bytes // entries) AS avg, CASE WHEN ledger = 0 THEN entries - 3 ELSE entries END AS le,
  CASE WHEN ledger = 0 THEN greatest(1, bytes // entries) * (entries - 3) ELSE bytes END AS lb FROM led, shares),
walk AS (SELECT *, share - coalesce(sum(lb) OVER (PARTITION BY topic ORDER BY ledger ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget FROM rest WHERE le > 0),
taken AS (SELECT *, CASE WHEN ledger = 0 THEN 3 ELSE 0 END + CASE WHEN budget > lb THEN le ELSE least(le, greatest(1, budget // avg)) END - 1 AS last FROM walk WHERE budget > 0)
SELECT topic, max(ledger) AS ledger, CAST(arg_max(last, ledger) AS BIGINT) AS entry FROM taken GROUP BY topic"""
)
def admission_plan(spark, sf_dir):
    df = log(spark, sf_dir)
    out = admission.admit(admission.ledgers(df), starts_at(df, 8), 40_000)
    return out.select(F.col("__topic").alias("topic"), F.col("ledger").cast("long").alias("ledger"), F.col("entry").cast("long").alias("entry"))


@query("SELECT topic, count(*) AS num_input_rows, CAST(sum(n_bytes) AS BIGINT) AS num_input_bytes FROM log GROUP BY topic")
def source_metrics(spark, sf_dir):
    return log(spark, sf_dir).groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("num_input_rows"), F.sum("n_bytes").alias("num_input_bytes"))


@query("SELECT event_id, CAST(k AS BIGINT) AS k FROM log")
def json_decode(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return json_records.flattened(log(spark, sf_dir), "props", schema, ["event_id"])


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(k AS BIGINT) END AS k, event_id % 7 = 0 AS malformed FROM log")
def json_malformed(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.LongType())])
    df = log(spark, sf_dir).withColumn("body", F.when(F.col("event_id") % 7 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props")))
    return df.select("event_id", json_records.decode(F.col("body"), schema).alias("d")).select("event_id", F.col("d.record.k").alias("k"), F.col("d.malformed").alias("malformed"))


@query("SELECT CASE WHEN event_id % 3 = 0 THEN 'audit' ELSE event_type END AS topic, count(*) AS n, min(event_id) AS first_id FROM log GROUP BY 1")
def sink_routing(spark, sf_dir):
    df = events(spark, sf_dir).select(F.when(F.col("event_id") % 3 == 0, "audit").otherwise(F.col("event_type")).alias("__topic"), "event_id")
    return sink.messages(df).groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT 'all' AS topic, CAST(user_id AS VARCHAR) AS msg_key, CASE WHEN event_id % 5 <> 0 THEN publish_us // 1000 END AS event_ms, event_id, value FROM log")
def sink_value_projection(spark, sf_dir):
    df = events(spark, sf_dir)
    ms = F.when(F.col("event_id") % 5 != 0, F.unix_millis(F.col("ts").cast("timestamp"))).otherwise(F.lit(0))
    df = df.select(F.col("user_id").cast("string").alias("__key"), ms.alias("__eventTime"), F.lit("unused").alias("__topic"), "event_id", "value")
    out = sink.messages(df, topic="all")
    return out.select(F.col("__topic").alias("topic"), F.decode("__key", "UTF-8").alias("msg_key"), F.unix_millis("__eventTime").alias("event_ms"), "event_id", "value")


@query("SELECT event_us IS NULL AS missing, count(*) AS n FROM log GROUP BY 1")
def event_time_null_rule(spark, sf_dir):
    return log(spark, sf_dir).groupBy(F.col("__eventTime").isNull().alias("missing")).agg(F.count("*").alias("n"))


@query("SELECT CAST(user_id AS VARCHAR) AS msg_key, arg_max(event_id, (ts, event_id)) AS event_id FROM log GROUP BY user_id")
def dedup_by_key(spark, sf_dir):
    last = F.max(F.struct("__publishTime", "event_id"))["event_id"].alias("event_id")
    return log(spark, sf_dir).groupBy(F.decode("__key", "UTF-8").alias("msg_key")).agg(last)


@query("SELECT epoch_us(time_bucket(INTERVAL '1 hour', ts)) AS window_us, event_type, count(*) AS n, round(sum(value), 2) AS total FROM log GROUP BY 1, 2")
def tumbling_window(spark, sf_dir):
    df = events(spark, sf_dir).groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return df.select(F.unix_micros("w.start").alias("window_us"), "event_type", "n", "total")


@query("SELECT user_id, count(*) AS n FROM log GROUP BY user_id")
def group_count(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT a.user_id % 5 AS bucket, a.event_id AS left_id, b.event_id AS right_id FROM log a JOIN log b ON a.user_id = b.user_id AND a.topic = b.topic AND a.seq + 1 = b.seq")
def self_join(spark, sf_dir):
    df = log(spark, sf_dir).select("__topic", "user_id", "seq", "event_id")
    b = df.select(F.col("__topic").alias("t"), F.col("user_id").alias("u"), (F.col("seq") - 1).alias("s"), F.col("event_id").alias("right_id"))
    met = df.join(b, (F.col("__topic") == F.col("t")) & (F.col("user_id") == F.col("u")) & (F.col("seq") == F.col("s")))
    return met.select((F.col("user_id") % 5).alias("bucket"), F.col("event_id").alias("left_id"), "right_id")
