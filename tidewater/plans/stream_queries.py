"""Streaming queries over the log view and the events table, by Spark's own file source and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import offsets
from tidewater.plans import log_queries
from tidewater.sources.places import shared_folder
from tidewater.streaming import joins, losses, sessions, sinks
from tidewater.streaming.queries import deduplicated
from tidewater.streaming.replay import day, drained, feed, replayed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Days of the table, from which slices are made: 2024-01-01 and ten days a slice.
FIRST_DAY, SLICE_DAYS, SLICES = 19723, 10, 3


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def thirds(ts):
    return F.least(F.greatest(F.floor((day(ts) - FIRST_DAY) / SLICE_DAYS), F.lit(0)), F.lit(SLICES - 1))


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_queries.events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def appended(df: DataFrame, out: str) -> None:
    """One run of a query that appends to Parquet files at ``out``/rows."""
    drained(df.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint"))


@query(log_queries.LOG + log_queries._GAPS.format(w="event_id % 97 <> 0"))
def stream_gaps(spark, sf_dir):
    """Gaps found over micro-batches and restarts, with the last position of each ledger as state."""
    out, log = shared_folder(spark, "gaps"), log_queries.log(spark, sf_dir).filter("event_id % 97 <> 0")
    log = log.select("__topic", "ledger", "entry", "batch_index", "batch_size", "__publishTime")
    replayed(log, thirds("__publishTime"), SLICES, lambda df: appended(losses.gaps(df, idle_ms=SLICES * SLICE_DAYS * 86_400_000), out))
    return spark.read.schema(losses.GAPS).parquet(f"{out}/rows").withColumnRenamed("__topic", "topic")


@query(log_queries.ORACLE["wrong_starts"])
def stream_wrong_starts(spark, sf_dir):
    """Topic-partitions whose stream began elsewhere than asked, from running minima in update mode."""
    out, log = shared_folder(spark, "starts"), log_queries.log(spark, sf_dir)
    asked, lost = offsets.earliest(log), log.filter("seq >= 12").select("__topic", "ledger", "entry", "batch_index", "__publishTime")
    sink = sinks.OnceSink(out)
    run = lambda df: drained(losses.starts(df).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint"))
    replayed(lost, thirds("__publishTime"), SLICES, run)
    return losses.wrong_starts(sink.read(spark).drop("stream", "batch"), asked).withColumnRenamed("__topic", "topic")


@query(
    """SELECT a.user_id AS user_id, a.event_id AS left_id, b.event_id AS right_id FROM events a JOIN events b ON a.user_id = b.user_id
    AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR AND (a.ts < b.ts OR a.ts = b.ts AND a.event_id < b.event_id)"""
)
def stream_interval_join(spark, sf_dir):
    """Pairs of a user's events within an hour: a stream joined with itself, with state that the watermark bounds."""
    out, df = shared_folder(spark, "pairs"), timed(spark, sf_dir).select("event_id", "user_id", "ts")
    replayed(df, thirds("ts"), SLICES, lambda s: appended(joins.within(s, "user_id", "ts", "1 hour", "10 minutes", ["event_id"]).select(F.col("left_key").alias("user_id"), F.col("left_event_id").alias("left_id"), F.col("right_event_id").alias("right_id")), out))
    return spark.read.schema("user_id long, left_id long, right_id long").parquet(f"{out}/rows")


@query("SELECT CAST(a.user_id AS VARCHAR) AS key, count(*) AS n FROM events a JOIN events b ON a.user_id = b.user_id AND time_bucket(INTERVAL '1 hour', a.ts) = time_bucket(INTERVAL '1 hour', b.ts) GROUP BY 1")
def stream_self_join(spark, sf_dir):
    """A stream joined with itself by user and hour, then counted."""
    out, df = shared_folder(spark, "joined"), timed(spark, sf_dir).select(F.col("user_id").cast("string").alias("user"), "ts")
    replayed(df, thirds("ts"), SLICES, lambda s: appended(joins.same_window(s, "user", "ts", "1 hour", "10 minutes").select("key"), out))
    return spark.read.schema("key string").parquet(f"{out}/rows").groupBy("key").agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS key FROM events")
def stream_redelivered(spark, sf_dir):
    """Every event once, of a stream that delivers every third twice: ids are remembered within the watermark."""
    out, df = shared_folder(spark, "redelivered"), timed(spark, sf_dir).select("event_id", F.col("user_id").cast("string").alias("key"), F.col("ts").alias("__publishTime"))
    twice = df.unionByName(df.filter("event_id % 3 = 0"))
    replayed(twice, thirds("__publishTime"), SLICES, lambda s: appended(deduplicated(s, "1 hour", "event_id").select("event_id", "key"), out))
    return spark.read.schema("event_id long, key string").parquet(f"{out}/rows")


@query("SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1")
def stream_update_counts(spark, sf_dir):
    """Running counts of every user in update mode, kept by batch; the last of each user."""
    out, df = shared_folder(spark, "updates"), timed(spark, sf_dir).select(F.col("user_id").cast("string").alias("key"), "ts")
    sink = sinks.OnceSink(out)
    run = lambda s: drained(s.groupBy("key").agg(F.count("*").alias("n")).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint"))
    replayed(df, thirds("ts"), SLICES, run)
    return sink.read(spark).groupBy("key").agg(F.max_by("n", "batch").alias("n"))


@query("SELECT topic, count(*) AS n, CAST(sum(n_bytes) AS BIGINT) AS bytes, max(seq) AS last FROM (" + log_queries.LOG + "SELECT topic, n_bytes, seq FROM log) GROUP BY topic")
def stream_bounded_batches(spark, sf_dir):
    """A backlog of many files drained under AvailableNow in batches of a bounded number of bytes and files."""
    path, out = shared_folder(spark, "backlog"), shared_folder(spark, "bounded")
    log = log_queries.log(spark, sf_dir).select("__topic", "n_bytes", "seq")
    log.repartition(16, "seq").write.parquet(path)
    appended(feed(spark, path, log, maxFilesPerTrigger="4"), out)
    rows = spark.read.schema(log.schema).parquet(f"{out}/rows")
    return rows.groupBy(F.col("__topic").alias("topic")).agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"), F.max("seq").alias("last"))


class Crashing(sinks.OnceSink):
    """A sink that fails once after storing a batch, and once after logging another."""

    def __init__(self, path: str):
        super().__init__(path)
        self.left = {("store", 0), ("commit", 1)}

    def crash(self, at: str, batch: int) -> None:
        if (at, batch) in self.left:
            self.left.remove((at, batch))
            raise RuntimeError(f"crashed after {at} of batch {batch}")

    def __call__(self, rows: DataFrame, batch: int) -> None:
        super().__call__(rows, batch)
        self.crash("commit", batch)

    def store(self, rows: DataFrame, batch: int) -> None:
        super().store(rows, batch)
        self.crash("store", batch)


@query("SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us FROM events")
def stream_once_sink(spark, sf_dir):
    """Every event once, by a sink that crashes between storing and logging a batch and after logging one, and is restarted."""
    out, df = shared_folder(spark, "once"), timed(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts")
    sink = Crashing(out)

    def run(stream: DataFrame) -> None:
        while True:
            try:
                return drained(stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint"))
            except Exception as e:
                if "crashed after" not in str(e):
                    raise

    replayed(df, thirds("ts"), SLICES, run)
    return sink.read(spark).select("event_id", "user_id", "event_type", "value", F.unix_micros("ts").alias("ts_us"))


@query("SELECT event_id, user_id, event_type, value, props FROM events")
def stream_foreach(spark, sf_dir):
    """Every event by a foreach writer of files, one for each partition and epoch."""
    out, df = shared_folder(spark, "foreach"), timed(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props", "ts")
    run = lambda s: drained(s.drop("ts").writeStream.foreach(sinks.OnceWriter(f"{out}/rows")).option("checkpointLocation", f"{out}/checkpoint"))
    replayed(df, thirds("ts"), SLICES, run)
    return spark.read.schema(df.drop("ts").schema).json(f"{out}/rows/epoch=*")


#: Every 50th event comes with the slice after its own; a day is what the watermark leaves.
LATE, GAP_MIN, DELAY_H = 50, 30, 24


@query(
    f"""WITH sliced AS (SELECT *, least(greatest((epoch_us(ts) // 86400000000 - {FIRST_DAY}) // {SLICE_DAYS}, 0), {SLICES - 1}) AS s FROM events),
    newest AS (SELECT s, max(ts) AS m FROM sliced WHERE event_id % {LATE} <> 0 GROUP BY s),
    kept AS (SELECT e.* FROM sliced e JOIN newest n USING (s) WHERE event_id % {LATE} <> 0 OR e.ts + INTERVAL {GAP_MIN} MINUTE > n.m - INTERVAL {DELAY_H} HOUR),
    marked AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL {GAP_MIN} MINUTE THEN 0 ELSE 1 END AS first FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM marked)
    SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + {GAP_MIN * 60_000_000} AS end_us, count(*) AS n, round(sum(value), 2) AS total FROM numbered GROUP BY user_id, k"""
)
def stream_sessions(spark, sf_dir):
    """Sessions of users over slices of which some events come late; a last heartbeat lets the watermark pass all of them."""
    out, df = shared_folder(spark, "sessions"), timed(spark, sf_dir).select("event_id", "user_id", "value", "ts")
    beat = spark.sql("SELECT -1L AS event_id, CAST(NULL AS BIGINT) AS user_id, 0.0D AS value, timestamp'2100-01-01 00:00:00' AS ts")
    slices = F.when(F.col("event_id") < 0, SLICES + 1).otherwise(thirds("ts") + (F.col("event_id") % LATE == 0).cast("int"))
    replayed(df.unionByName(beat), slices, SLICES + 2, lambda s: appended(sessions.sessions(s, "user_id", "ts", f"{GAP_MIN} minutes", f"{DELAY_H} hours"), out))
    rows = spark.read.schema("user_id long, start timestamp, end timestamp, n long, total double").parquet(f"{out}/rows")
    return sessions.joined(rows, "user_id").select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n", F.round("total", 2).alias("total"))
