"""Streams of Spark's own file source: state, restarts, limits and sinks."""

import datetime as dt
import random

import duckdb
import pyarrow.parquet as pq
import pytest
from comparing import duck, same
from pyspark.sql import functions as F

from tidewater.operators import loss
from tidewater.plans import stream_queries
from tidewater.streaming import joins, losses, sessions, sinks
from tidewater.streaming.replay import drained, feed, replayed

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


MESSAGES = "topic string, ledger long, entry long, batch_index long, batch_size long, minute long, slice int"


@pytest.fixture
def messages(spark):
    """Slices of a log in which some messages are lost, some are delivered again and some have no position."""
    rng, rows = random.Random(2), []
    for topic in ("a", "b", "c"):
        at_min = 0
        for ledger in range(3):
            for entry in range(12):
                for index in range(3):
                    at_min += 10
                    if rng.random() < 0.9:
                        row = (topic, ledger, entry, index, 3, at_min, min(at_min // 300, 3))
                        rows += [row] * (1 + (rng.random() < 0.1))
                        if rng.random() < 0.05:
                            rows.append((*row[:-1], min(row[-1] + 1, 3)))  # again, in a later slice
    rows += [("a", None, 1, 1, 3, 5, 1), (None, 0, 1, 1, 3, 5, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, MESSAGES).withColumnRenamed("topic", "__topic")
    return df.withColumn("__publishTime", F.timestamp_seconds(F.col("minute") * 60 + int(T0.timestamp()))).drop("minute")


def kept(spark, path, schema):
    return spark.read.schema(schema).parquet(path)


def test_gaps_over_batches_and_restarts(spark, messages, tmp_path):
    runs = []
    run = lambda df: runs.append(drained(losses.gaps(df.drop("slice"), "1 day", 10**10).writeStream.format("parquet").option("path", f"{tmp_path}/rows").option("checkpointLocation", f"{tmp_path}/check")))
    replayed(messages, F.col("slice"), 4, run)
    got = sorted(map(tuple, kept(spark, f"{tmp_path}/rows", losses.GAPS).collect()))
    want = loss.gaps(messages.filter("__topic is not null and ledger is not null").dropDuplicates(["__topic", "ledger", "entry", "batch_index"]))
    assert got == sorted(map(tuple, want.collect())) and len(got) > 10
    assert len(runs) == 4 and max(sessions.state_rows(runs[-1])) == 9  # a row a ledger


def test_state_of_ledgers_times_out(spark, messages, tmp_path):
    beat = spark.createDataFrame([("beat", 0, 0, 0, 1, 4, at(10**6))], messages.select("__topic", "ledger", "entry", "batch_index", "batch_size", "slice", "__publishTime").schema)
    rows = messages.unionByName(beat)
    runs = []
    run = lambda df: runs.append(drained(losses.gaps(df, "1 day", 60_000).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/check")))
    replayed(rows, F.col("slice"), 5, run)
    assert sessions.state_rows(runs[-1])[-1] == 1  # the beat's own


@pytest.mark.parametrize("fail", [False, True])
def test_policy_of_lost_messages(spark, messages, tmp_path, fail):
    run = lambda df: drained(losses.gaps(df, "1 day").writeStream.foreachBatch(losses.watched(f"{tmp_path}/gaps", fail)).option("checkpointLocation", f"{tmp_path}/check"))
    if fail:
        with pytest.raises(Exception, match="Potential Data Loss"):
            replayed(messages, F.lit(0), 1, run)
    else:
        with pytest.warns(RuntimeWarning, match="don't follow"):
            replayed(messages, F.lit(0), 1, run)
    assert spark.read.parquet(f"{tmp_path}/gaps/batch=0").count() > 10


def test_wrong_starts_in_update_mode(spark, messages, tmp_path):
    sink = sinks.OnceSink(f"{tmp_path}/starts")
    some = messages.filter("__topic is not null and ledger is not null")
    lost = some.filter("__topic <> 'b' or ledger > 0")
    replayed(lost, F.col("slice"), 4, lambda df: drained(losses.starts(df).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/check")))
    asked = some.groupBy("__topic").agg(F.min(F.struct("ledger", "entry", "batch_index")).alias("p")).select("__topic", "p.*")
    got = losses.wrong_starts(sink.read(spark).drop("stream", "batch"), asked).collect()
    assert [(r["__topic"], r["asked_ledger"], r["ledger"]) for r in got] == [("b", 0, 1)]


def test_interval_join_drops_state_and_reads_once(spark, tmp_path):
    rows = [(i, i % 5 if i % 50 else None, at(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, user long, ts timestamp")
    runs = []
    run = lambda s: runs.append(drained(joins.within(s, "user", "ts", "12 minutes", "5 minutes", ["id"]).writeStream.format("parquet").option("path", f"{tmp_path}/rows").option("checkpointLocation", f"{tmp_path}/check")))
    replayed(df, F.floor(F.col("id") / 150), 4, run)
    got = sorted((r.left_id, r.right_id) for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[1] is not None and a[1] == b[1] and a[0] < b[0] and (b[2] - a[2]).seconds <= 720)
    assert got == want and len(got) > 500
    for q in runs:
        assert len(q.lastProgress.sources) == 1
        assert max(sessions.state_rows(q)) <= 2 * 150 + 80  # not what came in earlier slices
        assert sessions.state_rows(q)[-1] < 80


def test_bounded_batches(spark, tmp_path):
    spark.range(2000).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).repartition(10).write.parquet(f"{tmp_path}/in")
    like = spark.read.parquet(f"{tmp_path}/in")
    sizes = sorted(p.stat().st_size for p in (tmp_path / "in").glob("*.parquet"))
    rows = [pq.read_metadata(p).num_rows for p in (tmp_path / "in").glob("*.parquet")]
    for k, (limits, most) in enumerate([({"maxFilesPerTrigger": "3"}, 3 * max(rows)), ({"maxBytesPerTrigger": str(2 * sizes[-1] + 1)}, 4 * max(rows))]):
        q = drained(feed(spark, f"{tmp_path}/in", like, **limits).writeStream.format("parquet").option("path", f"{tmp_path}/out{k}").option("checkpointLocation", f"{tmp_path}/check{k}"))
        batches = [p.numInputRows for p in q.recentProgress if p.numInputRows]
        assert len(batches) >= 3 and max(batches) <= most and sum(batches) == 2000
        assert spark.read.schema(like.schema).parquet(f"{tmp_path}/out{k}").distinct().count() == 2000


def test_once_sink(spark, tmp_path):
    sink, df = sinks.OnceSink(f"{tmp_path}/once"), spark.range(10)
    assert sink.log(spark).collect() == []
    sink(df, 0)
    sink(df, 0)  # logged already
    sink.store(df, 1)  # crashed before the log
    assert sink.read(spark).count() == 10
    sink(df.filter("id < 4"), 1)
    sink(df.filter("false"), 2)
    sinks.OnceSink(f"{tmp_path}/once", "other")(df, 0)
    got = sink.read(spark).groupBy("stream", "batch").count().collect()
    assert sorted(map(tuple, got)) == [("main", 0, 10), ("main", 1, 4), ("other", 0, 10)]


def test_foreach_writes_an_epoch_once(spark, tmp_path):
    writer, rows = sinks.OnceWriter(f"file://{tmp_path}/each"), [r for r in spark.range(5).withColumn("at", F.lit(at(0))).collect()]
    assert writer.open(0, 7)
    for r in rows[:3]:
        writer.process(r)
    writer.close(RuntimeError("lost"))
    assert not list((tmp_path / "each").glob("epoch=*/*"))
    assert writer.open(0, 7)
    for r in rows:
        writer.process(r)
    writer.close(None)
    assert not writer.open(0, 7)
    writer.close(None)
    assert spark.read.json(f"{tmp_path}/each/epoch=*").count() == 5


def test_sessions_and_late_messages(spark, tmp_path):
    rows = [(0, "a", 0, 0), (0, "a", 20, 0), (0, "a", 100, 0), (0, "b", 100, 0), (0, None, 90, 0), (1, "a", 125, 1), (1, "a", 1, 1), (1, "b", 80, 1), (2, "x", 9000, 2)]
    df = spark.createDataFrame(rows, "k int, user string, minute long, slice int").select("user", "slice", F.timestamp_seconds(F.col("minute") * 60 + int(T0.timestamp())).alias("ts"), F.lit(1.0).alias("value"))
    runs = []
    run = lambda s: runs.append(drained(sessions.sessions(s, "user", "ts", "30 minutes", "10 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/rows").option("checkpointLocation", f"{tmp_path}/check")))
    replayed(df, F.col("slice"), 3, run)
    got = sorted((r.user or "", int((r.start.replace(tzinfo=dt.UTC) - T0).seconds / 60), int((r.end.replace(tzinfo=dt.UTC) - T0).seconds / 60), r.n) for r in spark.read.parquet(f"{tmp_path}/rows").collect())
    # a's message at minute 1 is late (the watermark is 90); b's at 80 joins the session at 100.
    assert got == [("", 90, 120, 1), ("a", 0, 50, 2), ("a", 100, 155, 2), ("b", 80, 130, 2)]
    assert [sessions.dropped(q) for q in runs] == [0, 1, 0]


def test_sessions_that_a_message_in_time_reaches_back_to(spark, tmp_path):
    # The slice's newest message sets the watermark to minute 11460; the session at 11420 ends before it, the 50th event's own wouldn't.
    rows = [(1, 12900, 9), (2, 11420, 1), (50, 11440, 1), (3, 11400, 2), (100, 11435, 2), (150, 11429, 3), (4, 11390, 3), (200, 11450, None), (5, 11425, None), (6, 20000, 1)]
    made = ", ".join(f"({i}, {m}, {'NULL' if u is None else u})" for i, m, u in rows)
    duckdb.sql(f"""COPY (SELECT event_id::BIGINT AS event_id, TIMESTAMP '2024-01-01' + to_minutes(minute) AS ts, user_id::BIGINT AS user_id, 'view' AS event_type,
        event_id * 1.5::DOUBLE AS value, '{{}}' AS props FROM (VALUES {made}) v(event_id, minute, user_id)) TO '{tmp_path}/events.parquet'""")
    df = stream_queries.stream_sessions(spark, str(tmp_path))
    same(df, duck(tmp_path), stream_queries.ORACLE["stream_sessions"])
    assert sorted(r.n for r in df.collect() if r.user_id in (1, None)) == [1, 2, 2]


def test_replay_of_an_empty_table(spark, tmp_path):
    df = spark.range(3).filter("id > 5")
    replayed(df, F.lit(0), 2, lambda s: drained(s.writeStream.format("parquet").option("path", f"{tmp_path}/rows").option("checkpointLocation", f"{tmp_path}/check")))
    assert spark.read.schema(df.schema).parquet(f"{tmp_path}/rows").count() == 0
