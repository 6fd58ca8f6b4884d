"""Topics as folders: pruning, late topics, bounded batches, loss, and batches published once."""

import struct
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import schemas
from tidewater.functions.envelope import META_NAMES, ROOT
from tidewater.sources import parquet_log, topic_tables
from tidewater.streaming.replay import drained

NUMBER = T.StructType().add("n", "long")


def numbers(spark, topic, first, last):
    return spark.range(first, last).select(F.lit(topic).alias("__topic"), F.col("id").alias("n"))


def read_on(spark, tmp_path, **options):
    """The numbers that one more run of a stream over the topics has read, and its batches' row counts."""
    out = f"{tmp_path}/out"
    df = topic_tables.follow(spark, f"{tmp_path}/log", NUMBER, **options).select("n", F.col("__topic").alias("topic"))
    query = drained(df.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint"))
    rows = sorted(r.n for r in spark.read.schema("n long, topic string").parquet(f"{out}/rows").collect())
    return rows, [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_scan_has_the_metadata_columns_and_stable_ids(spark, tmp_path):
    df = numbers(spark, "a-partition-0", 0, 50).withColumns({"__key": F.col("n").cast("string"), "__eventTime": F.lit(0).cast("long"), "__messageProperties": F.create_map(F.lit("k"), F.lit(None).cast("string"))})
    topic_tables.publish(df, f"{tmp_path}/log")
    out = topic_tables.scan(spark, f"{tmp_path}/log")
    assert out.columns == ["n", *META_NAMES]
    rows = out.collect()
    assert len({bytes(r["__messageId"]) for r in rows}) == 50
    assert {(r.n, bytes(r["__messageId"])) for r in rows} == {(r.n, bytes(r["__messageId"])) for r in out.collect()}
    assert all(r["__topic"] == ROOT + "a-partition-0" and bytes(r["__key"]) == str(r.n).encode() and r["__eventTime"] is None and r["__messageProperties"] == {"k": None} and r["__publishTime"] for r in rows)


def test_chosen_topics_prune_folders(spark, tmp_path):
    path = f"{tmp_path}/log"
    for t in ("a", "b-partition-0", "b-partition-1", "bb", "c:d=e"):
        topic_tables.publish(numbers(spark, t, 0, 3), path)
    for choice, want in (({"topic": "b"}, 2), ({"topic": "bb"}, 1), ({"topics": "a, c:d=e"}, 2), ({"pattern": "b+"}, 3), ({}, 5)):
        df = topic_tables.scan(spark, path, NUMBER, **choice)
        assert df.count() == 3 * want
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert ("PartitionFilters: []" in plan) == (not choice)
        assert "PushedFilters: []" in plan
    assert read_on(spark, tmp_path, topics="c:d=e,b")[0] == sorted([0, 1, 2] * 3)


def test_a_hot_topic_is_split_and_most_small_ones_are_one_file(spark, tmp_path):
    path = f"{tmp_path}/log"
    topics = F.when(F.col("id") % 100 < 60, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 100).cast("string")))
    df = spark.range(0, 200_000, 1, 16).select(topics.alias("__topic"), F.md5(F.col("id").cast("string")).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        topic_tables.publish(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {r["t"]: r["n"] for r in spark.read.parquet(path).groupBy(F.col("__topic").alias("t")).agg(F.count_distinct("_metadata.file_name").alias("n")).collect()}
    # Without the rebalance each of 16 tasks would write a file for each of 41 topics; topics beside the hot one are split with it.
    assert files[ROOT + "hot"] >= 4 and sum(n <= 2 for n in files.values()) > 20
    assert topic_tables.scan(spark, path).count() == 200_000


def written_plan(spark):
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    return done.apply(done.size() - 1).physicalPlanDescription()


@pytest.mark.parametrize("n", [3, topic_tables.WRITERS + 9])
def test_topics_are_written_without_a_sort(spark, tmp_path, n):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, df = spark.conf.get(key), spark.range(6_000).select(F.concat(F.lit("t"), (F.col("id") % n).cast("string")).alias("__topic"), "id")
    topic_tables.publish(df, f"{tmp_path}/log")
    plan = written_plan(spark)
    assert "WriteFiles" in plan and "Sort" not in plan
    topic_tables.TopicSink(f"{tmp_path}/sink").store(df, 0)
    assert "Sort" not in written_plan(spark) and spark.conf.get(key) == before
    for path in (f"{tmp_path}/log", f"{tmp_path}/sink/rows"):
        got = spark.read.parquet(path).select("id", F.col("__topic").cast("string").alias("t"))
        assert got.filter(F.col("t") == F.concat(F.lit(f"{ROOT}t"), (F.col("id") % n).cast("string"))).distinct().count() == got.count() == 6_000


def test_stream_waits_for_its_topic_and_reads_new_partitions_from_their_start(spark, tmp_path):
    path = f"{tmp_path}/log"
    topic_tables.publish(numbers(spark, "other", 100, 105), path)
    assert read_on(spark, tmp_path, topic="a") == ([], [])
    topic_tables.publish(numbers(spark, "a-partition-0", 0, 5), path)
    assert read_on(spark, tmp_path, topic="a")[0] == [*range(5)]
    topic_tables.publish(numbers(spark, "a-partition-1", 5, 9), path)
    topic_tables.publish(numbers(spark, "ab-partition-0", 50, 59), path)
    topic_tables.publish(numbers(spark, "a-partition-0", 9, 10), path)
    assert read_on(spark, tmp_path, topic="a")[0] == [*range(10)]
    assert read_on(spark, tmp_path, topic="a") == ([*range(10)], [])


def test_batches_are_bounded_by_files_and_bytes(spark, tmp_path):
    path = f"{tmp_path}/log"
    for i in range(6):
        topic_tables.publish(numbers(spark, "a", 10 * i, 10 * i + 10), path)
        topic_tables.publish(numbers(spark, "b", 1000, 2000), path)
    rows, batches = read_on(spark, tmp_path, topic="a", max_files=2)
    assert rows == [*range(60)] and batches == [20, 20, 20]
    size = topic_tables.n_bytes(spark, path, topic="a")
    out = f"{tmp_path}/bytes"
    df = topic_tables.follow(spark, path, NUMBER, max_bytes=size // 2 + 6, topic="a")
    query = drained(df.writeStream.format("noop").option("checkpointLocation", out))
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [30, 30]


def test_files_that_go_are_skipped(spark, tmp_path):
    path, seen = f"{tmp_path}/log", []
    for i in range(2):
        topic_tables.publish(numbers(spark, f"a-partition-{i}", 10 * i, 10 * i + 10), path)

    def keep(rows, batch):
        seen.extend(r.n for r in rows.collect())
        for p in (tmp_path / "log").glob("__topic=*/*.parquet"):
            p.unlink()

    df = topic_tables.follow(spark, path, NUMBER, max_files=1, topic="a")
    drained(df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/checkpoint"))
    assert seen == [*range(10)]


def test_sink_checks_and_routes(spark, tmp_path):
    path = f"{tmp_path}/log"
    topic_tables.publish(numbers(spark, "ignored", 0, 3), path, topic="topic://main/other/t")
    assert {r["__topic"] for r in topic_tables.scan(spark, path).collect()} == {"topic://main/other/t"}
    with pytest.raises(ValueError, match="no __topic"):
        topic_tables.publish(spark.range(3), path)
    with pytest.raises(ValueError, match="value column"):
        topic_tables.publish(numbers(spark, "a", 0, 3).drop("n"), path)
    with pytest.raises(Exception, match="null topic"):
        topic_tables.publish(numbers(spark, None, 0, 3).withColumn("__topic", F.lit(None).cast("string")), path)
    assert topic_tables.scan(spark, path).count() == 3


def test_a_batch_is_published_once(spark, tmp_path):
    sink = topic_tables.TopicSink(f"{tmp_path}/log")
    sink(numbers(spark, "a", 0, 5), 0)
    sink.store(numbers(spark, "b", 5, 9), 1)
    assert sorted(r.n for r in sink.read(spark).collect()) == [*range(5)]
    sink(numbers(spark, "b", 5, 9), 1)
    sink(numbers(spark, "a", 0, 5), 0)
    out = sink.read(spark)
    assert out.columns == ["n", *META_NAMES]
    assert sorted(r.n for r in out.collect()) == [*range(9)]


def test_payloads_are_the_kinds_bytes_and_come_back(spark):
    cases = {
        "INT8": ("tinyint", ">b", [-128, -1, 0, 127]),
        "INT16": ("smallint", ">h", [-(2**15), -1, 0, 2**15 - 1]),
        "INT32": ("int", ">i", [-(2**31), -1, 0, 2**31 - 1]),
        "INT64": ("long", ">q", [-(2**63), -1, 0, 2**63 - 1]),
        "BOOLEAN": ("boolean", ">?", [True, False]),
    }
    for kind, (sql, fmt, vs) in cases.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate([*vs, None])], f"i int, v {sql}")
        df = df.select("i", "v", parquet_log.payload(F.col("v"), kind).alias("payload"))
        rows = sorted(parquet_log.values(df.withColumn("p", F.col("payload")), {"type": kind}).collect(), key=lambda r: r.i)
        assert [r.p and bytes(r.p) for r in rows] == [*[struct.pack(fmt, v) for v in vs], None]
        assert [r.value for r in rows] == [*vs, None]
    others = {"STRING": ("string", ["", "é€𝄞"]), "BYTES": ("binary", [b"", b"\x00\xff"]), "DATE": ("date", [date(1969, 12, 31), date(2024, 2, 29)]), "TIMESTAMP": ("timestamp", [datetime(1969, 12, 31, 23, 59, 59, 1000), datetime(2024, 2, 29, 1)])}
    for kind, (sql, vs) in others.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate([*vs, None])], f"i int, v {sql}")
        rows = parquet_log.values(df.select("i", "v", parquet_log.payload(F.col("v"), kind).alias("payload")), {"type": kind}).collect()
        assert all(r.v == r.value for r in rows) and len(rows) == 3
    with pytest.raises(schemas.IncompatibleSchemaError):
        parquet_log.payload(F.lit(1.0), "DOUBLE")
