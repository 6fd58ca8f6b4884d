import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators import loss, topics
from tidewater.sources.log_store import LogStore
from tidewater.sources.parquet_log import log_frame, values
from tidewater.sources.topic_log import TopicLog
from tidewater.streaming import queries as sq


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    spark.dataSource.register(TopicLog)


@pytest.fixture
def url(tmp_path):
    return str(tmp_path / "log")


def put(spark, url, numbers, topic="t", **producer):
    df = spark.createDataFrame([(int(n),) for n in numbers], "value int").coalesce(1)
    df.write.format("tidewater").options(**{"service.url": url, "topic": topic, **producer}).mode("append").save()


def get(spark, url, **o):
    return spark.read.format("tidewater").options(**{"service.url": url, "topic": "t", **o}).load()


class Running:
    """Add data, check, stop, start: a query into a Parquet folder."""

    def __init__(self, spark, url, where, **o):
        self.spark, self.url, self.where, self.o, self.query = spark, url, where, {"topic": "t", **o}, None

    def start(self):
        df = sq.stream(self.spark, **{"service.url": self.url, **self.o}).select((F.col("value") + 1).alias("v"))
        self.query = df.writeStream.format("parquet").option("path", f"{self.where}/rows").option("checkpointLocation", f"{self.where}/c").start()
        return self

    def settle(self):
        self.query.processAllAvailable()
        return self

    def stop(self):
        self.query.stop()
        return self

    def values(self):
        return sorted(r.v for r in self.spark.read.schema("v int").parquet(f"{self.where}/rows").collect())


def test_batch_bounds(spark, url):
    put(spark, url, range(10), **{"producer.batchsize": "2"})
    put(spark, url, range(10, 14), **{"producer.batchsize": "2"})
    values = lambda **o: sorted(r.value for r in get(spark, url, **o).collect())
    name = "topic://main/default/t"
    assert values() == list(range(14))
    assert values(startingOffsets=f'{{"{name}":[0,3,1]}}') == list(range(6, 14))
    assert values(startingOffsets=f'{{"{name}":[0,3]}}', endingOffsets=f'{{"{name}":[1,0]}}') == list(range(6, 12))
    assert values(startingOffsets=f'{{"{name}":[0,9]}}') == list(range(10, 14))
    assert values(startingOffsets=f'{{"{name}":[1,0]}}', endingOffsets=f'{{"{name}":[1,0]}}') == [10, 11]
    with pytest.raises(Exception, match="aren't read"):
        values(startingOffsets='{"other":[0,0]}')
    with pytest.raises(Exception, match="not allowed"):
        spark.range(1).selectExpr("cast(id as int) value").write.format("tidewater").options(**{"service.url": url, "topic": "t"}).mode("overwrite").save()


def test_times(spark, url):
    put(spark, url, [1, 2, 3])
    time.sleep(0.05)
    now = int(time.time() * 1000)
    time.sleep(0.05)
    put(spark, url, [4, 5])
    values = lambda **o: sorted(r.value for r in get(spark, url, **o).collect())
    assert values(startingTime=str(now)) == [4, 5]
    assert values(endingTime=str(now)) == [1, 2, 3, 4, 5]  # the first entry at or after the time is read
    assert values(startingTime='{"t":-1}') == [1, 2, 3, 4, 5]
    assert values(startingTime=str(now + 10**9)) == []


def test_schemas_and_metadata(spark, url):
    rows = spark.createDataFrame([(1, "a", 1000, {"p": "q"}), (2, None, -5, None)], "i int, s string, t long, m map<string,string>")
    rows.selectExpr("i", "s", "t as __eventTime", "m as __messageProperties", "s as __key").write.format("tidewater").options(**{"service.url": url, "topic": "t"}).mode("append").save()
    a, b = get(spark, url).orderBy("i").collect()
    assert a["__key"] == bytearray(b"a") and a["__messageProperties"] == {"p": "q"} and a["__eventTime"].timestamp() == 1
    assert b["__key"] is None and b["__eventTime"] is None and b["s"] is None
    put(spark, url, [1], topic="u")
    with pytest.raises(Exception, match="different schemas"):
        spark.read.format("tidewater").options(**{"service.url": url, "topics": "t,u"}).load().collect()
    both = spark.read.format("tidewater").options(**{"service.url": url, "topics": "t,u", "allowDifferentTopicSchemas": "true"}).load()
    assert both.count() == 3 and both.schema["value"].dataType.simpleString() == "binary"
    empty = spark.read.format("tidewater").options(**{"service.url": url, "topic": "nothing"}).load()
    assert empty.count() == 0 and empty.columns[0] == "value"


def test_pushed_topic_filter(spark, url):
    put(spark, url, [1, 2], topic="t-partition-0")
    put(spark, url, [3], topic="t-partition-1")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = get(spark, url, pushFilters="true").filter("__topic = 'topic://main/default/t-partition-1'")
        assert [r.value for r in df.collect()] == [3] and df.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_stream_latest_restart(spark, url, tmp_path):
    put(spark, url, [-1])
    q = Running(spark, url, tmp_path / "q", startingOffsets="latest").start().settle()
    put(spark, url, [1, 2, 3])
    q.settle()
    assert q.values() == [2, 3, 4]
    q.stop()
    put(spark, url, [4, 5, 6])
    q.start().settle()
    put(spark, url, [7, 8])
    q.settle().stop()
    assert q.values() == list(range(2, 10))


def test_stream_new_partition_and_admission(spark, url, tmp_path):
    put(spark, url, range(40), topic="t-partition-0", **{"producer.batchsize": "1"})
    q = Running(spark, url, tmp_path / "q", startingOffsets="earliest", maxBytesPerTrigger="40", **{"admin.url": "x"}).start()
    put(spark, url, range(100, 110), topic="t-partition-1")
    q.settle()
    sizes = [p.numInputRows for p in q.query.recentProgress if p.numInputRows]
    q.stop()
    assert q.values() == sorted([*range(1, 41), *range(101, 111)])
    assert max(sizes) <= 20 and len(sizes) >= 3


@pytest.mark.parametrize("fail", ["true", "false"])
def test_stream_topic_recreated(spark, url, tmp_path, fail):
    put(spark, url, [1, 2], **{"producer.batchsize": "1"})
    put(spark, url, [3], **{"producer.batchsize": "1"})
    q = Running(spark, url, tmp_path / "q", startingOffsets="earliest", failOnDataLoss=fail).start().settle().stop()
    LogStore(url).drop_topic("topic://main/default/t")
    put(spark, url, [6, 7, 8], **{"producer.batchsize": "1"})
    if fail == "true":
        with pytest.raises(Exception, match="Potential Data Loss"):
            q.start().settle()
    else:
        q.start()
        put(spark, url, [9])
        put(spark, url, [10])
        q.settle().stop()
        assert set(q.values()) >= {2, 3, 4, 11}


def test_stream_sink_and_metrics(spark, url, tmp_path):
    put(spark, url, [1, 2, 3])
    listener = sq.Metrics("m")
    spark.streams.addListener(listener)
    try:
        df = sq.measured(sq.stream(spark, **{"service.url": url, "topic": "t", "startingoffsets": "earliest"}), "m", F.lit(4))
        out = df.select((F.col("value") * 10).alias("value")).writeStream.format("tidewater").options(**{"service.url": url, "topic": "u"})
        sq.until_done(out.option("checkpointLocation", str(tmp_path / "c")).start())
        got = spark.read.format("tidewater").options(**{"service.url": url, "topic": "u"}).load()
        assert sorted(r.value for r in got.collect()) == [10, 20, 30]
        for _ in range(50):
            if listener.batches:
                break
            time.sleep(0.1)
        assert next(iter(listener.batches.values())) == {"numInputRows": 3, "numInputBytes": 12}
    finally:
        spark.streams.removeListener(listener)


def test_stream_window_and_update_counts(spark, url, tmp_path):
    put(spark, url, [1, 2, 2, 3, 3, 3])
    df = sq.stream(spark, **{"service.url": url, "topic": "t", "startingoffsets": "earliest"})
    q = sq.windowed_counts(df, "10 seconds", "5 seconds").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q2 = df.groupBy("value").count().writeStream.outputMode("update").format("memory").queryName("counts").start()
    for x in (q, q2):
        sq.until_done(x)
    assert sum(r.n for r in spark.table("windows").collect()) == 6
    assert {(r.value, r["count"]) for r in spark.table("counts").collect()} == {(1, 1), (2, 2), (3, 3)}


def test_native_scan(spark, url):
    put(spark, url, [5, -7, 2**31 - 1], topic="t-partition-0")
    put(spark, url, [9], topic="u")
    log = log_frame(spark, url)
    got = values(topics.select_topics(log, topic="t"), {"type": "INT32"})
    assert sorted(r.value for r in got.collect()) == [-7, 5, 2**31 - 1]
    one = log.filter("__topic = 'topic://main/default/u'").select("__key")
    assert "PartitionFilters: [isnotnull(__topic" in one._jdf.queryExecution().toString()
    assert loss.gaps(log).count() == 0
    same = {bytes(r["__messageId"]) for r in spark.read.format("tidewater").options(**{"service.url": url, "topics": "t,u"}).load().collect()}
    assert same == {bytes(r["__messageId"]) for r in log.collect()}


@pytest.mark.parametrize("kind,sql", [("BOOLEAN", "id % 2 = 0"), ("INT8", "cast(id - 3 as tinyint)"), ("INT16", "cast(id * -300 as smallint)"), ("INT64", "id * -1000000007"), ("STRING", "concat('é', id)"), ("DATE", "date_add(date'1969-12-30', cast(id as int))"), ("TIMESTAMP", "timestamp_millis(id * 1000 - 2500)")])
def test_primitives_both_ways(spark, url, kind, sql):
    df = spark.range(6).selectExpr(f"{sql} as value")
    df.write.format("tidewater").options(**{"service.url": url, "topic": "t"}).mode("append").save()
    want = sorted(str(r.value) for r in df.collect())
    assert sorted(str(r.value) for r in get(spark, url).collect()) == want
    assert sorted(str(r.value) for r in values(log_frame(spark, url), LogStore(url).schema("topic://main/default/t")).select("value").collect()) == want


def damaged(url, change):
    import pyarrow.parquet as pq

    led = LogStore(url).ledgers("topic://main/default/t")[0]
    pq.write_table(change(pq.read_table(led.path)), led.path)


@pytest.mark.parametrize("change", [lambda t: t.filter((t["entry"].to_numpy() < 3) | (t["entry"].to_numpy() > 4)), lambda t: t.slice(1), lambda t: t.slice(0, 8)])
def test_lost_messages_are_noticed(spark, url, tmp_path, change):
    put(spark, url, range(10), **{"producer.batchsize": "1"})
    damaged(url, lambda t: change(t).replace_schema_metadata(None))
    with pytest.raises(Exception, match="Potential Data Loss"):
        get(spark, url, failOnDataLoss="true").collect()
    assert 7 < get(spark, url).count() < 10
    q = Running(spark, url, tmp_path / "q", startingOffsets="earliest", failOnDataLoss="true")
    with pytest.raises(Exception, match="Potential Data Loss"):
        q.start().settle()


def test_longer_topic_made_again(spark, url, tmp_path):
    put(spark, url, [1, 2], **{"producer.batchsize": "1"})
    q = Running(spark, url, tmp_path / "q", startingOffsets="earliest", failOnDataLoss="true").start().settle().stop()
    LogStore(url).drop_topic("topic://main/default/t")
    for _ in range(3):
        put(spark, url, range(10, 20), **{"producer.batchsize": "1"})
    with pytest.raises(Exception, match="Potential Data Loss"):
        q.start().settle()
    q.o["failOnDataLoss"] = "false"
    q.start().settle().stop()
    assert q.values() == sorted([2, 3, *[*range(11, 21)] * 3])


def test_ledgers_of_bounded_size_are_read_apart(spark, url, monkeypatch):
    put(spark, url, range(100), **{"producer.batchsize": "2", "producer.entriesperledger": "5", "producer.compression": "zstd"})
    store, name = LogStore(url), "topic://main/default/t"
    led = store.ledgers(name)
    assert [x.entries for x in led] == [5] * 10
    parts = store.spread(name, (0, 1, -1), (8, 2, 0), n_bytes=2 * led[0].n_bytes)
    assert parts[0] == ((0, 1, -1), (1, 4, 0)) and parts[-1] == ((8, -1, -1), (8, 2, 0)) and len(parts) == 5
    got = [m for p in parts for _, _, _, b in store.read(name, *p) for m in b.column("entry").to_pylist()]
    assert len(got) == 2 * (3 + 7 * 5 + 3)
    assert sorted(r.value for r in get(spark, url).collect()) == list(range(100))


def test_two_writers_and_a_second_try(spark, url):
    """Both stage before either commits; a commit that is tried again appends nothing twice."""
    import datetime as dt

    import pyarrow as pa

    from tidewater.sources import log_store

    store, name = LogStore(url), "topic://main/default/t"
    row = {"entry": 0, "batch_index": 0, "batch_size": 1, "key": None, "publish_time": dt.datetime.now(dt.UTC), "event_time": None, "properties": None, "payload": b"x"}
    table = pa.Table.from_pylist([row], schema=log_store.SCHEMA)
    staged = {w: [store.stage(w, name, f"{k:06d}", table) for k in range(2)] for w in "ab"}
    store.commit("a", staged["a"][:1])
    LogStore(url).commit("b", staged["b"])
    store.commit("b", staged["b"])
    assert [x.number for x in store.ledgers(name)] == [0, 1, 2]


def test_cursor_and_waiting(spark, url, tmp_path):
    put(spark, url, [1])
    store = LogStore(url)
    q = Running(spark, url, tmp_path / "q", startingOffsets="earliest", predefinedSubscription="mine").start().settle()
    put(spark, url, [2])  # a batch is committed when the next one is planned
    q.settle().stop()
    assert store.cursor("mine") is not None
    with pytest.raises(Exception, match="came up"):
        spark.read.format("tidewater").options(**{"service.url": url, "topic": "never", "waitingForNonExistedTopic": "true", "pollTimeoutMs": "300"}).load().collect()
