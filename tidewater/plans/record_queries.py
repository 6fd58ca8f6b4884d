"""Queries over records in messages: strict JSON, nested fields, records of several schemas; a time index and ranges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import json_records
from tidewater.functions.envelope import partition_of
from tidewater.operators import range_join, reconcile, time_index
from tidewater.plans import log_queries
from tidewater.sources.places import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


#: Payloads by the rest of the event's id, and what they decode to, in words that Spark's SQL and DuckDB's share.
#: {e} is the id, {v} the value in hundredths as a whole number.
CASES: list[tuple[str, dict[str, str]]] = [
    ('{"i":{e},"f":{v},"m":{v},"s":"x","other":1}', {"i": "{e}", "f": "CAST({v} AS VARCHAR)", "m": "100 * {v}", "s": "'x'"}),
    ('{"i":{e}.0}', {"malformed": "true"}),
    ('{"i":"{e}","s":"lost"}', {"malformed": "true"}),
    ('{"i":"","m":"","o":"","a":"","s":""}', {"s": "''"}),
    ('{"f":""}', {"malformed": "true"}),
    ('{"f":"NaN","i":{e}}', {"f": "'NaN'", "i": "{e}"}),
    ('{"f":"Infinity"}', {"f": "'Infinity'"}),
    ('{"f":"-Infinity"}', {"f": "'-Infinity'"}),
    ('{"m":"1.5","i":{e}}', {"malformed": "true"}),
    ('{"m":{e}.125}', {"m": "100 * {e} + 13"}),
    ('{"m":12345678901}', {"malformed": "true"}),
    ('{"t":{e}}', {"t": "1000000 * {e}"}),
    ('{"t":"2024-01-02T03:04:05Z"}', {"t": "1704164645000000"}),
    ('{"t":""}', {"malformed": "true"}),
    ('{"d":"2024-01-02"}', {"d": "19724"}),
    ('{"d":"{e}"}', {"d": "{e}"}),
    ('{"d":{e}}', {"malformed": "true"}),
    ('{"s":{"x":{e}},"I":7}', {"s": "'{\"x\":' || CAST({e} AS VARCHAR) || '}'"}),
    ('{"s":[1,true]}', {"s": "'[1,true]'"}),
    ('{"o":{"x":{e}},"a":[{e},null]}', {"x": "{e}", "a": "{e}"}),
    ('{"o":{"x":"no"},"i":{e}}', {"malformed": "true"}),
    ('{"a":[1,{}]}', {"malformed": "true"}),
    ('{"i":1,"i":{e}}', {"i": "{e}"}),
    ('[{"i":{e}}]', {"malformed": "true"}),
    ('{"i":{e}', {"malformed": "true"}),
    ("", {}),
]
NULLS = {"i": "CAST(NULL AS BIGINT)", "f": "CAST(NULL AS VARCHAR)", "m": "CAST(NULL AS BIGINT)", "t": "CAST(NULL AS BIGINT)", "d": "CAST(NULL AS BIGINT)", "s": "CAST(NULL AS VARCHAR)", "x": "CAST(NULL AS BIGINT)", "a": "CAST(NULL AS BIGINT)", "malformed": "false"}
SCHEMA = "i int, f double, m decimal(10,2), t timestamp, d date, s string, o struct<x: bigint>, a array<int>"


def _expected(column: str) -> str:
    by_rest = " ".join(f"WHEN {k} THEN {want[column].replace('{e}', 'event_id').replace('{v}', 'v')}" for k, (_, want) in enumerate(CASES) if column in want)
    return f"CASE event_id % {len(CASES)} {by_rest} ELSE {NULLS[column]} END AS {column}"


@query(f"SELECT event_id, {', '.join(map(_expected, NULLS))} FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS v FROM events)")
def json_strict(spark, sf_dir):
    """Payloads of every rule, made of the events, decoded strictly: records whole or null."""
    json_records.last_of_names(spark)
    text = F.lit("")
    for k, (payload, _) in enumerate(CASES):
        made = F.replace(F.replace(F.lit(payload), F.lit("{e}"), F.col("event_id").cast("string")), F.lit("{v}"), F.floor(F.col("value") * 100).cast("string"))
        text = F.when(F.col("event_id") % len(CASES) == k, made).otherwise(text)
    df = log_queries.events(spark, sf_dir).select("event_id", text.cast("binary").alias("payload"))
    df = df.select("event_id", json_records.decode(F.col("payload"), T._parse_datatype_string(SCHEMA)).alias("p")).select("event_id", "p.record.*", "p.malformed")
    whole = F.when(F.col("f").isin(float("inf"), float("-inf")) | F.isnan("f"), F.col("f").cast("string")).otherwise(F.col("f").cast("long").cast("string"))
    return df.select("event_id", F.col("i").cast("long").alias("i"), whole.alias("f"), (F.col("m") * 100).cast("long").alias("m"), F.unix_micros("t").alias("t"), F.unix_date("d").cast("long").alias("d"), "s", F.col("o.x").alias("x"), F.col("a")[0].cast("long").alias("a"), "malformed")


@query(log_queries.ORACLE["range_by_time"])
def range_by_time_index(spark, sf_dir):
    """Messages from a time on: the time is resolved by the index of a stored log, and only later spans of ledgers are read."""
    path, log = shared_folder(spark, "indexed-log"), log_queries.log(spark, sf_dir).select("__topic", "event_id", "ledger", "entry", "batch_index", "__publishTime")
    time_index.store(log, path)
    kept, ledgers = time_index.stored(spark, path, log), time_index.index(spark, path)
    start = time_index.at_time(kept, ledgers, log_queries.times(ledgers, F.lit(log_queries.T0)))
    return log_queries.ids(time_index.read(kept, ledgers, start))


_OPEN = "SELECT topic, user_id % 4 AS part, ledger, min(publish_us) AS lo, max(publish_us) AS hi FROM log GROUP BY ALL"


@query(log_queries.LOG + f", opened AS ({_OPEN}) SELECT e.event_id, o.topic, o.ledger FROM log e JOIN opened o ON o.part = e.user_id % 4 AND e.publish_us BETWEEN o.lo AND o.hi")
def range_join_ledgers(spark, sf_dir):
    """For each event, the ledgers of its partition number, of all topics, that were being written when it was published."""
    log = log_queries.log(spark, sf_dir).withColumn("us", F.unix_micros("__publishTime"))
    ledgers = log.groupBy(F.col("__topic").alias("topic"), "ledger").agg(F.min("us").alias("lo"), F.max("us").alias("hi")).withColumn("part", partition_of(F.col("topic")).cast("long"))
    points = log.select("event_id", "us", F.pmod("user_id", F.lit(4)).alias("part"))
    return range_join.points_in(points, ledgers, "part", "us", "lo", "hi", 1000).select("event_id", "topic", "ledger")


@query(log_queries.LOG + f", opened AS ({_OPEN}) SELECT a.topic AS topic, a.ledger AS ledger, count(*) AS n, min(b.topic) AS first_topic FROM opened a JOIN opened b ON a.part = b.part AND a.lo <= b.hi AND b.lo <= a.hi AND a.topic <> b.topic GROUP BY ALL")
def range_join_overlaps(spark, sf_dir):
    """For each ledger, how many ledgers of other topics with its partition number were written at a time with it."""
    log = log_queries.log(spark, sf_dir).withColumn("us", F.unix_micros("__publishTime"))
    ledgers = log.groupBy(F.col("__topic").alias("topic"), "ledger").agg(F.min("us").alias("lo"), F.max("us").alias("hi")).withColumn("part", partition_of(F.col("topic")).cast("long"))
    other = ledgers.select("part", F.col("topic").alias("topic2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    met = range_join.overlapping(ledgers, other, "part", "lo", "hi", "lo2", "hi2").filter("topic <> topic2")
    return met.groupBy("topic", "ledger").agg(F.count("*").alias("n"), F.min("topic2").alias("first_topic"))


NESTED = "event_id long, baz struct<f: float, d: double, mp: map<string, struct<b: boolean, s: string>>, arr: array<struct<b: boolean, s: string>>>, rest string"


def nested(events: DataFrame) -> DataFrame:
    """Events as nested records, with not-a-number, infinities, nulls and empty map keys in them."""
    e, v = F.col("event_id"), F.col("value")
    special = lambda kind: F.when(e % 7 == 0, float("nan")).when(e % 7 == 1, float("-inf")).when(e % 7 == 2, float("inf")).otherwise(v).cast(kind)
    bar = lambda flag, text: F.struct(flag.alias("b"), text.alias("s"))
    keys = F.when(e % 5 == 0, F.array(F.lit(""))).otherwise(F.array(F.lit("1"), F.lit("2")))
    mp = F.when(e % 3 != 0, F.map_from_arrays(keys, F.transform(keys, lambda k: bar(k == "1", F.concat(k, F.lit(":"), "event_type")))))
    arr = F.when(e % 4 != 0, F.array(bar(e % 2 == 0, F.col("event_type")), F.when(e % 4 == 1, bar(F.lit(None).cast("boolean"), F.col("props")))))
    baz = F.when(e % 11 != 0, F.struct(special("float").alias("f"), special("double").alias("d"), mp.alias("mp"), arr.alias("arr")))
    return events.select(e.alias("event_id"), baz.alias("baz"), F.repeat("props", 5).alias("rest"))


@query(
    """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'NaN' WHEN event_id % 7 = 1 THEN '-Infinity' WHEN event_id % 7 = 2 THEN 'Infinity' ELSE 'finite' END AS kind,
    CASE WHEN event_id % 11 <> 0 AND event_id % 7 > 2 THEN value END AS d,
    CASE WHEN event_id % 11 <> 0 AND event_id % 3 <> 0 AND event_id % 5 = 0 THEN ':' || event_type END AS empty_key,
    CASE WHEN event_id % 11 <> 0 AND event_id % 3 <> 0 AND event_id % 5 <> 0 THEN true END AS one,
    CASE WHEN event_id % 11 <> 0 AND event_id % 3 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN 'false' ELSE 'true,false' END END AS flags,
    CASE WHEN event_id % 11 <> 0 AND event_id % 4 <> 0 THEN event_id % 2 = 0 END AS first_b FROM events"""
)
def nested_fields(spark, sf_dir):
    """Fields of structs, of map values and of array elements; the scan reads these fields only."""
    path = shared_folder(spark, "nested")
    nested(log_queries.events(spark, sf_dir)).write.parquet(path)
    return nested_used(spark.read.schema(NESTED).parquet(path))


def nested_used(df: DataFrame) -> DataFrame:
    d = F.col("baz.d")
    special = d.isin(float("inf"), float("-inf")) | F.isnan(d)
    first_b = F.try_element_at(F.col("baz.arr.b"), F.lit(1))
    of = lambda key, name: F.try_element_at(F.map_values("baz.mp")[name], F.array_position(F.map_keys("baz.mp"), key).cast("int"))
    some = lambda key: F.array_contains(F.map_keys("baz.mp"), key)
    flags = F.array_join(F.transform(F.map_values("baz.mp")["b"], lambda b: b.cast("string")), ",")
    return df.select(
        "event_id",
        F.when(special, d.cast("string")).when(d.isNotNull(), "finite").alias("kind"),
        F.when(~special, d).alias("d"),
        F.when(some(""), of("", "s")).alias("empty_key"),
        F.when(some("1"), of("1", "b")).alias("one"),
        flags.alias("flags"),
        first_b.alias("first_b"),
    )


#: A record as it has become: fields added, widened and made optional, at any depth.
VERSIONS = [
    "event_id int, user struct<id: int>, tags array<int>",
    "event_id bigint, user struct<id: bigint, kind: string>, tags array<bigint>, amount float",
    "event_id bigint, user struct<id: bigint, kind: string, seen: map<string, int>>, amount double, gone string",
]
WANT = "event_id bigint not null, user struct<id: bigint not null, kind: string, seen: map<string, bigint>> not null, tags array<bigint>, amount double"


def version(events: DataFrame, n: int) -> DataFrame:
    """Events as records of one of VERSIONS."""
    user = {"id": F.col("user_id"), "kind": F.col("event_type"), "seen": F.create_map("event_type", F.col("user_id"))}
    fields = {"event_id": F.col("event_id"), "tags": F.array(F.col("user_id"), F.col("event_id")), "amount": F.floor("value"), "gone": F.col("props")}
    schema = T._parse_datatype_string(VERSIONS[n])
    fields["user"] = F.struct(*[user[x].alias(x) for x in schema["user"].dataType.fieldNames()])
    return events.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


@query(
    """SELECT event_id, user_id AS id, CASE WHEN event_id % 3 > 0 THEN event_type END AS kind, CASE WHEN event_id % 3 = 2 THEN user_id END AS seen,
    CASE WHEN event_id % 3 < 2 THEN user_id + event_id END AS tags, CASE WHEN event_id % 3 > 0 THEN CAST(floor(value) AS DOUBLE) END AS amount FROM events"""
)
def reconciled_records(spark, sf_dir):
    """One table of three versions of a record, by the names of their fields."""
    df = log_queries.events(spark, sf_dir)
    parts = [version(df.filter(F.col("event_id") % 3 == n), n) for n in range(3)]
    out = reconcile.union(*parts, want=T._parse_datatype_string(WANT))
    seen = F.try_element_at("user.seen", F.col("user.kind"))
    return out.select("event_id", "user.id", "user.kind", seen.alias("seen"), F.aggregate("tags", F.lit(0).cast("long"), lambda a, x: a + x).alias("tags"), "amount")
