"""Strict JSON, nested fields, reconciled records, the time index and range joins."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import json_records
from tidewater.functions.schemas import IncompatibleSchemaError
from tidewater.operators import offsets, range_join, reconcile, time_index
from tidewater.plans import log_queries, record_queries

BAD = object()


@pytest.mark.parametrize(
    ("kind", "cases"),
    [
        ("tinyint", {"127": 127, "128": BAD, '""': None, "true": BAD}),
        ("bigint", {"9223372036854775807": 2**63 - 1, "9223372036854775808": BAD, "1e3": BAD, '"7"': BAD, "null": None, "{}": BAD}),
        ("boolean", {"true": True, "1": BAD, '""': None, '"true"': BAD}),
        ("double", {"1": 1.0, "-2.5e3": -2500.0, '"Infinity"': float("inf"), '""': BAD, '"1"': BAD, "[]": BAD}),
        ("decimal(5,2)", {"1.555": Decimal("1.56"), "1e2": Decimal("100.00"), "1000": BAD, '"1.5"': BAD, '""': None}),
        ("string", {'"x"': "x", '{"a":[1]}': '{"a":[1]}', "true": "true", '""': ""}),
        ("binary", {'"aGk="': b"hi", '"%"': BAD, "1": BAD}),
        ("date", {'"2024-02-29"': dt.date(2024, 2, 29), '"1"': dt.date(1970, 1, 2), "1": BAD, '""': BAD, '"no"': BAD}),
        ("timestamp", {"60": dt.datetime(1970, 1, 1, 0, 1), "1.5": BAD, '""': BAD, '"no"': BAD}),
        ("struct<x: int, `y'z`: string>", {'{"x":1,"y\'z":"s","w":2}': (1, "s"), '{"X":1}': (None, None), '{"x":"a"}': BAD, '""': None, "[1]": BAD}),
        ("array<struct<x: int>>", {'[{"x":1},null,{}]': [(1,), None, (None,)], '[{"x":""}]': [(None,)], '[{"x":1.5}]': BAD, '""': None, "{}": BAD}),
        ("map<string, array<int>>", {'{"":[1],"b":null}': {"": [1], "b": None}, '{"b":["c"]}': BAD, '""': None}),
    ],
)
def test_values_of_json(spark, kind, cases):
    rows = spark.createDataFrame([(k, f'{{"v":{k},"w":1}}') for k in cases], "k string, payload string")
    schema = T.StructType([T.StructField("v", T._parse_datatype_string(kind)), T.StructField("w", T.LongType())])
    got = {r.k: BAD if r.d.malformed else r.d.record.v for r in rows.select("k", json_records.decode(F.col("payload"), schema).alias("d")).collect()}
    plain = lambda v: tuple(map(plain, v)) if isinstance(v, T.Row) else [plain(x) for x in v] if isinstance(v, list) else bytes(v) if isinstance(v, bytearray) else v
    assert {k: plain(v) for k, v in got.items()} == cases


def test_payloads_of_json(spark):
    bodies = [None, "", " \n", "[1]", "7", "null", "{", '{"v":1', "not json", '{"V":1}', "{}", '{"v":null}']
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string")
    got = {r.i: (r.d.record, r.d.malformed) for r in rows.select("i", json_records.decode(F.col("b").cast("binary"), T._parse_datatype_string("v int")).alias("d")).collect()}
    assert [got[i][1] for i in range(len(bodies))] == [False] * 3 + [True] * 6 + [False] * 3
    assert all(got[i][0] is None for i in range(9)) and all(got[i][0] == (None,) for i in (9, 10, 11))


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return log_queries.log(spark, sf_dir).select("__topic", "event_id", "ledger", "entry", "batch_index", "__publishTime").cache()


@pytest.mark.parametrize("shuffled", [False, True])
def test_time_index(spark, log, tmp_path, shuffled):
    if shuffled:  # publish times that don't ascend with positions
        log = log.withColumn("__publishTime", F.timestamp_micros(F.unix_micros("__publishTime") + F.pmod(F.xxhash64("event_id"), F.lit(5 * 86_400_000_000))))
    time_index.store(log, f"{tmp_path}/kept", 2)
    kept, ledgers = time_index.stored(spark, f"{tmp_path}/kept", log), time_index.index(spark, f"{tmp_path}/kept")
    assert kept.count() == log.count() and ledgers.count() == log.select("__topic", "ledger").distinct().count()
    for ms in (-1, -2, 1, log_queries.T0, log_queries.T1, 4_000_000_000_000):
        t = log_queries.times(log, F.lit(ms))
        want = sorted(map(tuple, offsets.at_time(log, t).collect()))
        assert sorted(map(tuple, time_index.at_time(kept, ledgers, t).collect())) == want
    start = offsets.at_time(log, log_queries.times(log, F.lit(log_queries.T1)))
    assert time_index.read(kept, ledgers, start).select("event_id").exceptAll(offsets.read(log, start).select("event_id")).isEmpty()
    assert time_index.read(kept, ledgers, start).count() == offsets.read(log, start).count()


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_time_index_prunes_the_scan(spark, log, tmp_path):
    time_index.store(log, f"{tmp_path}/kept", 1)
    kept, ledgers = time_index.stored(spark, f"{tmp_path}/kept", log), time_index.index(spark, f"{tmp_path}/kept")
    df = time_index.at_time(kept, ledgers, log_queries.times(ledgers, F.lit(log_queries.T1)))
    scan = [x for x in plan(df).split("PartitionFilters")[1:] if "dynamicpruning" in x.split("\n")[0]]
    assert scan, "the scan of the log isn't pruned by the index"


def test_range_join(spark):
    rng = random.Random(7)
    points = [(i, rng.choice("ab") if i % 9 else None, rng.choice([rng.randint(-50, 50), rng.randint(-10**6, 10**6), 7])) for i in range(300)] + [(300, "a", None)]
    ranges = []
    for j in range(80):
        lo = rng.randint(-60, 60) if j % 4 else rng.randint(-10**6, 10**6)
        ranges.append((j, rng.choice("ab"), lo, lo + rng.choice([0, 0, 1, 5, 30, 10**5, -3])))
    ranges += [(80, None, 0, 9), (81, "a", None, 9), (82, "a", -(2**62), 2**62), (83, "b", 7, 7), (83, "b", 7, 7)]
    p = spark.createDataFrame(points, "pid int, k string, at long").repartition(5)
    r = spark.createDataFrame(ranges, "rid int, k string, lo long, hi long").repartition(3)
    want = sorted((a, j) for a, k, x in points for j, q, lo, hi in ranges if k is not None and k == q and None not in (x, lo, hi) and lo <= x <= hi)
    for hot in (3, 10**6):
        df = range_join.points_in(p, r, "k", "at", "lo", "hi", hot)
        assert sorted((x.pid, x.rid) for x in df.collect()) == want
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    assert range_join.points_in(p.filter("false"), r, "k", "at", "lo", "hi").count() == range_join.points_in(p, r.filter("false"), "k", "at", "lo", "hi").count() == 0


def test_overlapping_ranges(spark):
    rng = random.Random(8)
    made = lambda n: [(i, rng.choice("ab"), lo, lo + rng.choice([0, 1, 3, 40, -2])) for i in range(n) for lo in (rng.randint(0, 90),)]
    a, b = made(70), made(70)
    df = range_join.overlapping(spark.createDataFrame(a, "i int, k string, lo long, hi long"), spark.createDataFrame(b, "j int, k string, lo2 long, hi2 long"), "k", "lo", "hi", "lo2", "hi2")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted((r.i, r.j) for r in df.collect()) == want and len(want) > 100


def parsed(x):
    return T._parse_datatype_string(x)


def test_reconciled_records(spark):
    a = spark.sql("select 1 as id, named_struct('x', 2S, 'old', 'z') as s, array(1, null) as xs, map('k', 1.5F) as m, 'text' as b")
    b = spark.sql("select 5000000000L as id, named_struct('x', 7L, 'y', true) as s, array(6L) as xs, map('k', 2.5D) as m, X'00' as b, 9 as more")
    out = reconcile.union(a, b)
    assert [f.dataType.simpleString() for f in out.schema.fields][:4] == ["bigint", "struct<x:bigint,old:string,y:boolean>", "array<bigint>", "map<string,double>"]
    got = sorted(out.collect(), key=lambda r: r.id)
    assert got[0].s == (2, "z", None) and got[0].xs == [1, None] and got[0].m == {"k": 1.5} and got[0].more is None and bytes(got[0].b) == b"text"
    assert got[1].s == (7, None, True) and got[1].more == 9
    with pytest.raises(IncompatibleSchemaError, match="s.w is missing"):
        reconcile.conform(a, parsed("id long, s struct<w: int not null>"))
    with pytest.raises(IncompatibleSchemaError, match="can't become"):
        reconcile.conform(b, parsed("id int"))
    with pytest.raises(IncompatibleSchemaError):
        reconcile.union(a, spark.sql("select true as id"))
    with pytest.raises(Exception, match="is null, but mustn't be"):
        reconcile.conform(a, T.StructType([T.StructField("xs", T.ArrayType(T.LongType(), False))])).collect()
    assert reconcile.conform(b, parsed("more long, gone string")).collect() == [(9, None)]


def test_nested_fields_prune_the_scan(spark, sf_dir, tmp_path):
    events = log_queries.events(spark, sf_dir)
    record_queries.nested(events).write.parquet(f"{tmp_path}/nested")
    df = record_queries.nested_used(spark.read.schema(record_queries.NESTED).parquet(f"{tmp_path}/nested"))
    (schema,) = [x.split("\n")[0] for x in plan(df).split("ReadSchema: ")[1:]]
    assert "d:double" in schema and "arr:array<struct<b:boolean>>" in schema and "f:float" not in schema and "rest" not in schema
