import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidewater.functions import avro, payloads, schemas
from tidewater.operators import loss, offsets, sink
from tidewater.sources import options


def roundtrip(schema, value):
    avro.encoder(schema)(value, out := bytearray())
    return avro.decoder(schema)(avro.Input(bytes(out)))


@settings(max_examples=200, deadline=None)
@given(st.integers(-(2**63), 2**63 - 1))
def test_avro_long(n):
    assert roundtrip("long", n) == n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=20))), st.dictionaries(st.text(max_size=5), st.integers(-9, 9)), st.decimals(-(10**8), 10**8, places=2))
def test_avro_nested(strings, numbers, price):
    kind = T.StructType([T.StructField("a", T.ArrayType(T.StringType(), True)), T.StructField("m", T.MapType(T.StringType(), T.IntegerType(), False)), T.StructField("d", T.DecimalType(12, 2))])
    got = roundtrip(schemas.to_avro(kind), {"a": strings, "m": numbers, "d": price})
    assert got["a"] == strings and dict(got["m"]) == numbers and got["d"] == Decimal(price)


def test_avro_times_and_unions():
    now = dt.datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=dt.UTC)
    assert roundtrip({"type": "long", "logicalType": "timestamp-micros"}, now) == now
    assert roundtrip({"type": "int", "logicalType": "date"}, dt.date(1969, 12, 31)) == dt.date(1969, 12, 31)
    assert roundtrip(["string", "null"], None) is None
    union = ["null", "int", {"type": "array", "items": "long"}]
    assert roundtrip(union, {"member0": None, "member1": [1, 2]}) == {"member0": None, "member1": [1, 2]}
    with pytest.raises(ValueError):
        roundtrip("string", None)
    with pytest.raises(schemas.IncompatibleSchemaError):
        roundtrip({"type": "enum", "name": "e", "symbols": ["A"]}, "B")


def test_avro_to_spark():
    nullable = {"type": "record", "name": "User", "fields": [{"name": f"f{i}", "type": ["string", "null"]} for i in range(25)]}
    kind, _ = schemas.from_avro(nullable)
    assert all(f.dataType == T.StringType() and f.nullable for f in kind.fields) and len(kind.fields) == 25
    assert schemas.from_avro(["int", "long"])[0] == T.LongType()
    assert schemas.from_avro(["null", "float", "double"]) == (T.DoubleType(), True)
    assert schemas.from_avro(["int", "string"])[0].fieldNames() == ["member0", "member1"]
    with pytest.raises(schemas.IncompatibleSchemaError):
        schemas.from_avro({"type": "record", "name": "r", "fields": [{"name": "next", "type": ["null", "r"]}]})
    with pytest.raises(schemas.IncompatibleSchemaError):
        schemas.from_avro("null")


@pytest.mark.parametrize("precision,size", [(1, 1), (2, 1), (3, 2), (9, 4), (10, 5), (18, 8), (19, 9), (38, 16)])
def test_decimal_bytes(precision, size):
    assert schemas.bytes_for(precision) == size


@pytest.mark.parametrize(
    "kind,values",
    [("BOOLEAN", [True, False]), ("INT8", [1, -5]), ("INT16", [300]), ("INT32", [1, 2**31 - 1]), ("INT64", [2**62]), ("DOUBLE", [1.5]), ("STRING", ["1", "é"]), ("BYTES", [b"1"]), ("DATE", [dt.date(2019, 1, 1)]), ("TIMESTAMP", [dt.datetime(2019, 1, 1, 20, 35, 40, tzinfo=dt.UTC)])],
)
def test_primitive_payloads(kind, values):
    put, get = payloads.writer({"type": kind}), payloads.reader({"type": kind})
    for v in values:
        assert get(put({"value": v})) == {"value": v}


def test_json_payloads():
    record = {"type": "record", "name": "r", "fields": [{"name": "i", "type": ["int", "null"]}, {"name": "f", "type": ["double", "null"]}, {"name": "s", "type": ["string", "null"]}]}
    get = payloads.reader({"type": "JSON", "schema": record})
    assert get(b'{"i":1,"f":"NaN","s":{"x":1},"other":2}')["s"] == '{"x":1}'
    assert get(b'{"i":"","s":"e"}') == {"i": None, "f": None, "s": "e"}
    assert get(b'{"i":"no","s":"e"}') == {"i": None, "f": None, "s": None}
    assert get(b"[1]") == get(b"not json") == {"i": None, "f": None, "s": None}
    assert get(b'{"I":7,"i":1,"i":2}')["i"] == 2


def test_topic_schemas():
    one = lambda t: T.StructType([T.StructField("value", t)])
    assert schemas.topic_schema(one(T.LongType())) == {"type": "INT64"}
    for bad in (T.DecimalType(5, 2), T.ArrayType(T.LongType()), T.MapType(T.StringType(), T.LongType())):
        with pytest.raises(schemas.IncompatibleSchemaError):
            schemas.topic_schema(one(bad))
    assert schemas.topic_schema(one(T.StructType([T.StructField("x", T.LongType())])))["type"] == "AVRO"
    assert schemas.common_schema([{"type": "INT64"}, {"type": "STRING"}], True) is None
    with pytest.raises(ValueError, match="allowDifferentTopicSchemas to 'true'"):
        schemas.common_schema([{"type": "INT64"}, {"type": "STRING"}], False)
    with pytest.raises(schemas.IncompatibleSchemaError):
        schemas.value_fields({"type": "TIME"})


def test_offsets_json():
    given = {f"topic-{i}": (10 + i, 100 + i, i) for i in range(10)}
    assert offsets.from_json(offsets.to_json(given)) == given
    assert offsets.from_json('{"a":[1,2]}') == {"a": (1, 2, 0)}
    assert offsets.times_from_json('{"a":5}') == {"a": 5}
    for bad in ("[]", "x", '{"a":[1]}', '{"a":"b"}'):
        with pytest.raises(ValueError):
            offsets.from_json(bad)


BASE = {"service.url": "/x", "topic": "t"}


@pytest.mark.parametrize(
    "change,streaming,words",
    [
        ({"service.url": None}, False, "service.url is missing"),
        ({"topics": "a,b"}, False, "exactly one of topic, topics, topicspattern"),
        ({"topic": None}, True, "exactly one of"),
        ({"topic": "a,b"}, False, "topics takes a list"),
        ({"topic": " "}, False, "topic is empty"),
        ({"topic": None, "topics": " , "}, False, "list of topics is empty"),
        ({"topic": None, "topicsPattern": " "}, False, "topicspattern is empty"),
        ({"startingOffsets": "latest"}, False, "can't start at latest"),
        ({"endingOffsets": "EARLIEST"}, False, "can't end at earliest"),
        ({"endingOffsets": "latest"}, True, "a stream has no end"),
        ({"startingOffsets": "earliest", "startingTime": "5"}, True, "exclude each other"),
        ({"startingTime": "soon"}, True, "no whole number"),
        ({"maxBytesPerTrigger": "9"}, True, "needs admin.url"),
        ({"reader.nonsense": "1"}, True, "reader.nonsense is no option"),
    ],
)
def test_bad_read_options(change, streaming, words):
    with pytest.raises(ValueError, match=words):
        options.read_options({k: v for k, v in (BASE | change).items() if v is not None}, streaming)


def test_good_options():
    o = options.read_options(BASE, True)
    assert (o.start.kind, o.end.kind, o.fail_on_data_loss, o.max_bytes, o.poll_timeout_ms) == ("latest", "latest", False, 0, 120_000)
    o = options.read_options(BASE | {"startingTime": '{"t": 5}', "failOnDataLoss": "TRUE", "client.authParams": "x"}, False)
    assert o.start == options.Where("times", {"t": 5}) and o.fail_on_data_loss and o.passed["client"] == {"authparams": "x"}
    assert options.masked({"client.authParams": "abcdefghi", "admin.authparams": "abc", "topic": "t"}) == {"client.authParams": "abc...", "admin.authparams": "...", "topic": "t"}
    with pytest.raises(ValueError, match="a sink takes topic"):
        options.sink_options({"service.url": "x", "topics": "a"})


def test_sink_checks():
    f = lambda *pairs: T.StructType([T.StructField(n, t) for n, t in pairs])
    assert sink.check(f(("__topic", T.StringType()), ("v", T.LongType())), None) == ["v"]
    for bad in (f(("v", T.LongType())), f(("__topic", T.LongType()), ("v", T.LongType())), f(("__topic", T.StringType())), f(("__topic", T.StringType()), ("__key", T.LongType()), ("v", T.LongType()))):
        with pytest.raises(ValueError):
            sink.check(bad, None)
    with pytest.raises(ValueError, match="map<string,string>"):
        sink.check(f(("__messageProperties", T.MapType(T.StringType(), T.LongType())), ("v", T.LongType())), "t")
    with pytest.warns(RuntimeWarning, match="__messageId"):
        sink.check(f(("__messageId", T.BinaryType()), ("v", T.LongType())), "t")


def test_loss_policy():
    with pytest.raises(loss.DataLossError, match="Potential Data Loss"):
        loss.report("x", True)
    with pytest.warns(RuntimeWarning):
        loss.report("x", False)


def test_a_schema_that_differs_is_told_by_its_fields():
    mine, read = T.StructType().add("a", T.IntegerType()).add("b", T.StringType()), T.StructType().add("a", T.LongType(), False).add("b", T.StringType())
    with pytest.raises(ValueError, match="given has a int where the topics read as a bigint not null"):
        schemas.check_same(mine, read)
    schemas.check_same(read, T.StructType(read.fields))
    with pytest.raises(ValueError, match="no other field where the topics read as no other field"):
        schemas.check_same(T.StructType(read.fields[::-1]), read)
