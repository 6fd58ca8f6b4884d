"""Payload bytes of a topic's schema: primitives in big-endian, records in Avro or JSON."""

from __future__ import annotations

import datetime as dt
import json
import struct
from collections.abc import Callable
from typing import Any

from pyspark.sql import types as T

from tidewater.functions import avro
from tidewater.functions.schemas import value_fields

#: Layouts of fixed-width primitives.
LAYOUT = {"INT8": ">b", "INT16": ">h", "INT32": ">i", "INT64": ">q", "FLOAT": ">f", "DOUBLE": ">d"}
DAY_MS = 86_400_000


def writer(schema: dict) -> Callable[[dict[str, Any]], bytes]:
    """From a row's value columns to its payload."""
    kind = schema["type"].upper()
    if kind == "AVRO":
        put = avro.encoder(schema["schema"])

        def record(row: dict[str, Any]) -> bytes:
            out = bytearray()
            put(row, out)
            return bytes(out)

        return record
    if kind == "JSON":
        return lambda row: json.dumps(row, default=str).encode()

    def one(row: dict[str, Any]) -> bytes:
        (v,) = row.values()
        if v is None:
            raise ValueError("null in a topic of primitive values")
        if kind in LAYOUT:
            return struct.pack(LAYOUT[kind], v)
        if kind == "BOOLEAN":
            return b"\x01" if v else b"\x00"
        if kind == "STRING":
            return v.encode("utf-8", "surrogatepass")
        if kind == "DATE":
            return struct.pack(">q", (v - avro.EPOCH_DAY).days * DAY_MS)
        if kind == "TIMESTAMP":
            return struct.pack(">q", avro.micros(v) // 1000)
        return bytes(v)

    return one


def _fits(v: Any, kind: T.DataType) -> Any:
    """A JSON value as one of ``kind``; raises ValueError if it isn't."""
    if v is None or v == "" and not isinstance(kind, (T.StringType, T.FloatType, T.DoubleType)):
        return None
    if isinstance(kind, T.StructType) and isinstance(v, dict):
        return {f.name: _fits(v.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType) and isinstance(v, list):
        return [_fits(x, kind.elementType) for x in v]
    if isinstance(kind, T.MapType) and isinstance(v, dict):
        return [(k, _fits(x, kind.valueType)) for k, x in v.items()]
    if isinstance(kind, T.StringType):
        return v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))
    if isinstance(kind, T.BooleanType) and isinstance(v, bool):
        return v
    if isinstance(kind, T.DateType) and isinstance(v, str):
        return dt.date.fromisoformat(v)
    if isinstance(kind, T.TimestampType):
        t = avro.EPOCH + dt.timedelta(seconds=v) if isinstance(v, (int, float)) else dt.datetime.fromisoformat(v)
        return t if t.tzinfo else t.replace(tzinfo=dt.UTC)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        if isinstance(v, (int, float)) and not isinstance(v, bool) or v in {"NaN", "Infinity", "-Infinity"}:
            return float(v)
    elif isinstance(kind, T.DecimalType) and isinstance(v, (int, float)) and not isinstance(v, bool):
        return avro.Decimal(str(v))
    elif isinstance(kind, T.IntegralType) and isinstance(v, int) and not isinstance(v, bool):
        return v
    elif isinstance(kind, T.BinaryType) and isinstance(v, str):
        import base64

        return base64.b64decode(v)
    raise ValueError(f"{v!r} isn't {kind.simpleString()}")


def reader(schema: dict | None) -> Callable[[bytes], dict[str, Any]]:
    """From a payload to a row's value columns.  A JSON record with a field that doesn't fit has nulls in all fields."""
    kind = (schema or {"type": "BYTES"})["type"].upper()
    fields = value_fields(schema)
    if kind == "AVRO":
        get = avro.decoder(schema["schema"])
        if _is_record(schema["schema"]):
            return lambda b: get(avro.Input(b))
        return lambda b: {"value": get(avro.Input(b))}
    if kind == "JSON":
        nulls = dict.fromkeys(fields.fieldNames())

        def record(b: bytes) -> dict[str, Any]:
            try:
                v = json.loads(b, parse_float=float)
                return _fits(v, fields) if isinstance(v, dict) else dict(nulls)
            except (ValueError, TypeError):
                return dict(nulls)

        return record
    if kind in LAYOUT:
        return lambda b: {"value": struct.unpack(LAYOUT[kind], b)[0]}
    one: dict[str, Callable[[bytes], Any]] = {
        "BOOLEAN": lambda b: b != b"\x00",
        "STRING": lambda b: b.decode("utf-8", "surrogatepass"),
        "DATE": lambda b: avro.EPOCH_DAY + dt.timedelta(days=struct.unpack(">q", b)[0] // DAY_MS),
        "TIMESTAMP": lambda b: avro.EPOCH + dt.timedelta(milliseconds=struct.unpack(">q", b)[0]),
    }
    get_one = one.get(kind, lambda b: b)
    return lambda b: {"value": get_one(b)}


def _is_record(schema: Any) -> bool:
    return isinstance(schema, dict) and (schema.get("type") == "record" or isinstance(schema.get("type"), dict) and _is_record(schema["type"]))
