"""The stored topic log as a DataFrame of Spark's own Parquet reader.

For batch work on whole logs: predicates on ``__topic`` prune folders, those on positions' entries and publish times reach
the scan, only columns in use are read, and everything stays on the JVM.  The operators of :mod:`tidewater.operators`
work on the result.  Payloads of primitive and JSON topics are decoded by :func:`values`; Avro ones need the data source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import json_records, schemas
from tidewater.functions.envelope import META_NAMES, POSITION, event_time, message_id

STORED = "entry long, batch_index long, batch_size long, key binary, publish_time timestamp, event_time timestamp, properties map<string,string>, payload binary, __topic string"

#: Bytes of the whole numbers.
WIDTHS = {"INT8": 1, "INT16": 2, "INT32": 4, "INT64": 8}


def log_frame(spark: SparkSession, url: str) -> DataFrame:
    """Every message of the log: metadata columns, position, batch_size, n_bytes and payload."""
    df = spark.read.schema(STORED).parquet(f"{url.rstrip('/')}/topics")
    df = df.withColumn("ledger", F.regexp_extract(F.col("_metadata.file_name"), r"L(\d+)-", 1).cast("long"))
    df = df.withColumns({"__key": F.col("key"), "__messageId": message_id(F.col("__topic")), "__publishTime": F.col("publish_time"), "__eventTime": event_time(F.col("event_time")), "__messageProperties": F.col("properties")})
    df = df.withColumn("n_bytes", (F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("payload"), F.lit(0))).cast("long"))
    return df.select(*META_NAMES, *POSITION, "batch_size", "n_bytes", "payload")


def _whole(payload: Column, n: int) -> Column:
    """A big-endian two's complement number of n bytes."""
    number = lambda x: F.lit(str(x)).cast("decimal(21,0)")  # noqa: E731  beyond what a long holds
    high = F.conv(F.substring(F.hex(payload), 1, 2 * n), 16, 10).cast("decimal(21,0)")
    return F.when(high >= number(1 << (8 * n - 1)), high - number(1 << (8 * n))).otherwise(high).cast("long")


def payload(value: Column, kind: str) -> Column:
    """The bytes of a value of a primitive kind, as :func:`values` reads them; null for null."""
    whole = lambda x, n: F.unhex(F.substring(F.lpad(F.hex(x.cast("long")), 16, "0"), 17 - 2 * n, 2 * n))
    if kind in WIDTHS:
        return whole(value, WIDTHS[kind])
    if kind == "BOOLEAN":
        return whole(value.cast("int"), 1)
    if kind == "STRING":
        return F.encode(value, "UTF-8")
    if kind == "DATE":
        return whole(F.unix_date(value).cast("long") * 86_400_000, 8)
    if kind == "TIMESTAMP":
        return whole(F.unix_millis(value), 8)
    if kind == "BYTES":
        return value
    raise schemas.IncompatibleSchemaError(f"{kind} values are encoded by the data source")


def values(log: DataFrame, schema: dict | None) -> DataFrame:
    """``log`` with its payload as value columns, before the others."""
    kind, rest = (schema or {"type": "BYTES"})["type"].upper(), [c for c in log.columns if c != "payload"]
    p = F.col("payload")
    if kind == "JSON":
        return json_records.flattened(log, "payload", schemas.value_fields(schema), rest)
    if kind in WIDTHS:
        value = _whole(p, WIDTHS[kind]).cast(schemas.PRIMITIVES[kind])
    elif kind == "BOOLEAN":
        value = F.hex(p) != "00"
    elif kind == "STRING":
        value = F.decode(p, "UTF-8")
    elif kind == "DATE":
        value = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_whole(p, 8) / 86_400_000).cast("int"))
    elif kind == "TIMESTAMP":
        value = F.timestamp_millis(_whole(p, 8))
    elif isinstance(schemas.PRIMITIVES.get(kind), T.BinaryType):
        value = p
    else:
        raise schemas.IncompatibleSchemaError(f"{kind} payloads are decoded by the data source")
    return log.select(value.alias("value"), *rest)
