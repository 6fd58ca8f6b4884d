"""Rows to messages: checks of a sink's input, routing, and the projection of keys, times, properties and values."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.envelope import META_NAMES, event_time

READ_ONLY = ("__messageId", "__publishTime")


def _unsupported(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unsupported(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.CalendarIntervalType, T.UserDefinedType))


def check(schema: T.StructType, topic: str | None) -> list[str]:
    """The value columns of a sink's input; raises ValueError if a column has the wrong type or there is no topic or value."""
    kinds = {f.name: f.dataType for f in schema.fields}
    if topic is None and "__topic" not in kinds:
        raise ValueError("rows have no __topic column, and the sink names no topic")
    wants = {"__topic": (T.StringType,), "__key": (T.StringType, T.BinaryType), "__eventTime": (T.LongType, T.TimestampType)}
    for name, allowed in wants.items():
        if name in kinds and not isinstance(kinds[name], allowed):
            raise ValueError(f"{name} is {kinds[name].simpleString()}; it has to be {' or '.join(k.typeName() for k in allowed)}")
    props = kinds.get("__messageProperties")
    if props is not None and not (isinstance(props, T.MapType) and isinstance(props.keyType, T.StringType) and isinstance(props.valueType, T.StringType)):
        raise ValueError(f"__messageProperties is {props.simpleString()}; it has to be map<string,string>")
    values = [n for n in kinds if n not in META_NAMES]
    if not values:
        raise ValueError("the sink needs at least one value column")
    if bad := [n for n in values if _unsupported(kinds[n])]:
        raise ValueError(f"columns {', '.join(bad)} have types that can't be written")
    if extra := [n for n in READ_ONLY if n in kinds]:
        warnings.warn(f"{', '.join(extra)} are set by the log and won't be written", RuntimeWarning, stacklevel=2)
    return values


def messages(df: DataFrame, topic: str | None = None) -> DataFrame:
    """__topic (the option goes before the column), __key as bytes, __eventTime if after the epoch, __messageProperties and the value columns.

    A bigint event time is in milliseconds.  Rows without a topic raise when they are read.
    """
    values = check(df.schema, topic)
    name = F.lit(topic) if topic is not None else F.coalesce(F.col("__topic"), F.raise_error(F.lit("null topic present in the data. Use the topic option for setting a topic.")).cast("string"))
    key = F.col("__key").cast("binary") if "__key" in df.columns else F.lit(None).cast("binary")
    at = F.lit(None).cast("timestamp")
    if "__eventTime" in df.columns:
        at = F.col("__eventTime")
        at = event_time(F.timestamp_millis(at) if isinstance(df.schema["__eventTime"].dataType, T.LongType) else at)
    props = F.col("__messageProperties") if "__messageProperties" in df.columns else F.lit(None).cast("map<string,string>")
    return df.select(name.alias("__topic"), key.alias("__key"), at.alias("__eventTime"), props.alias("__messageProperties"), *values)
