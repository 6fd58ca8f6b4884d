"""The message envelope: metadata columns, positions, and a log view over an events table.

A position is (ledger, entry, batch_index) within a topic-partition; positions compare as structs do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Metadata columns in their order, all nullable.
META = T.StructType(
    [
        T.StructField("__key", T.BinaryType()),
        T.StructField("__topic", T.StringType()),
        T.StructField("__messageId", T.BinaryType()),
        T.StructField("__publishTime", T.TimestampType()),
        T.StructField("__eventTime", T.TimestampType()),
        T.StructField("__messageProperties", T.MapType(T.StringType(), T.StringType(), True)),
    ]
)
META_NAMES = META.fieldNames()
POSITION = ["ledger", "entry", "batch_index"]
BATCH = 4
LEDGER_ENTRIES = 25
ROOT = "topic://main/default/"
PARTITION = "-partition-"


def partition_of(topic: Column) -> Column:
    """The partition number in a topic-partition's name, -1 if it has none."""
    n = F.regexp_extract(topic, PARTITION + r"(\d+)$", 1)
    return F.coalesce(F.nullif(n, F.lit("")).cast("int"), F.lit(-1))


def base_topic(topic: Column) -> Column:
    """A topic's name without its partition's suffix."""
    return F.regexp_replace(topic, PARTITION + r"\d+$", "")


def position(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").cast("long").alias(c) for c in POSITION])


def message_id(topic: Column) -> Column:
    """Five big-endian 64-bit numbers: ledger, entry, partition, batch index and batch size; bytes sort as positions do."""
    parts = [F.col("ledger"), F.col("entry"), partition_of(topic), F.col("batch_index"), F.col("batch_size")]
    return F.unhex(F.concat(*[F.lpad(F.hex(p.cast("long")), 16, "0") for p in parts]))


def position_of(message_id: Column) -> Column:
    """The position in a message id."""
    part = lambda i: F.conv(F.substring(F.hex(message_id), 16 * i + 1, 16), 16, 10).cast("long")
    return F.struct(part(0).alias("ledger"), part(1).alias("entry"), part(3).alias("batch_index"))


def event_time(t: Column) -> Column:
    """Null unless after the epoch."""
    return F.when(F.unix_micros(t) > 0, t)


def numbered(df: DataFrame, key: str, order: list[str], day: Column) -> DataFrame:
    """Adds ``seq``, the number of a row within its key from 0, in ``order`` (whose first column ``day`` is derived from).

    In two levels: rows are numbered within a key's day, and days start where the days before them end.  So a key with
    most of the rows is dealt out by days, and of each day one row is summed up.
    """
    df = df.withColumn("_day", day)
    days = df.groupBy(key, "_day").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col(key).alias("_k2"), F.col("_day").alias("_d2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(key, "_day").orderBy(*order)
    df = df.withColumn("_row", F.row_number().over(within))
    df = df.join(days, (F.col(key) == F.col("_k2")) & F.col("_day").eqNullSafe(F.col("_d2")))
    return df.withColumn("seq", F.col("_base") + F.col("_row") - 1).drop("_day", "_k2", "_d2", "_base", "_row")


def log_view(events: DataFrame, batch: int = BATCH, ledger_entries: int = LEDGER_ENTRIES) -> DataFrame:
    """Events as messages: topic-partitions by type and user, in batches of ``batch``, ``ledger_entries`` batches to a ledger."""
    df = events.select("event_id", "user_id", "event_type", F.col("value").alias("value"), "props", F.col("ts").cast("timestamp").alias("__publishTime"))
    df = df.withColumn("__topic", F.concat(F.lit(ROOT), "event_type", F.lit(PARTITION), F.pmod("user_id", F.lit(4)).cast("string")))
    df = numbered(df, "__topic", ["__publishTime", "event_id"], F.to_date("__publishTime"))
    df = df.withColumns({"_e": F.floor(F.col("seq") / batch), "batch_index": F.col("seq") % batch, "batch_size": F.lit(batch).cast("long")})
    df = df.withColumns({"ledger": F.floor(F.col("_e") / ledger_entries), "entry": F.col("_e") % ledger_entries, "__key": F.encode(F.col("user_id").cast("string"), "UTF-8")})
    df = df.withColumns(
        {
            "__messageId": message_id(F.col("__topic")),
            "__eventTime": event_time(F.when(F.col("event_id") % 10 != 0, F.col("__publishTime"))),
            "__messageProperties": F.create_map(F.lit("k"), F.get_json_object("props", "$.k")),
            "n_bytes": (F.octet_length("props") + 8).cast("long"),
        }
    )
    return df.select("event_id", "user_id", "event_type", "value", "props", *META_NAMES, "seq", *POSITION, "batch_size", "n_bytes")
