"""A sparse time index over a stored log: one row a ledger, so that a time is resolved by the index and one ledger's rows.

The log is stored by topic-partition and span of ledgers; both are folders, so that only the spans in question are
scanned.  Publish times needn't ascend: the first message at or after a time is in the first ledger whose newest message
is, wherever in that ledger it stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.envelope import POSITION, position
from tidewater.operators import offsets

SPAN = 8


def store(log: DataFrame, path: str, span: int = SPAN) -> None:
    """Writes ``log`` (with __topic, position and __publishTime) and its index, once."""
    spark = log.sparkSession
    placed = log.withColumn("span", F.floor(F.col("ledger") / span).cast("long"))
    placed.repartition("__topic", "span").sortWithinPartitions("__topic", "span", *POSITION).write.partitionBy("__topic", "span").parquet(f"{path}/log")
    rows = stored(spark, path, log)
    index = rows.groupBy("__topic", "span", "ledger").agg(F.min("__publishTime").alias("oldest"), F.max("__publishTime").alias("newest"), F.min(position()).alias("first"), F.max(position()).alias("last"))
    index.write.parquet(f"{path}/index")


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored log, with the columns of the one that was written and ``span``."""
    names = [c for c in like.columns if c not in ("__topic", "span")]
    schema = like.select(*names, F.col("__topic"), F.lit(0).cast("long").alias("span")).schema
    return spark.read.schema(schema).parquet(f"{path}/log")


def index(spark: SparkSession, path: str) -> DataFrame:
    where = "struct<ledger: bigint, entry: bigint, batch_index: bigint>"
    return spark.read.schema(f"__topic string, span long, ledger long, oldest timestamp, newest timestamp, first {where}, last {where}").parquet(f"{path}/index")


def at_time(log: DataFrame, ledgers: DataFrame, times: DataFrame) -> DataFrame:
    """offsets.at_time() of the stored ``log`` by its index ``ledgers``: for each topic-partition of ``times`` (__topic, ms), a position.

    Earliest (-1), latest (-2) and times after all messages are resolved by the index alone.
    """
    t = times.select(F.col("__topic").alias("_t"), "ms")
    met = ledgers.join(t, F.col("__topic") == F.col("_t"))
    ends = met.groupBy("__topic", "ms").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    asked = met.filter((F.col("ms") > 0) & (F.unix_micros("newest") >= F.col("ms") * 1000))
    asked = asked.groupBy("_t", "ms").agg(F.min(F.struct("ledger", "span")).alias("l")).select("_t", "ms", F.col("l.ledger").alias("_l"), F.col("l.span").alias("_s"))
    rows = log.select("__topic", "span", *POSITION, "__publishTime")
    rows = rows.join(asked, (F.col("__topic") == F.col("_t")) & (F.col("span") == F.col("_s")) & (F.col("ledger") == F.col("_l")))
    found = rows.filter(F.unix_micros("__publishTime") >= F.col("ms") * 1000).groupBy(F.col("__topic").alias("_f")).agg(F.min(position()).alias("found"))
    out = ends.join(found, F.col("__topic") == F.col("_f"), "left")
    p = F.coalesce(F.when(F.col("ms") == offsets.TIME_EARLIEST, F.col("first")), F.col("found"), F.col("last"))
    return out.select("__topic", *[p[c].alias(c) for c in POSITION])


def read(log: DataFrame, ledgers: DataFrame, start: DataFrame) -> DataFrame:
    """offsets.read() from ``start`` on, of those spans only that hold ledgers from there on."""
    s = start.select(F.col("__topic").alias("_t"), F.col("ledger").alias("_l"))
    spans = ledgers.join(s, F.col("__topic") == F.col("_t")).filter(F.col("ledger") >= F.col("_l")).select("_t", F.col("span").alias("_s")).distinct()
    rows = log.join(spans, (F.col("__topic") == F.col("_t")) & (F.col("span") == F.col("_s")), "left_semi")
    return offsets.read(rows, start)
