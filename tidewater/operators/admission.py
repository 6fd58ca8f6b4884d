"""How far a micro-batch may read, by bytes.

The budget is shared evenly by topic-partitions.  Within one, ledgers are walked from the start position; a ledger whose
rest fits is taken whole, and of the first that doesn't, as many entries as fit by its average entry size, one at
least.  The walk is a running sum: the ledger where the budget ends is the first whose running sum reaches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ledgers(log: DataFrame) -> DataFrame:
    """__topic, ledger, entries and bytes."""
    return log.groupBy("__topic", "ledger").agg((F.max("entry") + 1).alias("entries"), F.sum("n_bytes").alias("bytes"))


def admit(ledger_stats: DataFrame, start: DataFrame, max_bytes: int) -> DataFrame:
    """__topic, ledger, entry of the last entry to read, for topic-partitions that have one after ``start`` (exclusive).

    Topic-partitions that ``start`` doesn't know begin with their first entry.  If the even share is 0 bytes, each
    topic-partition still gets one entry, so that a query goes on.
    """
    topics = ledger_stats.select("__topic").distinct()
    share = topics.agg(F.greatest(F.lit(1), F.floor(F.lit(max_bytes) / F.greatest(F.count("*"), F.lit(1)))).alias("share"))
    s = start.select(F.col("__topic").alias("_t"), F.col("ledger").alias("_l"), F.col("entry").alias("_e"))
    df = ledger_stats.join(s, F.col("__topic") == F.col("_t"), "left").crossJoin(F.broadcast(share))  # one row
    df = df.withColumns({"_l": F.coalesce("_l", F.lit(-1)), "_e": F.coalesce("_e", F.lit(-1))}).filter((F.col("ledger") >= F.col("_l")) & (F.col("entries") > 0))
    here = F.col("ledger") == F.col("_l")
    df = df.withColumn("avg", F.greatest(F.lit(1), F.floor(F.col("bytes") / F.col("entries"))))
    df = df.withColumn("left_entries", F.when(here, F.col("entries") - F.col("_e") - 1).otherwise(F.col("entries"))).filter("left_entries > 0")
    df = df.withColumn("left_bytes", F.when(here, F.col("avg") * F.col("left_entries")).otherwise(F.col("bytes")))
    before = Window.partitionBy("__topic").orderBy("ledger").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("budget", F.col("share") - F.coalesce(F.sum("left_bytes").over(before), F.lit(0))).filter("budget > 0")
    fits = F.col("budget") > F.col("left_bytes")
    some = F.least(F.col("left_entries"), F.greatest(F.lit(1), F.floor(F.col("budget") / F.col("avg"))))
    first = F.when(here, F.col("_e") + 1).otherwise(0)
    df = df.withColumn("last", first + F.when(fits, F.col("left_entries")).otherwise(some) - 1)
    return df.groupBy("__topic").agg(F.max(F.struct("ledger", F.col("last").alias("entry"))).alias("p")).select("__topic", "p.ledger", "p.entry")
