"""Ranks and running sums over all rows, in two levels: within ranges of the order, then over the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import scratch


def placed(df: DataFrame, name: str, order: list[str], size: Column, within: str | None = None) -> DataFrame:
    """``df``, written, with ``at``: the sum of ``size`` over the rows before it by ``order``, and ``whole``: that over all rows.

    ``within`` starts the sums again for each of its values, which must not be null and be the first of ``order``.  Rows
    must differ in ``order``.  A range holds about as many rows as any other, however many share ``within``; of the
    ranges there is one row each (and one more for each value of ``within`` that begins in it).
    """
    rows = scratch.written(df.repartitionByRange(*order).withColumns({"_size": size.cast("long"), "_part": F.spark_partition_id()}), name)
    keys = [within] if within else []
    before = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_part", *keys).agg(F.sum("_size").alias("_sum"))
    of = Window.partitionBy(*keys) if within else Window.partitionBy(F.lit(0))
    bases = sums.select(
        F.col("_part").alias("_p"),
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.coalesce(F.sum("_sum").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
        F.sum("_sum").over(of).alias("whole"),
    )
    met = (F.col("_part") == F.col("_p")) if not within else (F.col("_part") == F.col("_p")) & (F.col(within) == F.col(f"_{within}"))
    out = rows.withColumn("_local", F.coalesce(F.sum("_size").over(before), F.lit(0))).join(bases, met)
    return out.withColumn("at", F.col("_base") + F.col("_local")).drop("_size", "_part", "_local", "_base", "_p", *[f"_{k}" for k in keys])
