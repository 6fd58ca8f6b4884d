"""Tables as streams of Spark's own file source: a table arrives in slices, and a query is run after each and stopped again.

So every run but the first restarts from its checkpoint, with new data there.  A slice is written by one job; the file
source takes files in the order in which they came, so that a slice is read before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewater.sources.places import shared_folder


def drained(writer: DataStreamWriter) -> StreamingQuery:
    """Runs a query under AvailableNow to its end, and gives it for its progress; what made it fail is raised."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def feed(spark: SparkSession, path: str, like: DataFrame, **limits: str) -> DataFrame:
    """The stream of the Parquet files at ``path``; limits are maxFilesPerTrigger and maxBytesPerTrigger."""
    return spark.readStream.schema(like.schema).options(**limits).parquet(path)


def replayed(df: DataFrame, slices: Column, n: int, run: Callable[[DataFrame], object]) -> None:
    """Calls ``run`` with the stream of ``df`` after each of its ``n`` slices (0 to n - 1) has arrived."""
    spark = df.sparkSession
    kept, path = shared_folder(spark, "slices"), shared_folder(spark, "feed")
    df.withColumn("_slice", slices.cast("int")).write.partitionBy("_slice").parquet(kept)
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(kept)
    for i in range(n):
        stored.filter(F.col("_slice") == i).drop("_slice").write.mode("append").parquet(path)
        run(feed(spark, path, df))


def day(ts: Column) -> Column:
    """Days since the epoch."""
    return F.unix_date(F.to_date(ts))
