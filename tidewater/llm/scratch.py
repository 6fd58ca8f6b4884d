"""Tables written between the steps of an operator, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_made: list[str] = []


def folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path under spark.checkpoint.dir; under a local temporary folder only where that is unset and there is one machine.

    What is not to ``keep`` goes with :func:`clear`.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all machines share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/tidewater/{name}-{uuid.uuid4().hex}"
    if not keep:
        _made.append(path)
    return path


def mark() -> int:
    """Stands for all that is written so far."""
    return len(_made)


def clear(spark: SparkSession, since: int, *but: str) -> None:
    """Deletes what was written between steps since a mark, other than the paths given."""
    gone = [p for p in _made[since:] if p not in but]
    for path in gone:
        drop(spark, path)
    _made[since:] = [p for p in _made[since:] if p in but]


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few MB, so that rows with long texts or sets don't add up in Python workers."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, before)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once and read again: cuts the lineage, and lost executors cost no recomputation."""
    path = path or folder(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
