"""Sinks of streams that write each batch once, over crashes and restarts."""

from __future__ import annotations

import json
import uuid
from typing import Any

import pyarrow.fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


class OnceSink:
    """A foreachBatch function: rows by batch under ``path``, and a log of the batches that are whole beside them.

    A batch's rows replace what a crashed attempt at it has left; then its number goes to the log.  A batch that the log
    has is skipped, and readers see batches of the log only: so rows show whole batches at a time, and replaying one, before or
    after the log has it, adds nothing.  Numbers of batches belong to a stream's checkpoint: streams of different
    checkpoints that write to one path need names of their own.
    """

    def __init__(self, path: str, stream: str = "main"):
        self.path, self.stream = path, stream

    def rows_at(self, batch: int) -> str:
        return f"{self.path}/rows/stream={self.stream}/batch={batch}"

    def log(self, spark: SparkSession) -> DataFrame:
        """stream and batch of each whole batch."""
        at = f"{self.path}/log"
        p = spark._jvm.org.apache.hadoop.fs.Path(at)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return spark.createDataFrame([], "stream string, batch long")
        return spark.read.schema("stream string, batch long").parquet(at)

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        mine = spark.range(batch, batch + 1).select(F.lit(self.stream).alias("stream"), F.col("id").alias("batch"))
        if mine.join(self.log(spark), ["stream", "batch"], "left_anti").isEmpty():
            return
        self.store(rows, batch)
        self.commit(mine)

    def store(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(self.rows_at(batch))

    def commit(self, mine: DataFrame) -> None:
        mine.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def rows(self, spark: SparkSession) -> DataFrame:
        """Rows of all batches that have been stored, whole or not, with stream and batch."""
        return spark.read.parquet(f"{self.path}/rows")

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of whole batches, with stream and batch; the log prunes the folders that are read."""
        rows = self.rows(spark).withColumns({"stream": F.col("stream").cast("string"), "batch": F.col("batch").cast("long")})
        return rows.join(self.log(spark).distinct(), ["stream", "batch"], "left_semi")


class OnceWriter:
    """A writer for foreach: JSON lines, one file for each partition and epoch, which appears when the partition is closed.

    ``open`` says no where the file is there, so that a partition of an epoch that is tried again isn't written again; an attempt
    that fails leaves nothing that readers see.  ``path`` is a folder that all machines share, by any URI that Arrow knows.
    """

    def __init__(self, path: str):
        self.path = path

    def open(self, partition: int, epoch: int) -> bool:
        self.fs, base = pyarrow.fs.FileSystem.from_uri(self.path)
        self.at, self.partial = f"{base}/epoch={epoch}/part-{partition}.json", f"{base}/_open/{epoch}-{partition}-{uuid.uuid4().hex}"
        self.out = None
        if self.fs.get_file_info(self.at).type != pyarrow.fs.FileType.NotFound:
            return False
        for folder in (f"{base}/epoch={epoch}", f"{base}/_open"):
            self.fs.create_dir(folder, recursive=True)
        self.out = self.fs.open_output_stream(self.partial)
        return True

    def process(self, row: Row) -> None:
        self.out.write(json.dumps(self.shown(row.asDict(True)), ensure_ascii=False).encode() + b"\n")

    @staticmethod
    def shown(values: dict[str, Any]) -> dict[str, Any]:
        return {k: v if v is None or isinstance(v, (str, int, float, bool, list, dict)) else str(v) for k, v in values.items()}

    def close(self, error: Exception | None) -> None:
        if self.out is None:
            return
        self.out.close()
        if error is None:
            self.fs.move(self.partial, self.at)
        else:
            self.fs.delete_file(self.partial)
