"""Topics as folders of one Parquet table: a log on Spark's own file source and sinks.

``publish`` appends messages in a batch and ``TopicSink`` does for streams, each batch once; ``scan`` reads them in a
batch and ``follow`` as a stream.  A topic-partition is a folder ``__topic=<name>``, so that choosing topics prunes
folders, in a batch by partition filters and in a stream before files are listed.  What has been read is in the stream's checkpoint.

Rows are rebalanced by topic before they are written: a topic with most of the rows gets many files of the advised size,
and small topics don't get a file from each task.  A task keeps the files of up to ``WRITERS`` topics open instead of sorting its rows by
topic; from there on it sorts what is left.  The messages of a task become visible together, when its job commits.

A message id is the name of the message's file and its row there: it stays, and within a file ids sort as rows do.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.envelope import META, META_NAMES, PARTITION, ROOT
from tidewater.operators import sink
from tidewater.operators.topics import full_name, select_topics
from tidewater.streaming.sinks import OnceSink

#: Characters that Spark writes as %XX in the names of partition folders, beside control characters.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"
ROW_DIGITS = 12
#: Files that a task keeps open.
WRITERS = 16


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Within it, writes keep files open in place of a sort, which would hold a task's rows unpacked: ten times what it reads."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def routed(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows for the sink as messages with full topic names and a publish time, rebalanced by topic."""
    name = F.col("__topic")
    out = sink.messages(df, topic).withColumns({"__topic": F.when(name.contains("://"), name).otherwise(F.concat(F.lit(ROOT), name)), "__publishTime": F.current_timestamp()})
    return out.hint("rebalance", "__topic")


def publish(df: DataFrame, path: str, topic: str | None = None) -> None:
    """Appends rows as messages; the option ``topic`` goes before the column ``__topic``."""
    with open_files(df.sparkSession):
        routed(df, topic).write.partitionBy("__topic").mode("append").parquet(path)


class TopicSink(OnceSink):
    """A foreachBatch function that publishes each batch of a stream once, over crashes and restarts."""

    def __init__(self, path: str, stream: str = "main", topic: str | None = None):
        super().__init__(path, stream)
        self.topic = topic

    def store(self, rows: DataFrame, batch: int) -> None:
        with open_files(rows.sparkSession):
            routed(rows, self.topic).write.partitionBy("__topic").mode("overwrite").parquet(self.rows_at(batch))

    def rows(self, spark: SparkSession) -> DataFrame:
        return enveloped(super().rows(spark), "stream", "batch")

    def read(self, spark: SparkSession) -> DataFrame:
        """Messages of whole batches, with the metadata columns."""
        return super().read(spark).drop("stream", "batch")


def stored(values: T.StructType) -> T.StructType:
    """The schema of files whose value columns are ``values``, with the topic that is their folder's."""
    kept = [f for f in META.fields if f.name not in ("__topic", "__messageId")]
    return T.StructType([*values.fields, *kept, META["__topic"]])


def enveloped(df: DataFrame, *others: str) -> DataFrame:
    """Value columns, then the metadata columns in their order, then ``others``."""
    at = F.concat_ws(":", F.col("_metadata.file_name"), F.lpad(F.col("_metadata.row_index").cast("string"), ROW_DIGITS, "0"))
    out = {"__messageId": F.encode(at, "UTF-8"), "__topic": F.col("__topic").cast("string")}
    return df.select(*[c for c in df.columns if c not in (*META_NAMES, *others)], *[out.get(c, F.col(c)).alias(c) for c in META_NAMES], *others)


def scan(spark: SparkSession, path: str, values: T.StructType | None = None, **choice: str) -> DataFrame:
    """All messages of the chosen topics (``topic``, ``topics`` or ``pattern``; all without); value columns are those of the files unless given."""
    reader = spark.read if values is None else spark.read.schema(stored(values))
    df = enveloped(reader.parquet(path))
    return select_topics(df, **choice) if choice else df


def escaped(name: str) -> str:
    """A topic's name as Spark spells it in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 0x20 else c for c in name)


def folders(topic: str | None = None, topics: str | None = None, pattern: str | None = None) -> str:
    """A glob of the chosen topics' folders; a pattern's are narrowed down by the filter that follows."""
    if pattern is not None or (topic is None and topics is None):
        return "__topic=*"
    names = [escaped(full_name(t.strip())) for t in ([topic] if topic is not None else topics.split(",")) if t.strip()]
    return "{" + ",".join(f"__topic={n}{end}" for n in names for end in ("", f"{PARTITION}*")) + "}"


def follow(spark: SparkSession, path: str, values: T.StructType, max_bytes: int = 0, max_files: int = 0, **choice: str) -> DataFrame:
    """The stream of the chosen topics' messages from the earliest on.

    Topics and partitions that come later are found when files are next listed, and read from their first message; a topic that isn't
    there yet is waited for.  A batch takes files up to ``max_bytes`` and ``max_files`` (0: all there are), one file at least, oldest first.
    Files that have gone since they were listed are skipped, as the file source can't be made to fail there;
    :func:`tidewater.streaming.losses.gaps` tells what is lost from the messages' positions.
    """
    options = {"basePath": path, "ignoreMissingFiles": "true"}
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    df = enveloped(spark.readStream.schema(stored(values)).options(**options).parquet(f"{path}/{folders(**choice)}"))
    return select_topics(df, **choice) if choice else df


def n_bytes(spark: SparkSession, path: str, **choice: str) -> int:
    """The size of the chosen topics' files."""
    df = spark.read.parquet(path).select(F.col("__topic").cast("string").alias("__topic"), "_metadata.file_path", "_metadata.file_size")
    df = select_topics(df, **choice) if choice else df
    return df.distinct().agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]
