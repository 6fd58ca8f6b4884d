"""The topic log as a Spark data source: batch and streaming reads, batch and streaming writes.

    spark.dataSource.register(TopicLog)
    spark.read.format("tidewater").options(**{"service.url": url, "topicsPattern": "orders.*"}).load()

A topic-partition's range is read in parts of whole ledgers, a Spark partition each, and written in ledgers of bounded size.
Messages that should follow each other and don't are reported as lost.  Offsets say what has been read: a start is exclusive by entry,
an end inclusive.  A user's position or time is turned into the place before the entry it names, so that it is read.
"""

from __future__ import annotations

import datetime as dt
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamArrowWriter, DataSourceArrowWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.functions import avro, payloads, schemas
from tidewater.functions.envelope import META_NAMES
from tidewater.operators import loss, sink
from tidewater.sources import log_store
from tidewater.sources.log_store import BEFORE_ALL, LogStore, Position
from tidewater.sources.options import EARLIEST, LATEST, ReadOptions, Where, read_options, sink_options

TIME_EARLIEST, TIME_LATEST = -1, -2
#: How much of one topic's messages, and of all, a writing task holds before it writes a ledger.
LEDGER_BYTES, TASK_BYTES = 32 << 20, 128 << 20


class Range(InputPartition):
    def __init__(self, topic: str, after: Position, upto: Position):
        self.topic, self.after, self.upto = topic, tuple(after), tuple(upto)


def place(store: LogStore, topic: str, where: Where, default: str, start: bool) -> Position:
    """Where a bound is in a topic-partition: for a start the place before it, for an end the last entry to read."""
    kind, value = where.kind, where.value
    if kind in ("positions", "times"):
        named = {log_store.full_name(t): x for t, x in value.items()}
        given = named.get(topic, named.get(log_store.base_name(topic)))
        if given is None:
            kind = default
        elif kind == "times":
            kind, value = ("time", given) if given > 0 else ({TIME_EARLIEST: EARLIEST, TIME_LATEST: LATEST}[given], None)
        else:
            value = given
    if kind == EARLIEST:
        return store.earliest(topic)
    if kind == LATEST:
        return store.latest(topic)
    if kind == "time":
        if value <= 0:
            raise ValueError(f"a time has to be after the epoch: {value}")
        found = store.entry_at_time(topic, value)
        if found is None:
            return store.latest(topic)
        return (found[0], found[1] - 1, -1) if start else found
    return store.from_position(topic, value) if start else tuple(value)


def check_known(where: Where, topics: list[str]) -> None:
    if where.kind in ("positions", "times"):
        known = {*topics, *map(log_store.base_name, topics)}
        if unknown := sorted({log_store.full_name(t) for t in where.value} - known):
            raise ValueError(f"offsets or times are given for topics that aren't read: {', '.join(unknown)}")


def message_id(ledger: int, entry: int, part: int, index: int, size: int) -> bytes:
    return struct.pack(">5q", ledger, entry, part, index, size)


class Follow:
    """Sees whether a ledger's messages start, go on and end as they should."""

    def __init__(self, topic: str, fail: bool):
        self.topic, self.fail, self.ledger, self.high = topic, fail, None, -1
        self.last = (-1, 0, 1)

    def end(self) -> None:
        if self.ledger is not None and (self.last[0] < self.high or self.last[1] != self.last[2] - 1):
            loss.report(f"ledger {self.ledger} of {self.topic} ends at {self.last[:2]}, before entry {self.high}", self.fail)

    def see(self, ledger: int, first: int, high: int, batch: pa.RecordBatch) -> None:
        if ledger != self.ledger:
            self.end()
            self.ledger, self.high, self.last = ledger, high, (first - 1, 0, 1)
        if not batch.num_rows:
            return
        entry, index, size = (np.concatenate([[x], batch.column(c).to_numpy()]) for x, c in zip(self.last, ("entry", "batch_index", "batch_size"), strict=True))
        inside = (entry[1:] == entry[:-1]) & (index[1:] == index[:-1] + 1)
        after = (entry[1:] == entry[:-1] + 1) & (index[1:] == 0) & (index[:-1] == size[:-1] - 1)
        wrong = np.flatnonzero(~(inside | after))
        if len(wrong):
            w = wrong[0]
            loss.report(f"in ledger {ledger} of {self.topic}, ({entry[w + 1]}, {index[w + 1]}) comes after ({entry[w]}, {index[w]})", self.fail)
        self.last = (int(entry[-1]), int(index[-1]), int(size[-1]))


def rows_of(store: LogStore, part: Range | None, schema: dict | None, kind: T.StructType, options: ReadOptions) -> Iterator[pa.RecordBatch]:
    """Batches of a range's messages, decoded; none without a range, which is what Spark passes if there are no partitions."""
    if part is None:
        return
    get, names = payloads.reader(schema), [n for n in kind.fieldNames() if n not in META_NAMES]
    arrow = to_arrow_schema(kind)
    _, _, number = part.topic.rpartition(log_store.PARTITION)
    partition = int(number) if number.isdigit() and log_store.PARTITION in part.topic else -1
    follow = Follow(part.topic, options.fail_on_data_loss)
    for ledger, first, high, batch in store.read(part.topic, part.after, part.upto, int(options.passed.get("reader", {}).get("batchrows", "4096"))):
        follow.see(ledger, first, high, batch)
        out = []
        for m in batch.to_pylist():
            row = get(m["payload"])
            at = m["event_time"]
            row = {n: row.get(n) for n in names}
            row |= {"__key": m["key"], "__topic": part.topic, "__messageId": message_id(ledger, m["entry"], partition, m["batch_index"], m["batch_size"]), "__publishTime": m["publish_time"]}
            row |= {"__eventTime": at if at is not None and at > avro.EPOCH else None, "__messageProperties": m["properties"]}
            out.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
    follow.end()


class BatchReader(DataSourceReader):
    def __init__(self, options: ReadOptions, kind: T.StructType):
        self.options, self.kind, self.only = options, kind, None
        store = LogStore(options.url)
        topics = store.select(options.topic_option, options.wait_for_topic, options.poll_timeout_ms / 1000)
        check_known(options.start, topics)
        check_known(options.end, topics)
        self.schema = schemas.common_schema([store.schema(t) for t in topics], options.allow_different_schemas)
        # Both ends are fixed when the table is loaded.
        self.ranges = [Range(t, place(store, t, options.start, EARLIEST, True), place(store, t, options.end, LATEST, False)) for t in topics]

    def partitions(self) -> list[Range]:
        out = []
        for r in self.ranges:
            if self.only is not None and r.topic not in self.only or r.upto == BEFORE_ALL:
                continue
            if r.upto[:2] < (r.after[0], r.after[1]):
                loss.report(f"the end {r.upto} of {r.topic} is before its start {r.after}", self.options.fail_on_data_loss)
                continue
            out += [Range(r.topic, *x) for x in LogStore(self.options.url).spread(r.topic, r.after, r.upto)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from rows_of(LogStore(self.options.url), partition, self.schema, self.kind, self.options)


class FilteringReader(BatchReader):
    """A batch reader for sessions in which spark.sql.python.filterPushdown.enabled is true; Spark refuses it in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on the topic choose partitions; Spark applies all of them again."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("__topic",):
                self.only = {f.value} if self.only is None else self.only & {f.value}
            elif isinstance(f, In) and f.attribute == ("__topic",):
                self.only = set(f.value) if self.only is None else self.only & set(f.value)
            yield f


class StreamReader(DataSourceStreamReader):
    """Micro-batches.  How far a batch may go is state of this reader, as Spark passes neither a start nor a limit."""

    def __init__(self, options: ReadOptions, kind: T.StructType):
        self.options, self.kind = options, kind
        self.store = LogStore(options.url)
        topics = self.store.select(options.topic_option, options.wait_for_topic, options.poll_timeout_ms / 1000)
        check_known(options.start, topics)
        self.schema = schemas.common_schema([self.store.schema(t) for t in topics], options.allow_different_schemas)
        self.at: dict[str, Position] | None = None
        self.cursor = options.subscription if options.predefined else f"{options.subscription or 'tidewater'}-{uuid.uuid4().hex}"
        self.known: dict[str, Position] = {}

    def topics(self) -> list[str]:
        return self.store.select(self.options.topic_option)

    def initialOffset(self) -> dict:
        start = {t: place(self.store, t, self.options.start, LATEST, True) for t in self.topics()}
        self.at = self.at or start
        return {t: list(p) for t, p in start.items()}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.initialOffset()
        topics, limit = self.topics(), self.options.max_bytes
        share = max(1, limit // max(1, len(topics)))
        new = {}
        for t in topics:
            now = self.at.get(t, BEFORE_ALL)
            last = self.store.latest(t)
            if last < now or 0 <= now[0] < self.store.born(t):
                # Another topic of that name: read on from its beginning.
                loss.report(f"{t} isn't the topic in which {now} was read; it ends at {last}", self.options.fail_on_data_loss)
                now = BEFORE_ALL
            new[t] = min(last, self.store.admitted(t, now, share)) if limit else last
        # A topic-partition that is gone stays where it was, so that partitions() sees it end.
        self.at = {**self.at, **new}
        return {t: list(p) for t, p in self.at.items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.at = {**{t: tuple(p) for t, p in end.items()}, **{t: p for t, p in (self.at or {}).items() if p > tuple(end.get(t, BEFORE_ALL))}}
        out, there = [], set(self.topics())
        for topic, p in end.items():
            after, upto = tuple(start.get(topic, BEFORE_ALL)), tuple(p)
            if topic not in there:
                if upto > after or topic in self.known:
                    loss.report(f"{topic} is gone", self.options.fail_on_data_loss)
                self.known.pop(topic, None)
                continue
            latest = self.store.latest(topic)
            self.known[topic] = latest
            other = 0 <= after[0] < self.store.born(topic)
            if latest < after or latest < upto or other:
                loss.report(f"{topic} ends at {latest} and begins with ledger {self.store.born(topic)}; {after} to {upto} was to be read", self.options.fail_on_data_loss)
                after = BEFORE_ALL if latest < after or other else after
            if upto[:2] > after[:2]:
                out += [Range(topic, *x) for x in self.store.spread(topic, after, upto)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from rows_of(LogStore(self.options.url), partition, self.schema, self.kind, self.options)

    def commit(self, end: dict) -> None:
        self.store.put_cursor(self.cursor, end)

    def stop(self) -> None:
        if not self.options.predefined:
            self.store.drop_cursor(self.cursor)


class Staged(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class Task:
    """Writes a partition's rows to staging, a ledger a topic; shared by both writers."""

    def setup(self, options: dict[str, str], kind: T.StructType) -> None:
        self.url, self.topic, passed = sink_options(options)
        self.batch = int(passed["producer"].get("batchsize", "4"))
        self.most = self.batch * int(passed["producer"].get("entriesperledger", "12500"))
        self.compression = passed["producer"].get("compression", "snappy")
        values = sink.check(kind, self.topic)
        self.kind, self.names = kind, values
        self.topic_schema = schemas.topic_schema(T.StructType([kind[n] for n in values]))
        self.millis = "__eventTime" in kind.fieldNames() and isinstance(kind["__eventTime"].dataType, T.LongType)
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, put, now = LogStore(self.url), payloads.writer(self.topic_schema), dt.datetime.now(dt.UTC)
        rows: dict[str, list[dict]] = {}
        held: dict[str, int] = {}
        files: list[dict] = []
        task = TaskContext.get()

        def flush(topic: str) -> None:
            own = rows.pop(topic)
            held.pop(topic)
            for i, m in enumerate(own):
                size = min(self.batch, len(own) - i // self.batch * self.batch)
                m |= {"entry": i // self.batch, "batch_index": i % self.batch, "batch_size": size}
            part = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(files):06d}"
            files.append(store.stage(self.job, topic, part, pa.Table.from_pylist(own, schema=log_store.SCHEMA), self.compression))

        for batch in iterator:
            for r in batch.to_pylist():
                topic = self.topic or r.get("__topic")
                if topic is None:
                    raise ValueError("a row has no topic: its __topic is null and the sink names none")
                key, at = r.get("__key"), r.get("__eventTime")
                if at is not None and self.millis:
                    at = avro.EPOCH + dt.timedelta(milliseconds=at)
                topic, data = log_store.full_name(topic), put({n: r[n] for n in self.names})
                own = rows.setdefault(topic, [])
                own.append({"key": key.encode() if isinstance(key, str) else key, "publish_time": now, "event_time": at if at is not None and (at if at.tzinfo else at.replace(tzinfo=dt.UTC)) > avro.EPOCH else None, "properties": r.get("__messageProperties"), "payload": data})
                held[topic] = held.get(topic, 0) + len(data or b"") + 200
                if len(own) >= self.most or held[topic] > LEDGER_BYTES:
                    flush(topic)
                elif len(held) > 4 and sum(held.values()) > TASK_BYTES:
                    flush(max(held, key=held.get))
        for topic in list(rows):
            flush(topic)
        return Staged(files)

    def finish(self, messages: list[Staged | None], write: str) -> None:
        store = LogStore(self.url)
        files = [f for m in messages if m is not None for f in m.files]
        for topic in {f["topic"] for f in files}:
            store.put_schema(topic, self.topic_schema)
        store.commit(write, files)


class BatchWriter(Task, DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], kind: T.StructType):
        self.setup(options, kind)

    def commit(self, messages: list[Staged | None]) -> None:
        self.finish(messages, self.job)

    def abort(self, messages: list[Staged | None]) -> None:
        LogStore(self.url).discard(self.job)


class StreamWriter(Task, DataSourceStreamArrowWriter):
    """Appends each batch once per query run: batches up to the last one committed are skipped."""

    def __init__(self, options: dict[str, str], kind: T.StructType):
        self.setup(options, kind)
        self.last = -1

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        if batchId > self.last:
            self.finish(messages, self.job)
            self.last = batchId

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        LogStore(self.url).discard(self.job)


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewater"

    def schema(self) -> T.StructType:
        # Spark asks before it says whether the read is a stream; the rules that differ are checked by the readers.
        bounds = {"startingoffsets", "endingoffsets", "startingtime", "endingtime"}
        options = read_options({k: v for k, v in self.options.items() if k.lower() not in bounds}, streaming=False)
        store = LogStore(options.url)
        topics = store.select(options.topic_option, options.wait_for_topic, options.poll_timeout_ms / 1000)
        return schemas.read_schema(schemas.common_schema([store.schema(t) for t in topics], options.allow_different_schemas))

    def _inferred(self, options: ReadOptions, given: T.StructType) -> None:
        store = LogStore(options.url)
        found = [store.schema(t) for t in store.select(options.topic_option)]
        inferred = schemas.read_schema(schemas.common_schema(found, options.allow_different_schemas))
        if given.simpleString() != inferred.simpleString():
            schemas.check_same(given, inferred)

    def reader(self, schema: T.StructType) -> BatchReader:
        options = read_options(dict(self.options), streaming=False)
        self._inferred(options, schema)
        pushed = {k.lower(): v for k, v in self.options.items()}.get("pushfilters", "false").lower() == "true"
        return (FilteringReader if pushed else BatchReader)(options, schema)

    def streamReader(self, schema: T.StructType) -> StreamReader:
        options = read_options(dict(self.options), streaming=True)
        self._inferred(options, schema)
        return StreamReader(options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("save mode overwrite is not allowed for a topic log; messages are appended")
        return BatchWriter(dict(self.options), schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(dict(self.options), schema)
