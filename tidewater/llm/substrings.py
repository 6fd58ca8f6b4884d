"""Exact removal of repeated byte strings, by suffixes sorted deep-shallow.

A byte is removed if a ``LENGTH``-byte string that covers it also starts anywhere else in the corpus.

Anchors.  Every window of LENGTH bytes names one anchor: the position of the least hash among the K-byte strings in it
(the last of equals).  Equal windows have equal anchors at equal offsets, so only windows whose anchors' K-byte strings
come twice can repeat, and consecutive windows mostly share an anchor.  An anchor's context is the bytes of all windows
that name it.

Groups.  Anchors with equal K-byte strings are a group.  If a whole context comes twice in its group, all its windows
are repeated.  The other contexts of a group are sorted: the suffixes that start at the anchor and, reversed, the
prefixes that end there, both by :mod:`deepshallow`.  Common prefixes in both orders give, for any two contexts, how far
they agree to either side, and so which of their windows are equal.

Groups of more than ``MANY`` different contexts are never gathered.  They are split by offsets, halving the range each
time: the windows of a half share more bytes around the anchor, so contexts, cut to those windows, form smaller groups
by those bytes, or become equal to others and are decided.  At one offset a group is one window.  A context has two
halves at most, and those that stand alone drop out, so that a level is no larger than twice the one before, and eight
levels are the most there can be.

Defined results for odd input: a null text has no bytes; texts of fewer than LENGTH bytes lose none; a text that
repeats as a row loses all its bytes if it has LENGTH of them; ids may repeat or be null; other columns aren't read; an
empty table has no rows.  Memory of a task is bounded by blocks of ``BLOCK`` bytes and by the largest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.deepshallow import deep_shallow
from tidewater.llm.shingles import mixed
from tidewater.llm.text import only, whole

LENGTH = 200
K = 64
BLOCK = 1 << 20
MANY = 1024
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@lru_cache(2)
def powers(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte; powers of the base and of its inverse modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))

    def up(b: int) -> np.ndarray:
        f = np.full(BLOCK + 1, b, np.uint64)
        f[0] = 1
        return np.multiply.accumulate(f)

    return values, up(base), up(inverse)


class Rolling:
    """Hashes of any part of a block, from one cumulative sum."""

    def __init__(self, data: np.ndarray, base: int):
        values, up, self.down = powers(base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.down[a])


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of x[i : i + w] for each i that has w values."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, first: np.ndarray, n: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts data[first : first + n], within a block: text, first and last window start, anchor (in the block), hashes."""
    w = length - k + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    roll, other = Rolling(data, BASES[0]), Rolling(data, BASES[1])
    at = np.arange(len(data) - k + 1)
    h = roll.of(at, at + k)
    low = np.uint64(BLOCK - 1)
    least = sliding_least((h & ~low) | (low - at.astype(np.uint64)), w)
    many = np.maximum(n - length + 1, 0)
    text = np.repeat(np.arange(len(n)), many)
    start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    anchor = (low - (least[start] & low)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(start)) - 1 if len(lo) else lo
    a, b, p = start[lo], start[hi], anchor[lo]
    shape = mixed(((b - a) << 8 | (p - a)).astype(np.uint64) + np.uint64(1))
    return text[lo], a, b, p, h[p], mixed(other.of(a, b + length) ^ shape)


def blocks(ids: list[int], texts: list[str], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side in blocks of fewer than BLOCK bytes: data, ids, where each begins in its text and in the block, length."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def out() -> tuple[np.ndarray, ...]:
        n = np.array([len(b) for _, _, b in held])
        return np.frombuffer(b"".join(b for _, _, b in held), np.uint8), np.array([i for i, _, _ in held]), np.array([o for _, o, _ in held]), np.cumsum(n) - n, n

    step = BLOCK - length
    for i, t in zip(ids, texts, strict=True):
        raw = t.encode("utf-8", "surrogatepass")
        for o in range(0, max(1, len(raw) - length + 1), step):
            part = raw[o : o + step + length - 1]
            if size + len(part) >= BLOCK - 1:
                yield out()
                held, size = [], 0
            held.append((i, o, part))
            size += len(part)
    if held:
        yield out()


def equal_windows(contexts: list[tuple[bytes, int, int]], length: int, k: int) -> list[list[tuple[int, int]]]:
    """For each context (bytes, anchor's offset, last window start), the ranges of window starts equal to another's at the same offset."""
    m = len(contexts)
    right = [c[p:] for c, p, _ in contexts]
    left = [c[:p][::-1] for c, p, _ in contexts]

    def agree(strings: list[bytes], depth: int):
        order, lcp = deep_shallow(strings, depth)
        rank = np.empty(m, np.int64)
        rank[order] = np.arange(m)
        near = np.array(lcp)

        def of(i: int) -> np.ndarray:
            r, out = rank[i], np.empty(m, np.int64)
            out[r] = len(strings[i])
            if r + 1 < m:
                out[r + 1 :] = np.minimum.accumulate(near[r + 1 :])
            if r:
                out[:r] = np.minimum.accumulate(near[1 : r + 1][::-1])[::-1]
            back = np.empty(m, np.int64)
            back[order] = out
            return back

        return of

    to_right, to_left = agree(right, k), agree(left, 0)
    found = []
    for i, (_, p, last) in enumerate(contexts):
        # A window that starts o bytes before the anchor needs o bytes to the left and length - o to the right.
        high, low = np.minimum(to_left(i), p), np.maximum(length - to_right(i), p - last)
        high[i] = -1
        ok = np.flatnonzero(high >= low)
        found.append(sorted({(p - int(high[j]), p - int(low[j])) for j in ok}))
    return found


def repeated(docs: DataFrame, length: int = LENGTH, k: int = K, many: int = MANY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, end) and kept (the remaining bytes) of every document."""
    w = length - k
    if not 0 < w < 256:
        raise ValueError("a window has to hold 1 to 255 more bytes than an anchor")
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    ids = docs.groupBy("doc_id").count()
    if ids.filter((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).count():
        docs = scratch.written(docs.withColumn("tid", F.monotonically_increasing_id()), "texts")
    else:
        docs = docs.withColumn("tid", F.col("doc_id"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, own, offset, first, n in blocks(batch.column(0).to_pylist(), batch.column(1).to_pylist(), length):
                t, a, b, p, kh, fh = anchors(data, first, n, length, k)
                place = (a - first[t] + offset[t]) << 16 | (b - a) << 8 | (p - a)
                yield pa.RecordBatch.from_arrays([pa.array(kh.view(np.int64)), pa.array(fh.view(np.int64)), pa.array(own[t]), pa.array(place)], ["kh", "fh", "tid", "place"])

    found = scratch.written(docs.select("tid", "text").mapInArrow(find, "kh long, fh long, tid long, place long"), "anchors")
    # Sums are written by themselves, so that joins with them are plain ones, which Spark splits where a key is hot.
    twice = scratch.written(found.groupBy("kh").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("kh").alias("k2")), "repeated-keys")
    again = scratch.written(found.join(twice, F.col("kh") == F.col("k2")).drop("k2"), "repeated-anchors")

    contexts = scratch.written(again.groupBy("kh", "fh").agg(F.count("*").alias("n"), F.min(F.struct("tid", "place")).alias("rep")), "contexts")
    same = contexts.filter("n > 1").select(F.col("kh").alias("k2"), F.col("fh").alias("f2"))
    start, width, off = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    whole_context = again.join(same, (F.col("kh") == F.col("k2")) & (F.col("fh") == F.col("f2"))).select("tid", start.alias("a"), (start + width + length).alias("b"))

    groups = contexts.groupBy("kh").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 and least = 1").select(F.col("kh").alias("k2"), "m")
    mixed_groups = contexts.join(groups, F.col("kh") == F.col("k2")).select("kh", "m", "n", F.col("rep.tid").alias("tid"), F.col("rep.place").alias("place"))
    by_text = mixed_groups.groupBy("tid").agg(F.collect_list(F.struct("kh", "m", "n", "place")).alias("wanted")).withColumnRenamed("tid", "t2")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                raw = r["text"].encode("utf-8", "surrogatepass")
                rows = [(x["kh"], x["m"], x["n"], r["tid"], x["place"], raw[x["place"] >> 16 : (x["place"] >> 16) + (x["place"] >> 8 & 255) + length]) for x in r["wanted"]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["kh", "m", "n", "tid", "place", "context"])

    # One sort decides between equal hashes of different K-byte strings, too: the anchor's own bytes are part of the key.
    cuts = docs.select("tid", "text").join(by_text, F.col("tid") == F.col("t2")).select("tid", "text", "wanted").mapInArrow(cut, "kh long, m long, n long, tid long, place long, context binary")
    cuts = scratch.written(cuts, "cuts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(group: list[dict]) -> list[tuple[int, int, int]]:
            out = []
            kinds: dict[bytes, list[dict]] = {}
            for g in group:
                p = g["place"] & 255
                kinds.setdefault(g["context"][p : p + k], []).append(g)
            for own in kinds.values():
                if len(own) < 2:
                    continue
                got = equal_windows([(g["context"], g["place"] & 255, g["place"] >> 8 & 255) for g in own], length, k)
                out += [(g["tid"], (g["place"] >> 16) + lo, (g["place"] >> 16) + hi + length) for g, ranges in zip(own, got, strict=True) if g["n"] == 1 for lo, hi in ranges]
            return out

        def batch_of(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["tid", "a", "b"])

        group: list[dict] = []
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for r in batch.to_pylist():
                if group and group[0]["kh"] != r["kh"]:
                    out += spans(group)
                    group = []
                group.append(r)
            yield batch_of(out)
        yield batch_of(spans(group))

    def compared(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("m") <= many).repartition("kh").sortWithinPartitions("kh", "tid", "place").mapInArrow(compare, "tid long, a long, b long")

    def halves(level: int):
        """Contexts cut to the windows in each half of their range of offsets; ranges have (w + 1) / 2**level offsets, about."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            edge = [-(-(w + 1) * j // (1 << level)) for j in range((1 << level) + 1)]
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    p, width, context = r["place"] & 255, r["place"] >> 8 & 255, r["context"]
                    for part in (2 * r["part"], 2 * r["part"] + 1):
                        # Offsets of this part, and those of them that windows of this context have.
                        low, high = edge[part], edge[part + 1] - 1
                        a, b = max(low, p - width), min(high, p)
                        if a > b:
                            continue
                        key = hashlib.blake2b(b"%d,%d," % (r["kh"], part) + context[p - low : p + length - high], digest_size=8).digest()
                        own = context[p - b : p + length - a]
                        shape = hashlib.blake2b(b"%d,%d," % (a, b) + own, digest_size=8).digest()
                        rows.append((int.from_bytes(key, "big", signed=True), int.from_bytes(shape, "big", signed=True), r["n"], r["tid"], (r["place"] >> 16) + p - b << 16 | b - a << 8 | b, own, part))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds)], ["kh", "fh", "n", "tid", "place", "context", "part"])

        return run

    covers = [whole_context, compared(cuts)]
    large, level = cuts.filter(F.col("m") > many).withColumn("part", F.lit(0)), 0
    while (1 << level) < 2 * (w + 1) and large.limit(1).count():
        level += 1
        child = large.select("kh", "m", "n", "tid", "place", "context", "part").mapInArrow(halves(level), "kh long, fh long, n long, tid long, place long, context binary, part int")
        child = scratch.written(child, "halves")
        kinds = child.groupBy("kh", "fh").agg(F.sum("n").alias("total"), F.min(F.struct("tid", "place", "context", "part")).alias("rep"))
        kinds = scratch.written(kinds, "half-contexts")
        equal = kinds.filter("total > 1").select(F.col("kh").alias("k2"), F.col("fh").alias("f2"))
        covers.append(child.filter("n = 1").join(equal, (F.col("kh") == F.col("k2")) & (F.col("fh") == F.col("f2"))).select("tid", start.alias("a"), (start + width + length).alias("b")))
        own = kinds.groupBy("kh").agg(F.count("*").alias("m"), F.min("total").alias("least")).filter("m > 1 and least = 1").select(F.col("kh").alias("k2"), "m")
        rest = kinds.join(own, F.col("kh") == F.col("k2")).select("kh", "m", F.col("total").alias("n"), "rep.tid", "rep.place", "rep.context", "rep.part")
        rest = scratch.written(rest, "half-groups")
        covers.append(compared(rest))
        large = rest.filter(F.col("m") > many)

    spans = reduce(DataFrame.unionByName, covers).groupBy("tid").agg(F.collect_list(F.struct("a", "b")).alias("spans")).withColumnRenamed("tid", "t2")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                runs: list[list[int]] = []
                for a, b in sorted((s["a"], s["b"]) for s in own or []):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                at, kept = 0, []
                for a, b in runs:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                out.append((doc_id, len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), [{"start": a, "end": b} for a, b in runs], left))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), KINDS, strict=True)], NAMES)

    joined = docs.join(spans, F.col("tid") == F.col("t2"), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary")


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
