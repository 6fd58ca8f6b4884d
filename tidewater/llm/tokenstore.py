"""Token ids in a content-addressed store.

Documents become id streams (with an end id); a rolling hash over the last ``SPAN`` ids cuts each stream into chunks at
positions that depend on nearby ids only; a chunk's address is its BLAKE2b digest.  The store is one Parquet table with
two kinds of rows, in ascending order of doc_id within and across shards:

``kind=doc``
    doc_id, shard, local_start (ids before it in its shard), n_tokens, ``digests`` and ``lens`` (its recipe: chunk
    addresses and lengths, in order), ``foreign`` (which chunks other documents hold; null: none), ``shared`` (which chunks it
    holds for others too; null: none), ``payload`` (the ids of the chunks that it holds, each distinct chunk of the whole store once,
    zstd over little-endian unsigned integers) and ``root`` (Merkle root of the recipe).
``kind=shard``
    shard, n_tokens, n_docs and ``root``, the Merkle root over its documents: their ids, places, lengths and roots.
``kind=corpus``
    one row: n_tokens, n_docs and ``root``, the Merkle root over the shards.

Reading checks all of it first (:func:`verify`): a document that is missing, doubled, swapped, moved or renamed, or a shard
that is, raises.  Then each document's own root is checked as its ids are put together, which finds any changed id.

A chunk is held by the first document (by doc_id) in which it comes.  Only digests are shuffled to find that out; ids
are moved once, compressed, when the rows are dealt by ranges of doc_id.  Reading decodes most documents where they
stand and joins just the chunks that others hold.

Defined results for odd input: a null text is empty; an empty text is the end id alone; a null doc_id sorts first;
repeated rows are documents of their own, which share all chunks; an empty table gives a store without rows; other
columns aren't read.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm import caches, scratch
from tidewater.llm.text import only

END_ID = 2
SPAN = 8
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 64, 8192, 10
DIGEST = 16
CACHED, CACHED_CHARS = 1_000_000, 64
ROWS = 64
#: The pattern of byte-level BPE, and an equal one over the first 256 characters.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
NARROW = re.compile(f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: The characters by which byte-level BPE spells bytes; those that can't be seen come from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = dict(zip((b for b in range(256) if b not in _SEEN), range(256, 512)))


class Encoder:
    """Byte-level BPE of the tokenizers library, with a memory for the pieces that its own pattern splits texts into.

    BPE never merges across pieces, so the ids of a text are those of its pieces.  Texts of the first 256 characters, on
    whose kinds all Unicode tables agree, are split by an equal pattern of Python's own.  Texts that hold a special
    token's string go to the library whole.
    """

    def __init__(self, path: str, pattern: str):
        # Spark's tasks are the parallelism; threads of the library's own would wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        # The library's model alone, for what is split already.
        self.model = self.lib.model if pattern == BYTE_LEVEL and self.lib.normalizer is None else None
        self.any, self.narrow = regex.compile(pattern).findall, NARROW.findall if pattern == BYTE_LEVEL else None
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.kind, self.kind_code = ("<u2", "H") if self.lib.get_vocab_size() < 1 << 16 else ("<u4", "I")
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str], tokenizer) -> list[bytes]:
        return [array(self.kind_code, e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as bytes of self.kind; by the model itself, as an encoding of the library's for each takes longer than its merges."""
        if self.model is None:
            return self.ids(pieces, self.lib)
        tokenize = self.model.tokenize
        return [array(self.kind_code, [t.id for t in tokenize(p.encode().decode("latin-1").translate(SPELLED))]).tobytes() for p in pieces]

    def split(self, text: str) -> list[str]:
        return self.narrow(text) if self.narrow is not None and narrow(text) else self.any(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of self.kind."""
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        lists = [self.split(t) for t in texts]
        pieces = set().union(*lists)
        new = list(pieces.difference(self.known))
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = list(pieces)
        del pieces
        self.known.update(zip(new, self.of_pieces(new), strict=True))
        out = [b"".join(itemgetter(*x)(self.known)) if len(x) > 1 else b"".join(map(self.known.__getitem__, x)) for x in lists]
        for k in new:
            if len(k) > CACHED_CHARS:
                del self.known[k]
        for i, ids in zip(whole, self.ids([texts[i] for i in whole], self.lib), strict=True):
            out[i] = ids
        return out


def narrow(text: str) -> bool:
    """Whether all characters are of the first 256, about which every Unicode table agrees."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(1)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def cuts(ids: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last SPAN ids allows a cut."""
    x = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    h = x.copy()
    for j in range(1, SPAN):
        h[j:] += x[:-j] << np.uint32(j)
    return np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1


def chunks_of(length: int, allowed: np.ndarray) -> list[int]:
    """Chunk lengths of a stream; the first SPAN ids after a cut never decide (MIN_CHUNK is longer)."""
    at, out = 0, []
    for c in allowed.tolist():
        while c - at > MAX_CHUNK:
            out.append(MAX_CHUNK)
            at += MAX_CHUNK
        if c - at >= MIN_CHUNK:
            out.append(c - at)
            at = c
    while length - at > MAX_CHUNK:
        out.append(MAX_CHUNK)
        at += MAX_CHUNK
    if length > at:
        out.append(length - at)
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """The root over ``leaves``; a lone node goes up as it is."""
    level = leaves or [b""]
    while len(level) > 1:
        level = [blake2b(b"".join(level[i : i + 2]), digest_size=DIGEST).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


class Root:
    """merkle() of leaves as they come, of which only the roots of whole subtrees are held: one for each bit of their number."""

    def __init__(self):
        self.n, self.stack = 0, []

    def add(self, node: bytes) -> None:
        height, self.n = 0, self.n + 1
        while self.stack and self.stack[-1][0] == height:
            node = blake2b(self.stack.pop()[1] + node, digest_size=DIGEST).digest()
            height += 1
        self.stack.append((height, node))

    def root(self) -> bytes:
        out = None
        for _, node in reversed(self.stack):
            out = node if out is None else blake2b(node + out, digest_size=DIGEST).digest()
        return out or b""


def leaf(doc_id: int | None, start: int, n_tokens: int, root: bytes) -> bytes:
    """What a shard's root covers of a document."""
    return blake2b(struct.pack("<?qqq", doc_id is not None, doc_id or 0, start, n_tokens) + root, digest_size=DIGEST).digest()


STAGED = "doc_id long, root binary, n_tokens int, digests array<binary>, lens array<int>, payload binary"


def staged(docs: DataFrame, tokenizer: str, pattern: str, end_id: int) -> DataFrame:
    """Each document's ids and chunks, in the order of the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(tokenizer, pattern), zstandard.ZstdCompressor(1)
        caches.take("pieces", enc.known.clear)
        gc.disable()  # lists of pieces make no cycles, but would have the collector look for them
        try:
            width, end = np.dtype(enc.kind).itemsize, np.array([end_id], enc.kind).tobytes()
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    texts = [t or "" for t in batch.column(1).to_pylist()]
                    raw = [r + end for r in enc.encode(texts)]
                    n = np.array([len(r) // width for r in raw])
                    first = np.cumsum(n) - n
                    where = cuts(np.frombuffer(b"".join(raw), enc.kind))
                    lo, hi = np.searchsorted(where, first, "right"), np.searchsorted(where, first + n, "right")
                    lens = [chunks_of(int(m), where[a:b] - f) for m, a, b, f in zip(n, lo, hi, first, strict=True)]
                    digests = []
                    for r, ls in zip(raw, lens, strict=True):
                        p, own = 0, []
                        for k in ls:
                            own.append(blake2b(r[p : (p := p + k * width)], digest_size=DIGEST).digest())
                        digests.append(own)
                    roots = [merkle(d) for d in digests]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(roots, pa.binary()), pa.array(n, pa.int32()), pa.array(digests, pa.list_(pa.binary())), pa.array(lens, pa.list_(pa.int32())), pa.array([pack.compress(r) for r in raw], pa.binary())],
                        ["doc_id", "root", "n_tokens", "digests", "lens", "payload"],
                    )
        finally:
            gc.enable()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, STAGED)


STORED = "kind string, shard int, doc_id long, local_start long, n_tokens long, n_docs long, digests array<binary>, lens array<int>, foreign array<boolean>, shared array<boolean>, payload binary, root binary"


def shards(rows: DataFrame, kind: str) -> DataFrame:
    """From rows of documents, each after the row of its borrowed and shared chunks, to the rows of the store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack, width = zstandard.ZstdCompressor(1), zstandard.ZstdDecompressor(), np.dtype(kind).itemsize
        shard, start, root, pending = TaskContext.get().partitionId(), 0, Root(), None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                own, starts, foreign, shared, payloads = [], [], [], [], []
                for i, (uid, payload, n, borrowed, lent) in enumerate(zip(*[part.column(c).to_pylist() for c in ("uid", "payload", "n_tokens", "borrowed", "lent")], strict=True)):
                    if payload is None:
                        pending = (uid, set(borrowed), set(lent))
                        continue
                    mine = pending is not None and pending[0] == uid
                    lens = part.column("lens")[i].as_py() if mine else None
                    foreign.append([j in pending[1] for j in range(len(lens))] if mine else None)
                    shared.append([j in pending[2] for j in range(len(lens))] if mine else None)
                    if mine and pending[1]:
                        raw, p, left = unpack.decompress(payload), 0, []
                        for f, m in zip(foreign[-1], lens, strict=True):
                            if not f:
                                left.append(raw[p : p + m * width])
                            p += m * width
                        payload = pack.compress(b"".join(left))
                    payloads.append(payload)
                    own.append(i)
                    starts.append(start)
                    start += n
                    pending = None
                if own:
                    rows = part.take(pa.array(own))
                    for one in map(leaf, rows.column("doc_id").to_pylist(), starts, rows.column("n_tokens").to_pylist(), rows.column("root").to_pylist()):
                        root.add(one)
                    columns = [pa.repeat("doc", len(own)), pa.repeat(pa.scalar(shard, pa.int32()), len(own)), rows.column("doc_id"), pa.array(starts, pa.int64()), rows.column("n_tokens").cast(pa.int64()), pa.nulls(len(own), pa.int64())]
                    columns += [rows.column("digests").cast(SCHEMA.field("digests").type), rows.column("lens").cast(SCHEMA.field("lens").type), pa.array(foreign, SCHEMA.field("foreign").type), pa.array(shared, SCHEMA.field("shared").type), pa.array(payloads, pa.binary()), rows.column("root")]
                    yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)
        if root.n:
            yield pa.RecordBatch.from_pylist([{"kind": "shard", "shard": shard, "n_tokens": start, "n_docs": root.n, "root": root.root()}], SCHEMA)

    return rows.mapInArrow(run, STORED)


SCHEMA = pa.schema(
    [("kind", pa.string()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())]
    + [("digests", pa.list_(pa.binary())), ("lens", pa.list_(pa.int32())), ("foreign", pa.list_(pa.bool_())), ("shared", pa.list_(pa.bool_())), ("payload", pa.binary()), ("root", pa.binary())]
)


def write(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int = END_ID) -> None:
    """Encodes ``docs`` (doc_id, text) and writes the store to ``path``."""
    spark = docs.sparkSession
    kind = Encoder(tokenizer, pattern).kind
    at = scratch.folder(spark, "ids")
    with scratch.small_batches(spark):
        staged(only(docs, "doc_id", "text"), tokenizer, pattern, end_id).withColumn("uid", F.monotonically_increasing_id()).write.option("compression", "none").parquet(at)
    rows = spark.read.parquet(at)
    uses = rows.select("doc_id", "root", "uid", F.posexplode("digests").alias("i", "digest"))
    holder = uses.groupBy("digest").agg(F.min(F.struct("doc_id", "root", "uid", "i")).alias("h"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("d"), "h")
    told = uses.join(holder, F.col("digest") == F.col("d"))
    mine = (F.col("uid") == F.col("h.uid")) & (F.col("i") == F.col("h.i"))
    told = told.groupBy("doc_id", "root", "uid").agg(F.collect_list(F.when(~mine, F.col("i"))).alias("borrowed"), F.collect_list(F.when(mine, F.col("i"))).alias("lent"))
    both = rows.unionByName(told, allowMissingColumns=True)
    # By all of the key, so that rows that share an id are dealt out, too.
    dealt = both.repartitionByRange("doc_id", "root", "uid").sortWithinPartitions("doc_id", "root", "uid", F.col("payload").isNotNull())
    with scratch.small_batches(spark):
        shards(dealt, kind).write.partitionBy("kind").option("compression", "none").parquet(path)
    scratch.drop(spark, at)
    corpus(spark.read.schema(STORED).parquet(path).filter("kind = 'shard'")).write.partitionBy("kind").mode("append").parquet(path)


def corpus(shard_rows: DataFrame) -> DataFrame:
    """The corpus row over the rows of all shards, in the store's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row a shard: as many as there were write tasks.
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["shard"])
        root = merkle([leaf(r["shard"], r["n_docs"], r["n_tokens"], r["root"]) for r in rows])
        yield pa.RecordBatch.from_pylist([{"kind": "corpus", "n_tokens": sum(r["n_tokens"] for r in rows), "n_docs": sum(r["n_docs"] for r in rows), "root": root}], SCHEMA)

    return shard_rows.select("shard", "n_docs", "n_tokens", "root").repartition(1).mapInArrow(run, STORED)


def verify(spark: SparkSession, path: str) -> None:
    """Raises unless the documents of every shard are those of its root, and the shards those of the corpus root."""
    rows = spark.read.schema(STORED).parquet(path)

    of_shard = pa.schema([SCHEMA.field(c) for c in ("shard", "n_docs", "n_tokens", "root")])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, root, tokens = None, Root(), 0
        for batch in batches:
            out = []
            for s, doc_id, start, n, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if s != shard:
                    if root.n:
                        out.append({"shard": shard, "n_docs": root.n, "n_tokens": tokens, "root": root.root()})
                    shard, root, tokens = s, Root(), 0
                root.add(leaf(doc_id, start, n, own))
                tokens += n
            if out:
                yield pa.RecordBatch.from_pylist(out, of_shard)
        if root.n:
            yield pa.RecordBatch.from_pylist([{"shard": shard, "n_docs": root.n, "n_tokens": tokens, "root": root.root()}], of_shard)

    # Documents stream in order of their shards, however many one has.
    held = rows.filter("kind = 'doc'").select("shard", "doc_id", "local_start", "n_tokens", "root").repartition("shard").sortWithinPartitions("shard", "local_start", "root")
    found = held.mapInArrow(again, "shard int, n_docs long, n_tokens long, root binary")
    said = rows.filter("kind = 'shard'").select("shard", "n_docs", "n_tokens", "root")
    wrong = found.exceptAll(said).union(said.exceptAll(found)).select("shard").distinct().limit(5).collect()
    if wrong:
        raise ValueError(f"documents of shards {sorted(r.shard for r in wrong)} don't match the manifest of {path}")
    of = ["n_docs", "n_tokens", "root"]
    if [tuple(r) for r in corpus(said).select(*of).collect()] != [tuple(r) for r in rows.filter("kind = 'corpus'").select(*of).collect()]:
        raise ValueError(f"the shards of {path} don't match its corpus root")


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """doc_id, start, n_tokens, ``payload`` (all ids) and ``pieces``, decoded from the files and checked against the roots."""
    rows = spark.read.schema(STORED).parquet(path)
    sums = rows.filter("kind = 'shard'").select(F.col("shard").alias("s"), (F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")).alias("base"))
    # One row a shard: as many as there were write tasks.
    docs = rows.filter("kind = 'doc'").join(F.broadcast(sums), F.col("shard") == F.col("s")).withColumn("start", F.col("base") + F.col("local_start"))
    docs = docs.select("doc_id", "start", "n_tokens", "digests", "lens", "foreign", "shared", "payload", "root")
    lent = docs.filter(F.coalesce(F.exists("shared", lambda x: x), F.lit(False))).select("digests", "lens", "foreign", "shared", "payload").mapInArrow(lent_chunks(kind), "address binary, chunk binary")
    borrows = F.coalesce(F.exists("foreign", lambda x: x), F.lit(False))
    some = docs.filter(borrows)
    wanted = some.select(F.col("start").alias("to"), F.posexplode(F.arrays_zip("digests", "foreign")).alias("i", "x")).filter("x.foreign").select("to", "i", F.col("x.digests").alias("digest"))
    pieces = wanted.join(lent, F.col("digest") == F.col("address")).groupBy("to").agg(F.sort_array(F.collect_list(F.struct("i", "chunk"))).alias("pieces"))
    done = docs.filter(~borrows).withColumn("pieces", F.lit(None).cast("array<struct<i:int,chunk:binary>>"))
    return done.unionByName(some.join(pieces, F.col("start") == F.col("to"), "left").drop("to"))


def held(r: dict, unpack: zstandard.ZstdDecompressor, width: int) -> Iterator[tuple[int, bytes]]:
    """Index and bytes of the chunks that a row holds itself."""
    raw, p = unpack.decompress(r["payload"]), 0
    for i, (m, f) in enumerate(zip(r["lens"], r["foreign"] or [False] * len(r["lens"]), strict=True)):
        if not f:
            yield i, raw[p : (p := p + m * width)]


def lent_chunks(kind: str):
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            got = [(r["digests"][i], c) for r in batch.to_pylist() for i, c in held(r, unpack, width) if r["shared"][i]]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in got], pa.binary()), pa.array([c for _, c in got], pa.binary())], ["address", "chunk"])

    return run


def stream(r: dict, unpack: zstandard.ZstdDecompressor, width: int) -> bytes:
    """All ids of a row of read(); raises if a chunk isn't what its address or the root says."""
    if not any(r["foreign"] or ()):
        out = unpack.decompress(r["payload"])
        parts, p = [], 0
        for m in r["lens"]:
            parts.append(out[p : (p := p + m * width)])
    else:
        own = dict(held(r, unpack, width)) | {x["i"]: x["chunk"] for x in r["pieces"] or []}
        parts = [own[i] for i in range(len(r["lens"]))]
        out = b"".join(parts)
    if merkle([blake2b(c, digest_size=DIGEST).digest() for c in parts]) != r["root"]:
        raise ValueError(f"the ids of document {r['doc_id']} don't match their Merkle root")
    if len(out) != r["n_tokens"] * width:
        raise ValueError(f"document {r['doc_id']} has {len(out) // width} ids, not {r['n_tokens']}")
    return out


def digests(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over little-endian unsigned 32-bit ids) of every stored document, after verify()."""
    verify(spark, path)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            crc, n = [], []
            for r in batch.to_pylist():
                ids = np.frombuffer(stream(r, unpack, width), kind)
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                n.append(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return scratch.written(read(spark, path, kind).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"), "id-digests")


def id_kind(tokenizer: str, pattern: str) -> str:
    return Encoder(tokenizer, pattern).kind
