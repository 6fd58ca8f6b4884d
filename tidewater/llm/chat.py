"""Chat formatting as prefix trees: turns that conversations begin with in common are stored once.

A turn is written ``<|im_start|>role\\n``, text, ``<|im_end|>\\n``.  Inside roles and texts, every ``<`` followed by any
backslashes and ``|`` gets a backslash more, so that no control string is left in them, and taking one away gives them back; in
roles, backslashes and line ends are escaped first.  Header, text and end are encoded apart, so that the loss mask (the
texts of assistant turns) has whole tokens.

A node of a tree is a turn with all turns before it.  Nodes are laid out depth-first: conversations are sorted by the
digests of their nodes, each node belongs to the first conversation that has it, and nodes follow in the order of these
conversations and their turns.  Two tables are written:

``nodes``
    start (place in the depth-first sequence, in tokens), tree (start of its root), position (its first position id, the
    tokens of its ancestors; its tokens have position, position + 1, ...), n_tokens, loss_from and loss_to (its tokens under the mask),
    ``ancestors`` (intervals of the sequence that its tokens attend to besides itself up to each token; adjoining ones
    are merged) and ids (little-endian).
``paths``
    conv_id, depth, start: the nodes of each conversation.

A first turn of very many conversations is a hot node: it is counted by partial minima, joined on as a table of one row a
node, and its tokens are stored once.  Trees are never gathered: order, places and ancestors come from two-level running sums
and from streams of conversations in order; all turns of a conversation pass through one task.

Defined results for odd input: a null text or role is empty; a null conversation is a conversation of its own; turns
without a number come first, turns of one number go by role, then by the SHA-256 of the text; equal conversations share
all their nodes; an empty table gives empty tables; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import caches, scratch
from tidewater.llm.places import placed
from tidewater.llm.text import only
from tidewater.llm.tokenstore import encoder

START, END = "<|im_start|>", "<|im_end|>\n"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
ROWS = 64


def escaped(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def header(role: str) -> str:
    role = role.replace("\\", "\\\\").replace("\n", "\\n")
    return f"{START}{escaped(role)}\n"


def role_of(head: str) -> str:
    """The role that a header names."""
    if not (head.startswith(START) and head.endswith("\n")):
        raise ValueError(f"not a header: {head!r}")
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(head[len(START) : -1]))


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    head, _, rest = turn.partition("\n")
    if not rest.endswith(END):
        raise ValueError(f"a turn without its end: {turn[:80]!r}")
    return role_of(head + "\n"), unescaped(rest[: -len(END)])


TURNS = "conv_id long, depth int, node binary, role string, position long, n_tokens long, loss_from long, loss_to long, ids binary, path binary"
ARROW = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("role", pa.string()), ("position", pa.int64()), ("n_tokens", pa.int64()), ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("ids", pa.binary()), ("path", pa.binary())]
)


def formatted(rows: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """A row for each turn with its node (digest of it and all before it), and one for each conversation with ``path``, the digests of its nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, pattern)
        caches.take("pieces", enc.known.clear)
        width, heads, end = np.dtype(enc.kind).itemsize, {}, enc.encode([END])[0]
        conv, node, path, depth, position, began = None, b"", bytearray(), 0, 0, False
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS).to_pylist()
                out, ids = [], enc.encode([escaped(r["text"]) for r in part])
                for r, own in zip(part, ids, strict=True):
                    if not began or r["conv_id"] != conv:
                        if began:
                            out.append({"conv_id": conv, "path": bytes(path)})
                        conv, node, path, depth, position, began = r["conv_id"], b"", bytearray(), 0, 0, True
                    role = r["role"]
                    if role not in heads:
                        heads[role] = enc.encode([header(role)])[0]
                        if len(heads) > 1000:
                            heads = {role: heads[role]}
                    node = blake2b(node + f"{len(role)}:{role}{r['text']}".encode(), digest_size=16).digest()
                    all_ids, before = heads[role] + own + end, len(heads[role]) // width
                    n = len(all_ids) // width
                    loss = (before, before + len(own) // width) if role == "assistant" else (0, 0)
                    out.append({"conv_id": conv, "depth": depth, "node": node, "role": role, "position": position, "n_tokens": n, "loss_from": loss[0], "loss_to": loss[1], "ids": all_ids})
                    path += node
                    depth, position = depth + 1, position + n
                yield pa.RecordBatch.from_pylist(out, ARROW)
        if began:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "path": bytes(path)}], ARROW)

    rows = only(rows, "conv_id", "turn", "role", "text")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.sha2("text", 256))
    return dealt.select("conv_id", "role", "text").mapInArrow(run, TURNS)


SPAN = "array<struct<from:bigint,to:bigint>>"


def with_ancestors(uses: DataFrame) -> DataFrame:
    """Of (conv_id, rank, depth, start, n_tokens, owner): the nodes that each conversation owns, with tree and ancestors."""
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, spans = 0, []
        for batch in batches:
            keep, trees, ancestors = [], [], []
            for i, (depth, start, n, mine) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("depth", "start", "n_tokens", "mine")], strict=True)):
                if depth == 0:
                    tree, spans = start, []
                if mine:
                    keep.append(i)
                    trees.append(tree)
                    ancestors.append([{"from": a, "to": b} for a, b in spans])
                if spans and spans[-1][1] == start:
                    spans[-1] = (spans[-1][0], start + n)
                else:
                    spans.append((start, start + n))
            got = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([got.column("conv_id"), got.column("depth"), got.column("start"), pa.array(trees, pa.int64()), pa.array(ancestors, kind)], ["conv_id", "depth", "start", "tree", "ancestors"])

    dealt = uses.withColumn("mine", F.col("rank") == F.col("owner")).repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return dealt.select("conv_id", "depth", "start", "n_tokens", "mine").mapInArrow(run, f"conv_id long, depth int, start long, tree long, ancestors {SPAN}")


def write(rows: DataFrame, path: str, tokenizer: str, pattern: str) -> None:
    """Formats the turns ``rows`` (conv_id, turn, role, text) and writes ``nodes`` and ``paths`` under ``path``."""
    turns = scratch.written(formatted(rows, tokenizer, pattern), "chat-turns")
    ranked = placed(turns.filter("path is not null").select("path", "conv_id"), "chat-order", ["path", "conv_id"], F.lit(1))
    light = turns.filter("path is null").select("conv_id", "depth", "node", "n_tokens")
    ranks = ranked.select(F.col("conv_id").alias("c"), F.col("at").alias("rank"))
    light = scratch.written(light.join(ranks, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"), "chat-light")
    nodes = light.groupBy("node").agg(F.min("rank").alias("owner"), F.first("depth").alias("depth"), F.first("n_tokens").alias("n_tokens"))
    nodes = placed(nodes, "chat-nodes", ["owner", "depth"], F.col("n_tokens")).select(F.col("node").alias("own_node"), "owner", F.col("at").alias("start"))
    uses = scratch.written(light.join(nodes, F.col("node") == F.col("own_node")).drop("node", "own_node"), "chat-uses")
    uses.select("conv_id", "depth", "start").write.parquet(f"{path}/paths")
    held = with_ancestors(uses).select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "start", "tree", "ancestors")
    stored = turns.filter("path is null").join(held, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("depth") == F.col("d")))
    stored = stored.select("start", "tree", "position", "n_tokens", "loss_from", "loss_to", "ancestors", "ids")
    with scratch.small_batches(rows.sparkSession):
        stored.repartitionByRange("start").sortWithinPartitions("start").write.option("compression", "zstd").parquet(f"{path}/nodes")


READ = "conv_id long, depth int, role string, text string, loss string, formatted string"


def read(spark: SparkSession, path: str, tokenizer: str, pattern: str) -> DataFrame:
    """Each conversation's turns in order, in one task: role, text, the unescaped text under the loss mask, and the turn as formatted."""
    nodes = spark.read.schema(f"start long, tree long, position long, n_tokens long, loss_from long, loss_to long, ancestors {SPAN}, ids binary").parquet(f"{path}/nodes")
    paths = spark.read.schema("conv_id long, depth int, start long").parquet(f"{path}/paths").withColumnRenamed("start", "s")
    met = paths.join(nodes.select("start", "n_tokens", "loss_from", "loss_to", "ids"), F.col("s") == F.col("start"))
    dealt = met.repartition("conv_id").sortWithinPartitions("conv_id", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                parts, masks = [], []
                for data, lo, hi in zip(*[batch.column(c).to_pylist() for c in ("ids", "loss_from", "loss_to")], strict=True):
                    ids = np.frombuffer(data, enc.kind).tolist()
                    parts += [ids[:lo], ids[lo:hi], ids[hi:]]
                texts = enc.lib.decode_batch(parts, skip_special_tokens=False)
                full = ["".join(texts[i : i + 3]) for i in range(0, len(texts), 3)]
                masks = [unescaped(t) for t in texts[1::3]]
                roles, plain = zip(*map(parsed, full), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("depth"), *[pa.array(x, pa.string()) for x in (roles, plain, masks, full)]], ["conv_id", "depth", "role", "text", "loss", "formatted"])

    return dealt.select("conv_id", "depth", "loss_from", "loss_to", "ids").mapInArrow(run, READ)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """Counts and digests of each conversation of read()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in DIGESTS.split(", "))])
        now = None

        def row() -> dict:
            conv, n, said, chars, loss, size = now
            return {"conv_id": conv, "n_turns": n, "turns_sha256": said.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        for batch in batches:
            done = []
            for conv, depth, role, text, loss, full in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if depth == 0:
                    if now is not None:
                        done.append(row())
                    now = [conv, 0, sha256(), 0, sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(full)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    return turns.mapInArrow(run, DIGESTS)


def oracle(control: str) -> str:
    """The SQL of digests() of the table with a conversation -1 of two turns that say ``control``: what reading back has to give."""
    escapes = "len(regexp_extract_all({0}, '<\\\\*\\|'))"
    said = "replace(replace(role, '\\', '\\\\'), chr(10), '\\n')"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{control}'), (-1, 1, 'assistant', '{control}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({said}) + {escapes.format(said)} + length(text) + {escapes.format("text")} + {len(START) + 1 + len(END)}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
