"""Merkle manifest of a dataset: a subtree a language, a root over all, and a proof of inclusion for every row.

A row's leaf is the SHA-256 of its fields, each with its length; leaves of a language ascend by doc_id.  Every two
consecutive nodes (the last one alone, if one is left) become the hash of their hexadecimal digests, until one remains.

Blocks of ``2 ** levels`` neighbouring nodes are reduced by executors, one small group each, and their roots again, until
no more than ``top`` nodes are left.  The driver builds what is above them and broadcasts the path from each of these
nodes to the root (``top`` paths at most, whatever the rows); executors then finish every row's proof inside its block
and fold it.  Where there are more languages than ``top``, their roots are ranked and reduced in blocks, too.

Defined results for odd input: null fields are told apart from empty ones; a null language is a language of its own and
comes first; a null doc_id sorts first; rows that share an id go by their leaf, and repeated rows are leaves of their own; a
language with one row has that leaf as its root; an empty table has no rows and no root; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.oracles import crc32
from tidewater.llm.places import placed
from tidewater.llm.text import only

LEVELS = 10
TOP = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = pa.list_(pa.string())


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(**instead: Column) -> Column:
    """The leaf of a row; ``instead`` gives other columns for fields."""
    fields = [instead.get(c, F.col(c)).cast("string") for c in FIELDS]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in fields]), 256)


def reduced(nodes: list[str], levels: int | None = None) -> list[list[str]]:
    """The levels over ``nodes``, from below: ``levels`` of them, or as many as leave one node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def path(tree: list[list[str]], i: int) -> list[str]:
    """Siblings of node ``i`` by level, after L or R for their side; a node without one has ``-``."""
    out = []
    for level in tree[:-1]:
        j = i ^ 1
        out.append("-" if j >= len(level) else ("L" if j < i else "R") + level[j])
        i >>= 1
    return out


def folded(node: str, proof: list[str]) -> str:
    """The root that ``node`` leads to by ``proof``."""
    for s in proof:
        node = digest(node) if s == "-" else digest(s[1:], node) if s[0] == "L" else digest(node, s[1:])
    return node


@dataclass
class Paths:
    """From nodes to the root: held by the driver if they are few, else a table (tree, at, path, subroot)."""

    root: str
    few: dict[tuple[str, int], tuple[list[str], str]] | None = None
    many: DataFrame | None = None


def block(size: int, levels: int) -> int | None:
    """Levels of a block in a tree of ``size`` nodes: those that fit, if the tree goes on above it."""
    return levels if size > 1 << levels else None


NODES = "tree string, at long, whole long, node string"


def roots_of_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        size = rows["whole"][0].as_py()
        top = reduced(rows["node"].to_pylist(), block(size, levels))[-1]
        return pa.table({"tree": rows["tree"][:1], "at": pa.array([rows["at"][0].as_py() >> levels], pa.int64()), "whole": pa.array([-(-size >> levels)], pa.int64()), "node": pa.array(top)})

    return nodes.select("tree", "at", "whole", "node").groupBy("tree", F.shiftright("at", levels)).applyInArrow(run, NODES)


def down(nodes: DataFrame, levels: int, above: Paths, schema: str, emit: Callable[[pa.Table, list[list[str]], str], pa.Table]) -> DataFrame:
    """``emit`` for every block, with the whole path of each of its nodes and the subroot."""

    def done(rows: pa.Table, rest: list[str], subroot: str) -> pa.Table:
        rows = rows.sort_by("at")
        tree = reduced(rows["node"].to_pylist(), block(rows["whole"][0].as_py(), levels))
        return emit(rows, [path(tree, i) + rest for i in range(rows.num_rows)], subroot)

    blocks = nodes.groupBy("tree", F.shiftright("at", levels).alias("block"))
    if above.few is not None:
        sent = nodes.sparkSession.sparkContext.broadcast(above.few)
        return blocks.applyInArrow(lambda rows: done(rows, *sent.value[rows["tree"][0].as_py(), rows["at"][0].as_py() >> levels]), schema)
    paths = above.many.groupBy("tree", F.col("at").alias("block"))
    return blocks.cogroup(paths).applyInArrow(lambda rows, up: done(rows, up["path"][0].as_py(), up["subroot"][0].as_py()), schema)


def climb(nodes: DataFrame, levels: int, top: int, roots: bool = False) -> Paths:
    """Paths from ``nodes`` (tree, at, whole, node; written) to the root.  ``roots``: they are the subroots themselves."""
    if nodes.count() <= top:
        held: dict[str, list] = {}
        for r in sorted(nodes.collect(), key=lambda r: (r.tree.encode(), r.at)):
            held.setdefault(r.tree, []).append(r.node)
        trees = {t: reduced(x) for t, x in held.items()}
        over = reduced([t[-1][0] for t in trees.values()])
        few = {(t, i): (path(tree, i) + path(over, k), tree[-1][0]) for k, (t, tree) in enumerate(trees.items()) for i in range(len(tree[0]))}
        return Paths(over[-1][0], few)
    if roots or not nodes.filter("whole > 1").isEmpty():
        above = climb(scratch.written(roots_of_blocks(nodes, levels), "manifest-blocks"), levels, top, roots)

        def emit(rows: pa.Table, paths: list[list[str]], subroot: str) -> pa.Table:
            return pa.table({"tree": rows["tree"], "at": rows["at"], "path": pa.array(paths, PROOF), "subroot": pa.repeat(subroot, rows.num_rows)})

        return Paths(above.root, many=scratch.written(down(nodes, levels, above, "tree string, at long, path array<string>, subroot string", emit), "manifest-paths"))
    # More trees than the top takes: their roots are the nodes of one tree more.
    ranked = scratch.written(placed(nodes.select(F.col("tree").alias("of"), "node"), "manifest-roots", ["of"], F.lit(1)), "manifest-ranked")
    above = climb(ranked.select(F.lit("").alias("tree"), "at", "whole", "node"), levels, top, True)
    met = ranked.select("of", F.col("at").alias("rank"), "node").join(above.many, F.col("rank") == F.col("at"))
    return Paths(above.root, many=scratch.written(met.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("at"), "path", F.col("node").alias("subroot")), "manifest-paths"))


def proofs(docs: DataFrame, claim: Column | None = None, levels: int = LEVELS, top: int = TOP) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, ``proof`` (siblings from the leaf to the root, after their side) and folded_root.

    ``claim`` is the leaf that is to be folded with a row's proof, from a copy of the row, say; by default its own.
    """
    rows = only(docs, *FIELDS)
    leaves = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), leaf().alias("node"), (leaf() if claim is None else claim).alias("claim"))
    leaves = scratch.written(leaves.withColumn("uid", F.monotonically_increasing_id()), "manifest-leaves")
    leaves = scratch.written(placed(leaves, "manifest-ranges", ["tree", "doc_id", "node", "uid"], F.lit(1), "tree"), "manifest-ranked")
    schema = "doc_id long, lang string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    if leaves.isEmpty():
        return leaves.sparkSession.createDataFrame([], schema)
    above = climb(scratch.written(roots_of_blocks(leaves, levels), "manifest-blocks"), levels, top)
    root = above.root

    def emit(rows: pa.Table, paths: list[list[str]], subroot: str) -> pa.Table:
        n = rows.num_rows
        back = [folded(c, p) for c, p in zip(rows["claim"].to_pylist(), paths, strict=True)]
        return pa.table([rows["doc_id"], rows["lang"], rows["node"], pa.repeat(subroot, n), pa.repeat(root, n), pa.array(paths, PROOF), pa.array(back)], ["doc_id", "lang", "leaf", "subroot", "root", "proof", "folded_root"])

    return down(leaves, levels, above, schema, emit)


def tampered() -> Column:
    """The leaf of a row whose n_chars has become one more where 7 divides the CRC-32 of its id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(hit, leaf(n_chars=F.col("n_chars") + 1)).otherwise(leaf())


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: proofs held against tampered rows."""
    out = proofs(docs, tampered())
    siblings = F.array_join(F.transform("proof", lambda s: F.substring(s, 2, 64)), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf(n_chars: str) -> str:
    parts = [f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
    CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claim FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
low AS (
  SELECT tree, 0 AS lv, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM ranked
  UNION ALL
  SELECT tree, max(lv) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, i // 2),
subs AS (SELECT tree, lv AS top, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lv, i, h, n FROM subs
  UNION ALL
  SELECT max(lv) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY i // 2),
nodes AS (
  SELECT low.tree, low.lv, low.i, low.h FROM low WHERE n > 1
  UNION ALL
  SELECT subs.tree, subs.top + high.lv, high.i, high.h FROM subs, high),
walk AS (
  SELECT doc_id, tree, leaf, i, 0 AS lv, claim AS f, '' AS proof FROM ranked
  UNION ALL
  SELECT w.doc_id, w.tree, w.leaf, CASE WHEN w.lv + 1 = s.top THEN s.i ELSE w.i // 2 END, w.lv + 1,
    CASE WHEN x.h IS NULL THEN sha256(w.f) WHEN w.i % 2 = 1 THEN sha256(x.h || w.f) ELSE sha256(w.f || x.h) END, w.proof || coalesce(x.h, '')
  FROM (SELECT walk.*, CASE WHEN lv = 0 AND subs.top = 0 THEN subs.i ELSE walk.i END AS j FROM walk JOIN subs USING (tree)) q
  JOIN subs s ON q.tree = s.tree
  CROSS JOIN LATERAL (SELECT q.doc_id, q.tree, q.leaf, q.j AS i, q.lv, q.f, q.proof) w
  LEFT JOIN nodes x ON x.tree = w.tree AND x.lv = w.lv AND x.i = xor(w.i, 1)
  WHERE w.lv < s.top + (SELECT max(lv) FROM high))
SELECT walk.doc_id, walk.leaf, s.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(walk.proof) AS proof_sha256, walk.f AS folded_root,
  walk.f = (SELECT h FROM high WHERE n = 1) AS verified
FROM walk JOIN subs s ON walk.tree = s.tree WHERE walk.lv = s.top + (SELECT max(lv) FROM high)
"""
