"""MinHash near-duplicates by improved consistent weighted sampling over TF-IDF shingles of five words.

Weights.  A shingle weighs its count in the text times an IDF factor.  The factor is 1 for shingles in fewer than
``COMMON`` of the documents and falls with log(N / df) to one half above that, in quarter powers of two; so only
shingles above a fixed share of the corpus have to be known everywhere, and their number is at most the mean number of
shingles of a document over ``COMMON``, whatever the size of the corpus.

Sampling.  For every sample d, a shingle draws r, c ~ Gamma(2, 1) and b ~ U(0, 1); with t = floor(ln w / r + b) and
ln y = r (t - b), the least ln a = ln c - ln y - r is the text's sample.  The draws come from a fixed pool of ``POOL``
triples at the index hash(shingle, d), so a sample is a table look-up; equal pool indexes are told apart by shingle.

Candidates.  Samples are banded; texts that share a band are a bucket.  A bucket first compares its members with two of
them, the one that shares most bands with others and the one of least key, so that large groups of copies become one
component by work that is linear in the bucket.  For up to ``TURNS`` turns, members that stand for the components left in a bucket
are then compared with one that stands for the largest, linear as well.  Buckets that then still hold several components are finished exactly:
their texts are joined on prefixes of shingles, rarest first (:func:`unmet`), which loses no pair of ``SIMILARITY``, and
pairs within a component, which could change nothing, aren't made.

Verification.  A pair is linked if its weighted Jaccard similarity, from the whole multisets of shingles, is at least
``SIMILARITY``, with the TF-IDF weights or with counts alone: thousands of copies make their own shingles common, and
must not hide themselves by that.  Components of links are the classes.

Exact copies are one node before all this.

Defined results for odd input: a null text is empty; texts without words are near copies only of equal texts; texts
with fewer than five words have one shingle; repeated rows and ids are copies like others; null ids are kept; an empty
table has no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import scratch, shingles
from tidewater.llm.components import components
from tidewater.llm.text import only, whole

K = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
COMMON = 0.01
POOL = 1 << 16
SLOT_BITS = 19
LEVELS = 4  # weights are 2 ** (level / LEVELS)
SEED = 7
TURNS = 3


@lru_cache(256)
def ranks(level: int) -> np.ndarray:
    """ln a of every draw of the pool for weight 2 ** (level / LEVELS), as ordered 32-bit values in the high half."""
    g = np.random.Generator(np.random.PCG64(SEED))
    r, c, b = g.gamma(2.0, size=POOL), g.gamma(2.0, size=POOL), g.random(POOL)
    t = np.floor(level / LEVELS * np.log(2.0) / r + b)
    ln_a = np.log(c) - r * (t - b) - r
    return (np.clip((ln_a + 64.0) / 128.0, 0, 1) * (2**32 - 1)).astype(np.uint64) << np.uint64(32)


def levels(tf: np.ndarray, s: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Weight levels of shingles by count and, for common ones, by IDF."""
    out = np.rint(LEVELS * np.log2(tf)).astype(np.int64)
    known, down = common
    if len(known):
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        out -= np.where(known[at] == s, down[at], 0)
    return out


def counted(s: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, in ascending order, their counts, and how many each text has."""
    # By value, then by text, which is a radix sort of narrow numbers: half the time of lexsort.
    doc = np.repeat(np.arange(len(many), dtype=np.min_scalar_type(len(many))), many)
    order = np.argsort(s)
    order = order[np.argsort(doc[order], kind="stable")]
    s, doc = s[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return s[at], np.diff(np.append(at, len(s))), np.bincount(doc[at], minlength=len(many))


def signatures(s: np.ndarray, lv: np.ndarray, many: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band for each text that has shingles; rows of texts without any stay 0."""
    out = np.zeros((len(many), BANDS), np.uint64)
    some = np.flatnonzero(many)
    if not len(some):
        return out
    starts = (np.cumsum(many) - many)[some]
    low, odd = s & np.uint64(0xFFFFFFFF), np.flatnonzero(lv)
    kinds = [(level, odd[lv[odd] == level]) for level in np.unique(lv[odd]).tolist()]
    plain = ranks(0)
    for band in range(BANDS):
        h = np.full(len(some), band, np.uint64)
        for row in range(ROWS):
            factor = shingles.mixed(np.array([band * ROWS + row + 1], np.uint64))[0] | np.uint64(1)
            at = (s * factor) >> np.uint64(48)
            key = plain[at]
            for level, own in kinds:
                key[own] = ranks(level)[at[own]]
            h = shingles.mixed(h + np.minimum.reduceat(key | low, starts))
        out[some, band] = h
    return out


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least COMMON of the documents, and how far the IDF lowers their levels.

    Counts are exact, however the rows are dealt out: a first pass counts documents by slots of hashes, each of which has
    at least the count of any of its shingles, and a second one counts the shingles of slots that reach the bound.
    """
    spark = texts.sparkSession

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, n = 0, np.zeros(1 << SLOT_BITS, np.int64)
        for batch in pieces(batches):
            s = counted(*shingles.of_texts(batch.column(0).to_pylist(), K))[0]
            n += np.bincount((s >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(n))
            docs += batch.num_rows
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([None, *at.tolist()], pa.int64()), pa.array([docs, *n[at].tolist()], pa.int64())], ["s", "n"])
        shingles.forget()

    sums = scratch.written(texts.mapInArrow(slots, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")), "slots")
    total = sums.filter("s is null").select(F.sum("n")).first()[0] or 0
    enough = (F.col("n") >= COMMON * total) & (F.col("n") >= 8) & F.col("s").isNotNull()
    # No more rows than there are slots.
    hot = np.zeros(1 << SLOT_BITS, bool)
    hot[sums.filter(enough).select("s").toPandas()["s"].to_numpy(np.int64)] = True
    hot = spark.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(held: list[np.ndarray]) -> pa.RecordBatch:
            s, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(n, pa.int64())], ["s", "n"])

        held: list[np.ndarray] = []
        size = 0
        for batch in pieces(batches):
            s, many = shingles.of_texts(batch.column(0).to_pylist(), K)
            some = hot.value[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            of = np.repeat(np.arange(len(many)), many)[some]
            held.append(counted(s[some], np.bincount(of, minlength=len(many)))[0])
            size += len(held[-1])
            if size > 2_000_000:
                yield sent(held)
                held, size = [], 0
        if held:
            yield sent(held)
        shingles.forget()

    sums = scratch.written(texts.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")), "df")
    # No more rows than the mean number of shingles of a document over COMMON.
    rows = sums.filter(enough).toPandas()
    s, n = rows["s"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(float)
    idf = np.clip(np.log(total / np.maximum(n, 1)) / np.log(1 / COMMON), 0.5, 1.0)
    order = np.argsort(s)
    return s[order], np.rint(-LEVELS * np.log2(idf)).astype(np.int64)[order]


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], common: tuple[np.ndarray, np.ndarray]) -> float:
    """The greater of the Jaccard similarities by TF-IDF weights and by counts, of two sorted multisets."""
    (s, n), (u, m) = a, b
    every = np.union1d(s, u)
    if not len(every):
        return 0.0
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, s)], y[np.searchsorted(every, u)] = n, m
    idf = 2.0 ** (levels(np.ones(len(every)), every, common) / LEVELS)
    return max(float((np.minimum(x, y) * w).sum() / (np.maximum(x, y) * w).sum()) for w in (np.ones(len(every)), idf))


def labelled(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """node, band, h and component of the members of buckets of more than two."""
    of = shared.filter("n > 2").select("node", "band", "h").join(classes.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left")
    return scratch.written(of.select("node", "band", "h", F.coalesce("component", "node").alias("component")), "labelled")


def regrouped(shared: DataFrame, classes: DataFrame, turn: int) -> DataFrame:
    """Pairs a, b of members of different components of a bucket: one of each component with one of the bucket's.

    Who stands for a component changes with ``turn``.  There are no more pairs than components in buckets.
    """
    own = labelled(shared, classes).groupBy("band", "h", "component").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("x"), F.count("*").alias("size"))
    lead = own.groupBy("band", "h").agg(F.max(F.struct("size", "component", "x")).alias("l"), F.count("*").alias("k")).filter("k > 1").select(F.col("band").alias("b2"), F.col("h").alias("h2"), "l")
    both = own.join(scratch.written(lead, "turn-leaders"), (F.col("band") == F.col("b2")) & (F.col("h") == F.col("h2"))).filter("component != l.component")
    return both.select(F.least("x", "l.x").alias("a"), F.greatest("x", "l.x").alias("b")).distinct()


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``classes`` joined by more links."""
    def at(rows: DataFrame, c: str) -> DataFrame:
        named = rows.join(classes.select(F.col("node").alias("m"), "component"), F.col(c) == F.col("m"), "left")
        return named.withColumn(c, F.coalesce("component", c)).drop("m", "component")

    up = components(at(at(links.select("a", "b"), "a"), "b").filter("a != b")).select(F.col("node").alias("old"), F.col("component").alias("new"))
    nodes = classes.select("node", "component").union(up.select("old", "old")).dropDuplicates(["node"])
    return scratch.written(nodes.join(up, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")), "classes")


def unmet(sets: DataFrame, shared: DataFrame, classes: DataFrame, common: Broadcast, similarity: float) -> DataFrame:
    """Pairs a, b of texts that may be similar and that leaders left in different components, from buckets of several.

    Shingles are ordered from rare to frequent.  Similar texts have in common at least similarity / (1 + similarity) of
    their summed weights; so the first shingle that they share leaves each at least that from it on (``rest``).  The lighter
    text is found by a shorter prefix than the heavier one, so that a template in just under SIMILARITY of both is in
    neither's short one.  This holds by TF-IDF and by counts, as the order is one.
    """
    share, slack = similarity / (1 + similarity), 1 - 1e-9
    of = labelled(shared, classes)
    several = of.groupBy("band", "h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select(F.col("band").alias("b2"), F.col("h").alias("h2"))
    several = scratch.written(several, "several")
    left = scratch.written(of.join(several, (F.col("band") == F.col("b2")) & (F.col("h") == F.col("h2"))).select("node", "component").distinct(), "left")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for node, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s, n = multiset(x)
                w = n * 2.0 ** (levels(np.ones(len(s)), s, common.value) / LEVELS)
                columns = [s.view(np.int64), n, w, np.full(len(s), n.sum()), np.full(len(s), w.sum())]
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(node, pa.binary()), len(s)), *map(pa.array, columns)], ["node", "s", "n", "w", "all_n", "all_w"])

    own = sets.join(left.select(F.col("node").alias("m")), F.col("node") == F.col("m")).select("node", "shingles")
    own = scratch.written(own.mapInArrow(exploded, "node binary, s long, n double, w double, all_n double, all_w double"), "left-shingles")
    df = scratch.written(own.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1").withColumnRenamed("s", "s2"), "left-df")
    # Shingles of one text only come first in the order, and none shares them.  A window is a text.
    after = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = own.join(df, F.col("s") == F.col("s2")).select("node", "s", "all_n", "all_w", F.sum("n").over(after).alias("rest_n"), F.sum("w").over(after).alias("rest_w"))

    def within(least: float) -> Column:
        return (F.col("rest_n") >= slack * least * F.col("all_n")) | (F.col("rest_w") >= slack * least * F.col("all_w"))

    prefix = ranked.filter(within(similarity)).withColumn("light", within(2 * share))
    prefix = scratch.written(prefix.join(left.withColumnRenamed("node", "m"), F.col("node") == F.col("m")).drop("m"), "prefixes")

    def side(x: str, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "s", "component", "all_n", "all_w", "rest_n", "rest_w")])

    def enough(k: str) -> Column:
        return F.least(f"rest_{k}_a", f"rest_{k}_b") >= slack * share * (F.col(f"all_{k}_a") + F.col(f"all_{k}_b"))

    light, every = side("a", prefix.filter("light")), side("b", prefix)
    # Components meet at a shingle first, so that the many texts of one never meet each other; a text then meets another
    # component only if it may be similar to one of its texts.
    bounds = (("all_n", F.min), ("all_w", F.min), ("rest_n", F.max), ("rest_w", F.max))
    most = {x: rows.groupBy(f"s_{x}", f"component_{x}").agg(*[f(f"{c}_{x}").alias(f"{c}_{x}") for c, f in bounds], *[F.max(f"all_{k}_{x}").alias(f"most_{k}_{x}") for k in "nw"]) for x, rows in (("a", light), ("b", every))}
    met = most["a"].join(most["b"], (F.col("s_a") == F.col("s_b")) & (F.col("component_a") != F.col("component_b")) & (enough("n") | enough("w")))
    columns = [F.col(f"{c}_b").alias(f"b_{c}") for c in ("all_n", "all_w", "rest_n", "rest_w", "most_n", "most_w")]
    meet = scratch.written(met.select(F.col("s_a").alias("s"), F.col("component_a").alias("ca"), F.col("component_b").alias("cb"), *columns), "meetings")
    able = [(F.least(f"rest_{k}_a", f"b_rest_{k}") >= slack * share * (F.col(f"all_{k}_a") + F.col(f"b_all_{k}"))) & (F.col(f"all_{k}_a") <= F.col(f"b_most_{k}")) for k in "nw"]
    both = meet.join(light, (F.col("s") == F.col("s_a")) & (F.col("ca") == F.col("component_a")) & (able[0] | able[1]))
    good = [enough(k) & (F.col(f"all_{k}_a") <= F.col(f"all_{k}_b")) for k in "nw"]
    both = both.join(every, (F.col("s") == F.col("s_b")) & (F.col("cb") == F.col("component_b")) & (good[0] | good[1]))
    return both.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def multiset(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = len(x) // 12
    return np.frombuffer(x[: 8 * k], np.uint64), np.frombuffer(x[8 * k :], np.uint32).astype(float)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of its near copies; its own if it has none), _uid and first (stays, if one has to)."""
    spark = docs.sparkSession
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    common = common_shingles(texts.select("text"))
    common = spark.sparkContext.broadcast(common)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s, n, many = counted(*shingles.of_texts(batch.column(2).to_pylist(), K))
            bands = signatures(s, levels(n, s, common.value), many).view(np.int64)
            lists = [None if not k else v.tolist() for k, v in zip(many, bands, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "node", "bands"])
        shingles.forget()

    keyed = texts.select("doc_id", F.unhex(F.md5("text")).alias("node"), "text")
    signed = scratch.written(keyed.mapInArrow(sign, "doc_id long, node binary, bands array<long>").withColumn("_uid", F.monotonically_increasing_id()), "signed")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"))

    in_band = nodes.select("node", "least", F.posexplode("bands").alias("band", "h"))
    full = in_band.groupBy("band", "h").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("band").alias("b2"), F.col("h").alias("h2"), "n")
    # Written by itself, so that the join with it is a plain one, which Spark splits where a bucket is hot.
    full = scratch.written(full, "full")
    shared = scratch.written(in_band.join(full, (F.col("band") == F.col("b2")) & (F.col("h") == F.col("h2"))).select("node", "least", "band", "h", "n"), "buckets")
    fame = shared.groupBy("node").agg(F.sum("n").alias("fame")).withColumnRenamed("node", "who")
    famed = shared.join(fame, F.col("node") == F.col("who"))
    lead = famed.groupBy("band", "h").agg(F.max(F.struct("fame", "node")).alias("f"), F.min("node").alias("low")).select(F.col("band").alias("b3"), F.col("h").alias("h3"), F.array("f.node", "low").alias("leads"))
    lead = scratch.written(lead, "leaders")
    pairs = shared.join(lead, (F.col("band") == F.col("b3")) & (F.col("h") == F.col("h3"))).select(F.col("node").alias("x"), F.explode("leads").alias("y")).filter("x != y")
    pairs = scratch.written(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")

    def multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            s, n, many = counted(*shingles.of_texts(batch.column(1).to_pylist(), K))
            ends = np.cumsum(many)
            sets = [s[e - k : e].tobytes() + n[e - k : e].astype(np.uint32).tobytes() for e, k in zip(ends, many, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])
        shingles.forget()

    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    wanted = wanted.join(nodes.select("node", "least"), F.col("w") == F.col("node")).select("w", "least")
    found = keyed.join(wanted, (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("least"))).select("node", "text")
    sets = scratch.written(found.mapInArrow(multisets, "node binary, shingles binary"), "multisets")
    if signed.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["node"])
    left, right = sets.select(F.col("node").alias("na"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("nb"), F.col("shingles").alias("sb"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(multiset(x), multiset(y), common.value) >= similarity for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def linked(some: DataFrame) -> DataFrame:
        both = some.join(left, F.col("a") == F.col("na")).join(right, F.col("b") == F.col("nb")).select("a", "b", "sa", "sb")
        return scratch.written(both.mapInArrow(verify, "a binary, b binary"), "links")

    links = linked(pairs)
    classes = components(links)
    for turn in range(TURNS):
        met = scratch.written(regrouped(shared, classes, turn), "met").join(pairs, ["a", "b"], "left_anti")
        more = linked(met)
        if not more.limit(1).count():
            break
        classes = merged(classes, more)
    more = linked(scratch.written(unmet(sets, shared, classes, common, similarity).join(pairs, ["a", "b"], "left_anti"), "unmet"))
    if more.limit(1).count():
        classes = merged(classes, more)
    named = nodes.select("node", "least").join(classes.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left")
    named = named.select("node", "least", F.coalesce("component", "node").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("class_id"), F.min(F.struct(F.col("least").isNull(), "least", "node"))["node"].alias("keeper"))
    of = named.join(ids.withColumnRenamed("component", "c"), F.col("component") == F.col("c")).select(F.col("node").alias("m"), "class_id", "keeper")
    out = signed.select("doc_id", "node", "_uid").join(of, F.col("node") == F.col("m"))
    return out.select("doc_id", "class_id", "node", "keeper", "_uid")


def stage(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The first document of every class, in the columns of ``docs``."""
    classes = near_duplicates(docs, similarity)
    stay = classes.filter(F.col("node") == F.col("keeper")).groupBy("node").agg(F.min("doc_id").alias("least"))
    stay = scratch.written(stay, "stay")
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), F.unhex(F.md5(whole(docs["text"]))).alias("_key"))
    kept = rows.join(stay, (F.col("_key") == F.col("node")) & F.col("_row")["doc_id"].cast("long").eqNullSafe(F.col("least")))
    if docs.groupBy("doc_id").count().filter("count > 1").limit(1).count():  # rows that repeat id and text
        kept = kept.dropDuplicates(["_key"])
    return kept.select(*[F.col("_row")[c].alias(c) for c in names])
