"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters, digits and underscores in lower case, and single characters of scripts without spaces
(Chinese, Japanese, Thai, Lao, Khmer, Burmese).  One pass over the corpus finds the places where ``N``
words of a text are also in a benchmark item.  The benchmark goes to that pass as bitmaps of fixed size, so that
nothing grows with it; what the bitmaps let through by chance is dropped when hits are joined by n-gram.

Seeds.  N words are taken in a row and with one word left out in their middle, on both sides, and any of one kind may meet
any of the other.  So a word replaced, put in or taken out between them doesn't break a seed: copies with every third word
replaced have seeds.  A rare n-gram, of ``RARE`` items or fewer, is a seed by itself: so many pairs a hit at most.  A common one, such as
a phrase that many items begin with, seeds a pair only where text and item share one of the item's rarest words, too.  An
alignment that passes has at least ``t`` of the item's ``w`` words, so that of any w - t + 1 of them the text has one; the
rarest ones are taken (by the number of items that have them).  No pair that could pass is lost so.

Alignment.  Around hits the pass keeps segments, which reach ``REACH`` times the words of the longest item with that n-gram, as
its class of lengths has it, to both sides.  A
local alignment has fewer gaps than it gains from matches, MATCH for each word of the item at most, so none that holds
the seed reaches further.  For each segment and each item that share a seed, words are aligned locally: MATCH a pair of
equal words, MISMATCH and GAP else.  The score is divided by that of a full copy of the item, or of ``FULL`` words if it
is longer: that much of a long item is a copy, whatever the rest.

Defined results for odd input: null and empty texts hit nothing; items of fewer than N words are found only in
documents of just those words; equal items are reported each; items that share an id are aligned each, and the best
score counts; so do rows with one doc_id, as one document with several texts; an empty benchmark or corpus has no rows;
other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import scratch, shingles
from tidewater.llm.text import only, whole

N = 4
REACH = 3
FULL = 64
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
BITS = 26
RARE = 8
#: Lengths of items, in words, by which their n-grams' reach goes; the last class is as long as the longest item.
CLASSES, CLASS_BITS = (16, 32, 64, 128, 256, 512), 24
#: Blocks of scripts that put no spaces between words.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORDS = re.compile(f"[{UNSPACED}]|[^\\W{UNSPACED}]+")


def grams(texts: list[str | None], n: int) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; the hashes of its n-grams, plain and gapped, with the text's number and the place of the first word."""
    split = [WORDS.findall((t or "").lower()) for t in texts]
    many = np.array([len(w) for w in split], np.int64)
    first, words = np.cumsum(many) - many, shingles.word_hashes([w for ws in split for w in ws])
    plain, each = shingles.of_words(words, first, many, n)
    # The words of a gapped n-gram, put side by side: those before the gap from one word further on.
    gaps = np.maximum(many - n, 0)
    at = np.arange(gaps.sum()) - np.repeat(np.cumsum(gaps) - gaps, gaps) + np.repeat(first, gaps)
    half = n // 2
    own = words[at[:, None] + np.array([*range(half), *range(half + 1, n + 1)])].ravel()
    gapped, _ = shingles.of_words(own, np.arange(len(at)) * n, np.full(len(at), n, np.int64), n)
    doc = np.concatenate([np.repeat(np.arange(len(many)), each), np.repeat(np.arange(len(many)), gaps)])
    place = np.concatenate([np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each), at - np.repeat(first, gaps)])
    return split, np.concatenate([plain, gapped]), doc, place


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """iid, g and ``words`` (of the item) for every n-gram of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split, h, doc, _ = grams(batch.column(1).to_pylist(), n)
            words = np.array([len(w) for w in split], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(h.view(np.int64)), pa.array(words[doc])], ["iid", "g", "words"])

    return items.select("iid", "item").mapInArrow(run, "iid long, g long, words long").distinct()


def item_words(items: DataFrame) -> DataFrame:
    """iid, w, ``c`` (how often the item has it) and ``words`` (of the item) for every word of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for iid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                many = Counter(WORDS.findall(text.lower()))
                n = len(many)
                yield pa.RecordBatch.from_arrays([pa.repeat(iid, n), pa.array([*many], pa.string()), pa.array([*many.values()], pa.int64()), pa.repeat(sum(many.values()), n)], ["iid", "w", "c", "words"])

    return items.select("iid", "item").mapInArrow(run, "iid long, w string, c long, words long")


def rarest_words(words: DataFrame, threshold: float) -> DataFrame:
    """iid and w: of each item its rarest words, so many that every text that may pass has one."""
    spread = words.groupBy(F.col("w").alias("w2")).agg(F.count("*").alias("items"))
    need = F.ceil(F.lit(threshold) * F.least("words", F.lit(FULL)) - 1e-9)
    before = Window.partitionBy("iid").orderBy("items", "w").rowsBetween(Window.unboundedPreceding, -1)  # an item's words
    ranked = words.join(spread, F.col("w") == F.col("w2")).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    return ranked.filter(F.col("before") < F.col("words") - need + 1).select("iid", "w")


def bitmap(gram_rows: DataFrame, bits: int) -> np.ndarray:
    """2 ** bits bits, set for the n-grams' hashes."""
    # At most 2 ** (bits - 15) rows of 4 KB.
    slot = F.shiftrightunsigned("g", 64 - bits)
    rows = gram_rows.groupBy(F.bitmap_bucket_number(slot + 1).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("m")).collect()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        at = (r["b"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def reaches(gram_rows: DataFrame) -> tuple[list[int], list[np.ndarray]]:
    """How far segments reach by class of items' lengths, and bitmaps of the n-grams of items of the second class or longer, the third, ..."""
    longest = gram_rows.agg(F.max("words")).first()[0] or 0
    bounds = [c for c in CLASSES if c < longest]
    maps = [bitmap(gram_rows.filter(F.col("words") > c), CLASS_BITS) for c in bounds]
    return [REACH * c for c in [*bounds, longest]], maps


def held(known: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def hits(docs: DataFrame, known: np.ndarray, n: int, reach: tuple[list[int], list[np.ndarray]], bits: int) -> DataFrame:
    """doc_id, words (of a segment) and its hits: the n-grams that may be in items."""
    far, sent = reach[0], docs.sparkSession.sparkContext.broadcast([known, *reach[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 512):
                batch = whole_batch.slice(at, 512)
                split, h, doc, place = grams(batch.column(1).to_pylist(), n)
                found = np.flatnonzero(held(sent.value[0], h, bits))
                found = found[np.lexsort((place[found], doc[found]))]
                doc, place, h = doc[found], place[found], h[found]
                own = np.full(len(h), far[0], np.int64)
                for k, longer in enumerate(sent.value[1:], 1):
                    own[held(longer, h, CLASS_BITS)] = far[k]
                low, high = np.maximum(place - own, 0), place + n + 1 + own
                ids, texts, lists = [], [], []
                a = 0
                while a < len(h):
                    b, first, last = a + 1, int(low[a]), int(high[a])
                    while b < len(h) and doc[b] == doc[a] and low[b] <= last:
                        first, last = min(first, int(low[b])), max(last, int(high[b]))
                        b += 1
                    ids.append(int(doc[a]))
                    texts.append(" ".join(split[doc[a]][first:last]))
                    lists.append(np.unique(h[a:b].view(np.int64)).tolist())
                    a = b
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(texts, pa.string()), pa.array(lists, kind)], ["doc_id", "words", "hits"])
        shingles.forget()

    return docs.mapInArrow(run, "doc_id long, words string, hits array<long>")


def local_score(a: list[int], b: np.ndarray) -> int:
    """The best local alignment score of two sequences of word numbers, row by row."""
    step = np.arange(1, len(b) + 1) * GAP
    row, best = np.zeros(len(b) + 1, np.int64), 0
    for word in a:
        diagonal = row[:-1] + np.where(b == word, MATCH, MISMATCH)
        new = np.maximum(np.maximum(diagonal, row[1:] + GAP), 0)
        # Gaps along the row: the running maximum after taking their cost out.
        new = np.maximum.accumulate(new - step) + step
        row = np.concatenate([[0], new])
        best = max(best, int(new.max()))
    return best


def score(segment: list[str], item: list[str], threshold: float) -> float:
    """Local score over that of a full copy; 0 if it can't reach ``threshold``."""
    full = MATCH * min(len(item), FULL)
    if not full or MATCH * sum((Counter(segment) & Counter(item)).values()) < threshold * full:
        return 0.0
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    return min(1.0, local_score([number[w] for w in item], np.array([number.get(w, -1) for w in segment])) / full)


def pairs(found: DataFrame, gram_rows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """sid and iid of the segments and items that share a seed."""
    spread = gram_rows.groupBy(F.col("g").alias("g2")).agg((F.count("*") > RARE).alias("common"))
    told = scratch.written(gram_rows.join(spread, F.col("g") == F.col("g2")).select("g", "iid", "common"), "told-grams")
    each = found.select("sid", F.explode("hits").alias("g3"))
    by_rare = each.join(told.filter("not common"), F.col("g3") == F.col("g")).select("sid", "iid")
    common = told.filter("common")
    shared = common.select("g").distinct()
    some = scratch.written(each.join(shared, F.col("g3") == F.col("g")).groupBy("sid").agg(F.collect_set("g").alias("hit")), "common-hits")  # a segment's
    mine = common.groupBy(F.col("iid").alias("i2")).agg(F.collect_set("g").alias("has"))  # an item's
    rarest = rarest_words(item_words(items), threshold).join(mine.select("i2"), F.col("iid") == F.col("i2"), "left_semi")
    said = found.join(some.select(F.col("sid").alias("s2")), F.col("sid") == F.col("s2"), "left_semi").select("sid", F.explode(F.array_distinct(F.split("words", " "))).alias("w2"))
    met = said.join(rarest, F.col("w2") == F.col("w")).select("sid", "iid").distinct()
    met = met.join(some.select(F.col("sid").alias("s2"), "hit"), F.col("sid") == F.col("s2")).join(mine, F.col("iid") == F.col("i2"))
    return by_rare.unionByName(met.filter(F.arrays_overlap("hit", "has")).select("sid", "iid")).distinct()


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = N, bits: int = BITS) -> DataFrame:
    """doc_id, item_id and score (rounded to 6 digits) of every document and item that align at ``threshold`` or more."""
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    items = only(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), whole(F.col("text")).alias("item"))
    items = scratch.written(items.withColumn("iid", F.monotonically_increasing_id()), "items")
    gram_rows = scratch.written(item_grams(items, n), "item-grams")
    found = hits(docs, bitmap(gram_rows, bits), n, reaches(gram_rows), bits)
    found = scratch.written(found.withColumn("sid", F.monotonically_increasing_id()), "segments")
    seeded = pairs(found, gram_rows, items, threshold).select(F.col("sid").alias("s2"), F.col("iid").alias("i2"))
    both = found.join(seeded, F.col("sid") == F.col("s2")).join(items, F.col("i2") == F.col("iid")).select("doc_id", "item_id", "words", "item")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [round(score(s.split(" "), WORDS.findall(t.lower()), threshold), 6) for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.float64())], ["doc_id", "item_id", "score"])

    scored = both.mapInArrow(align, "doc_id long, item_id long, score double").filter(F.col("score") >= threshold)
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def stage(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents of ``docs`` that hold no item, in its columns."""
    bad = scratch.written(contaminated(docs, items, threshold).select(F.col("doc_id").alias("_bad_id")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]), "left_anti")
