"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame expressions only.

A source's target is its share of ``share`` times all words by weight, never above ``most`` times its own words; what
is over goes to the other sources by weight, until none is above its limit.  That fixed point is ``min(most * size,
level * weight)`` for one level, which a running sum over the sources, sorted by limit a weight, gives at once.

A document's key is -ln(u) / w with u from a seeded hash of its id and text and w its quality weight; so documents
without an id, or with one and the same, have keys of their own.  Within a source, documents
come in ascending order of their keys.  A target of k whole epochs and a rest takes every document k times and then the
first documents by key, up to the rest; the document in which the rest ends is taken for what is left.

The prefix sum has two levels, so that a source with a third of all rows is no task's load: keys fall into ranges, of
which each is 2 ** (1 / RANGES) times as wide as the one before; word counts are summed by (source, range), the range sums
are prefix-summed, and then each range is sorted by itself.  A weight moves all keys by a factor, and so shifts them along
such ranges; for any weights, a range has at most ln 2 / (e RANGES) of a source's documents, 1 in 4000.  A range of keys
below 2 ** -LOW or above 2 ** LOW ends there; next to no key does.  Only rows of equal id and equal text have equal keys.

Sizes, weights and keys are found in one pass over the texts and written.

Defined results for odd input: a null text has no word; a null source is a source of its own and the last; an empty
document takes nothing; documents with equal id and text are told apart by running sums only, so that reruns give the
same rows.  A source without words has target 0.  Columns other than id, text, source and the weight aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.quality import SYMBOLS
from tidewater.llm.text import WORD, n_of, n_words, whole, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
RANGES, LOW = 1024, 64


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size -> the same with ``target``.  One row per source, so that single-partition windows stay small."""
    name = F.coalesce(F.encode("source", "UTF-8"), F.lit(b""))
    by_name = Window.orderBy(F.col("source").isNull(), name)
    df = sizes.withColumn("_i", (F.row_number().over(by_name) - 1) % len(weights))
    df = df.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_i") + 1))
    df = df.withColumn("_cap", (most * F.col("source_size")).cast("double"))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), name)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    df = df.withColumn("_total", share * F.sum("source_size").over(everything))
    # The level if the sources before this one are at their limits and the rest are not.
    df = df.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward))
    df = df.withColumn("_fits", F.col("_level") <= F.col("_cap") / F.col("_w"))
    df = df.withColumn("_level", F.first(F.when(F.col("_fits"), F.col("_level")), ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_level") * F.col("_w")))
    return df.select("source", "source_size", target.alias("target"))


def sampling_key(id_col: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / w, with u in (0, 1) from 52 bits of an MD5 digest of id and text."""
    digest = F.md5(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), F.lit(str(seed)), F.md5(text)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def key_range(key: Column) -> Column:
    """The number of the range of a key, ascending with it."""
    octave = F.least(F.greatest(F.log2(F.greatest(key, F.lit(1e-300))), F.lit(-LOW)), F.lit(LOW))
    return F.floor((octave + LOW) * RANGES).cast("int")


def text_weight(text: Column) -> Column:
    """A quality weight in [0.05, 1]: symbols among the characters and an open last sentence lower it."""
    text = whole(text)
    symbols = n_of(text, SYMBOLS) / F.greatest(F.length(text), F.lit(1))
    closed = F.when(text.rlike(r"[.!?][\"'”’»)]*\s*$"), 1.0).otherwise(0.5)
    return F.greatest(F.lit(0.05), (1 - 8 * symbols) * closed)


def mix(
    docs: DataFrame,
    quality_weight: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = 20240607,
    carry: Column | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (and ``carry``, if given, under the name _carry) for every row of ``docs``."""
    weight = F.coalesce(quality_weight, F.lit(1.0)).cast("double") if quality_weight is not None else F.lit(1.0)
    text = whole(docs["text"])
    cols = [docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("_tie"), sampling_key(docs["doc_id"], text, F.greatest(weight, F.lit(1e-6)), seed).alias("_key")]
    if carry is not None:
        cols.append(carry.alias("_carry"))
    df = docs.select(*cols)
    df = scratch.written(df.withColumn("_b", key_range(F.col("_key"))), "keys")
    ranges = df.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    by_range = Window.partitionBy("source").orderBy("_b")
    ranges = ranges.withColumn("_before", F.sum("_sum").over(by_range) - F.col("_sum"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, most)
    r, t = ranges.select(F.col("source").alias("_rs"), F.col("_b").alias("_rb"), "_before"), targets.select(F.col("source").alias("_ts"), "source_size", "target")
    starts = r.join(t, F.col("_rs").eqNullSafe(F.col("_ts"))).drop("_ts")
    within = Window.partitionBy("source", "_b").orderBy("_key", "doc_id", "_tie", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_upto", F.sum("size").over(within))
    df = df.join(starts, F.col("source").eqNullSafe(F.col("_rs")) & (F.col("_b") == F.col("_rb")))
    size, whole_target = F.col("size"), F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole_target / F.col("source_size"))).otherwise(0)
    rest = whole_target - epochs * F.col("source_size")
    left = rest - (F.col("_before") + F.col("_upto") - size)
    taken = epochs * size + F.greatest(F.lit(0), F.least(size, left))
    out = ["doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")]
    return df.select(*out, *(["_carry"] if carry is not None else []))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    before = F.slice(F.split(text, WORD), F.lit(1), n)  # the white space before each word
    own = F.slice(words(text), F.lit(1), n)
    return F.substring(text, F.lit(1), F.length(F.array_join(before, "")) + F.length(F.array_join(own, "")))


def stage(docs: DataFrame, seed: int = 20240607) -> DataFrame:
    """The mix in the columns of ``docs``: a row for each time a document is taken; the last, if it is taken in part, ends there."""
    names = docs.columns
    df = mix(docs, text_weight(docs["text"]), seed=seed, carry=F.struct(*[docs[c] for c in names])).filter("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    part = (F.col("taken") - (F.col("_copy") - 1) * F.col("size")).cast("int")
    text = F.when(part >= F.col("size"), F.col("_carry")["text"]).otherwise(first_words(F.col("_carry")["text"], part))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return df.select(*[new.get(c, F.col("_carry")[c]).alias(c) for c in names])


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
weighed AS (
  SELECT *, greatest(1e-6, greatest(0.05, (1 - 8 * (len(regexp_extract_all(t, '[#*$%&|<>]')) / greatest(length(t), 1))) * CASE WHEN regexp_matches(t, '[.!?]["\'\'”’»)]*\\s*$') THEN 1.0 ELSE 0.5 END)) AS w FROM docs),
keyed AS (
  SELECT *, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':20240607:' || md5(t)), 1, 13) AS BIGINT) + 0.5) / {1 << 52}) / w AS key FROM weighed),
sources AS (
  SELECT source, sum(size) AS source_size, ([{", ".join(map(str, WEIGHTS))}])[1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INT)] AS sw FROM docs GROUP BY source),
caps AS (SELECT *, {MOST}.0 * source_size AS cap, {SHARE} * sum(source_size) OVER () AS total FROM sources),
walk AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / sw, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(sw) OVER (ORDER BY cap / sw, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM caps),
level AS (SELECT arg_min(lev, cap / sw) FILTER (WHERE lev <= cap / sw) AS lev FROM walk),
targets AS (SELECT source, source_size, CAST(CASE WHEN level.lev IS NULL THEN cap ELSE least(cap, level.lev * sw) END AS DOUBLE) AS target FROM caps, level),
placed AS (
  SELECT keyed.*, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM keyed),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END AS epochs FROM targets)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + greatest(0, least(size, round(target) - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed JOIN budget ON placed.source IS NOT DISTINCT FROM budget.source
"""
