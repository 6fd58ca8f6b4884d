"""Line dedup by content-defined chunks of lines, in DataFrame expressions only.

The hash of the last ``SPAN`` line hashes decides after which lines a chunk ends, so that a line put in or taken out
moves the boundaries next to it only.  Chunks of two lines or more are grouped by MD5 over all documents; the first one,
by doc_id and line, stays, and those whose bytes equal the first one's go.

Digests alone are grouped, with partial sums.  A bitmap of ``2 ** BITS`` bits, set for the digests that come twice, goes to
the scan; only chunks that it lets through, repeated ones and the few that share a bit with one, are shuffled with their
bytes, to meet their keeper's.  The bitmap has one size whatever the corpus; if it fills up, more bytes move, and the
results are the same.  Both joins are plain equi-joins on the digest, which Spark splits where one digest has very many
rows.  They are asked to sort and merge at every size, as what repeats grows with the corpus.

A row is known by its doc_id and its text's MD5 (``row``), so that rows that share an id but not a text are told apart.

Defined results for odd input: a null text is empty; a text of one line has no chunk that could go; chunks without a
word stay; a chunk whose digest is another's by chance stays, as its bytes differ; rows equal in doc_id and text are one
occurrence; rows with one doc_id and different texts come in the order of their digests; a null doc_id ranks first;
other columns aren't read; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.text import WORD, only, whole

SPAN = 2
#: A chunk ends where the rolling hash's first hexadecimal digit is less: a quarter of all lines.
CUT_BELOW = "4"
BITS = 26


def ends(hashes: Column, span: int = SPAN) -> Column:
    """Indexes of the lines after which a chunk ends."""
    rolling = lambda h, i: F.md5(F.concat(*[F.coalesce(F.get(hashes, i - back), F.lit("")) for back in range(span - 1, 0, -1)], h))
    cut = F.transform(hashes, lambda h, i: F.when((F.substring(rolling(h, i), 1, 1) < CUT_BELOW) | (i == F.size(hashes) - 1), i))
    return F.filter(cut, lambda x: x.isNotNull())


def chunks(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, row, first_line, n_lines, chunk (its text) and digest of every chunk of two lines or more that has a word."""
    df = only(docs, "doc_id", "text").select("doc_id", F.md5(whole(F.col("text"))).alias("row"), F.split(whole(F.col("text")), "\n").alias("_l"))
    df = df.withColumn("_h", F.transform("_l", lambda x: F.md5(x)))
    df = df.withColumn("_e", ends(F.col("_h"), span))
    first = lambda i: F.coalesce(F.get("_e", i - 1) + 1, F.lit(0))
    df = df.withColumn("_c", F.transform("_e", lambda e, i: F.struct(first(i).alias("first_line"), (e - first(i) + 1).alias("n_lines"))))
    df = df.withColumn("_c", F.filter("_c", lambda c: c["n_lines"] >= 2))
    df = df.withColumn("_c", F.transform("_c", lambda c: F.struct(c["first_line"].alias("first_line"), c["n_lines"].alias("n_lines"), F.array_join(F.slice("_l", c["first_line"] + 1, c["n_lines"]), "\n").alias("chunk"))))
    # The outer form, as the plain one would have Spark test the array, computed anew, before the scan's output goes on.
    df = df.select("doc_id", "row", F.explode_outer("_c").alias("_c")).filter(F.col("_c").isNotNull()).select("doc_id", "row", F.col("_c.first_line").cast("long").alias("first_line"), F.col("_c.n_lines").cast("long").alias("n_lines"), F.col("_c.chunk").alias("chunk"))
    return df.filter(F.col("chunk").rlike(WORD)).withColumn("digest", F.unhex(F.md5("chunk")))


def slot(digest: Column, bits: int) -> Column:
    """The digest's bit, from 1 on."""
    return F.shiftrightunsigned(F.xxhash64(digest), 64 - bits) + 1


def let_through(each: DataFrame, digests: DataFrame, bits: int) -> DataFrame:
    """Rows of ``each`` whose digest's bit is set for one of ``digests``' (column d)."""
    at = slot(F.col("d"), bits)
    known = digests.groupBy(F.bitmap_bucket_number(at).alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_m"))
    each = each.withColumn("_p", slot(F.col("digest"), bits))
    # 2 ** (bits - 15) rows of 4 KB at most.
    each = each.join(F.broadcast(known), F.bitmap_bucket_number("_p") == F.col("_b"))
    bit = F.bitmap_bit_position("_p").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_m"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return each.filter(F.floor(byte / F.pow(F.lit(2.0), bit.bitwiseAND(7))).cast("int").bitwiseAND(1) == 1).drop("_p", "_b", "_m")


def removals(docs: DataFrame, span: int = SPAN, bits: int = BITS) -> DataFrame:
    """doc_id, row, first_line, n_lines, n_chars of every chunk that goes; keeper_doc_id, keeper_row and keeper_line of the one that stays."""
    each = chunks(docs, span)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row", "first_line")
    twice = each.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("keeper")).filter("n > 1").select(F.col("digest").alias("d"), "keeper")
    # Written by itself, so that the join with it is a plain one, which Spark splits where a digest is hot.
    twice = scratch.written(twice, "chunk-keepers")
    some = let_through(each, twice, bits)
    met = scratch.written(some.join(twice.hint("merge"), F.col("digest") == F.col("d")).select("doc_id", "row", "first_line", "n_lines", "chunk", "digest", "keeper"), "line-chunks")
    first = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("row") == F.col("keeper.row")) & (F.col("first_line") == F.col("keeper.first_line"))
    kept = met.filter(first).groupBy("digest").agg(F.min("chunk").alias("kept")).select(F.col("digest").alias("d"), "kept")
    out = met.filter(~first).join(kept.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("chunk") == F.col("kept")))
    keeper = [F.col("keeper.doc_id").alias("keeper_doc_id"), F.col("keeper.row").alias("keeper_row"), F.col("keeper.first_line").alias("keeper_line")]
    return out.select("doc_id", "row", "first_line", "n_lines", F.length("chunk").cast("long").alias("n_chars"), *keeper)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """doc_id and text of ``docs`` without the removed chunks."""
    spans = gone.groupBy("doc_id", "row").agg(F.collect_set(F.struct("first_line", "n_lines")).alias("gone")).withColumnsRenamed({"doc_id": "id", "row": "r"})
    df = only(docs, "doc_id", "text").withColumn("row", F.md5(whole(F.col("text"))))
    df = df.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("r")), "left")
    dropped = F.flatten(F.transform("gone", lambda g: F.sequence(g["first_line"], g["first_line"] + g["n_lines"] - 1)))
    lines = F.split(whole(F.col("text")), "\n")
    numbered = F.transform(lines, lambda x, i: F.struct(i.cast("long").alias("i"), x.alias("x")))
    left = F.array_join(F.transform(F.filter(numbered, lambda s: ~F.array_contains(F.col("dropped"), s["i"])), lambda s: s["x"]), "\n")
    return df.withColumn("dropped", F.coalesce(dropped, F.array().cast("array<bigint>"))).select("doc_id", F.when(F.size("dropped") == 0, whole(F.col("text"))).otherwise(left).alias("text"))


ORACLE = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS row FROM documents),
lines AS (
  SELECT doc_id, row, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS i
  FROM docs),
marked AS (
  SELECT doc_id, row, i, line,
    CASE WHEN substr(md5(coalesce(lag(md5(line)) OVER w, '') || md5(line)), 1, 1) < '{CUT_BELOW}' THEN 1 ELSE 0 END AS cut
  FROM lines WINDOW w AS (PARTITION BY doc_id, row ORDER BY i)),
numbered AS (
  SELECT doc_id, row, i, line, coalesce(sum(cut) OVER (PARTITION BY doc_id, row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM marked),
chunks AS (
  SELECT doc_id, row, min(i) AS first_line, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY doc_id, row, c
  HAVING count(*) >= 2),
ranked AS (
  SELECT *, row_number() OVER w AS r, first_value(doc_id) OVER w AS keeper_doc_id, first_value(first_line) OVER w AS keeper_line
  FROM chunks WHERE regexp_matches(chunk, '[^\\x20\\x09-\\x0D]') WINDOW w AS (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, row, first_line))
SELECT doc_id, CAST(first_line AS BIGINT) AS first_line, CAST(n_lines AS BIGINT) AS n_lines, CAST(length(chunk) AS BIGINT) AS n_chars, keeper_doc_id, CAST(keeper_line AS BIGINT) AS keeper_line
FROM ranked WHERE r > 1
"""
