"""Substring dedup by hashing lines and paragraphs.

A text's units are its lines (what ``\\n`` parts) that have a word, and its paragraphs: runs of two such lines or more, so
that a passage is found again where its lines are broken elsewhere.  A unit is normalised (lower case, one space for white
space between words, none at its ends) and its 128-bit digest is grouped over all documents, whatever its length;
``min_words`` leaves shorter ones alone.  The earliest occurrence, by doc_id and then by position, stays and all others
go.  Offsets are code points of the original text, so that what stays can be traced to where it stood.

What a removed unit says is always said by an earlier one, which is there or is itself part of a removed one that an
even earlier one says; so the first occurrence of everything stays.

Only digests and offsets are shuffled, summed up before they are; the join that finds a digest's occurrences is a plain
equi-join, which Spark splits where one digest has very many.

A row is known by its doc_id and its text's MD5 (``row``), so that rows that share an id but not a text are told apart.

Defined results for odd input: a null text is empty and has no unit; rows equal in doc_id and text are one occurrence, so
none goes for the other; rows with one doc_id and different texts come in the order of their digests; a null doc_id
ranks first; other columns aren't read; an empty table has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import scratch
from tidewater.llm.text import WORD, only, whole

MIN_WORDS = 1
DIGEST = 16
LINE, PARAGRAPH = "line", "paragraph"


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row, kind, unit (number of its first line), n_lines, start, end, n_words and digest of every unit."""
    word = re.compile(WORD)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "row", "kind", "unit", "n_lines", "start", "end", "n_words", "digest"]

    def of_text(doc_id: int | None, row: str, text: str) -> Iterator[tuple]:
        def unit(kind: str, first: int, n: int, start: int, end: int, words: list[str]) -> tuple:
            digest = blake2b(" ".join(words).lower().encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest()
            return (doc_id, row, kind, first, n, start, end, len(words), digest)

        at, first, begin, own = 0, 0, 0, []
        for i, line in enumerate([*text.split("\n"), ""]):
            words = word.findall(line)
            if len(words) >= min_words and words:
                yield unit(LINE, i, 1, at, at + len(line), words)
            if words:
                if not own:
                    first, begin = i, at
                own += words
            elif own:
                if i - first > 1 and len(own) >= min_words:
                    yield unit(PARAGRAPH, first, i - first, begin, at - 1, own)
                own = []
            at += len(line) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [u for x in zip(*[c.to_pylist() for c in part.columns], strict=True) for u in of_text(*x)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names)

    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    docs = docs.select("doc_id", F.md5("text").alias("row"), "text")
    return docs.mapInArrow(run, "doc_id long, row string, kind string, unit long, n_lines long, start long, end long, n_words long, digest binary")


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row, kind, unit, n_lines, start, end, n_words of every unit that goes; keeper_doc_id, keeper_row, keeper_unit of the one that stays."""
    each = units(docs, min_words)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row", "unit")
    kept = each.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("keeper")).filter("n > 1")
    kept = kept.select(F.col("digest").alias("d"), *[F.col(f"keeper.{c}").alias(f"keeper_{c}") for c in ("doc_id", "row", "unit")])
    # Written by itself, so that the join with it is a plain one, which Spark splits where a digest is hot.
    kept = scratch.written(kept, "keepers")
    out = each.join(kept, F.col("digest") == F.col("d"))
    same = F.col("doc_id").eqNullSafe(F.col("keeper_doc_id")) & (F.col("row") == F.col("keeper_row")) & (F.col("unit") == F.col("keeper_unit"))
    return out.filter(~same).select("doc_id", "row", "kind", "unit", "n_lines", "start", "end", "n_words", "keeper_doc_id", "keeper_row", "keeper_unit")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """doc_id, text without its removed units (and their line feeds), and ``kept``: start and end, in the original, of the lines that stay."""
    lines = F.explode(F.sequence("unit", F.col("unit") + F.col("n_lines") - 1))
    gone = gone.select("doc_id", "row", lines.alias("line")).groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone")).withColumnsRenamed({"doc_id": "id", "row": "r"})
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5(whole(F.col("text"))).alias("row"))
    docs = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("r")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at, left, own, drop = 0, [], [], set(drop or ())
                for i, line in enumerate((text or "").split("\n")):
                    if i not in drop:
                        left.append(line)
                        own.append({"start": at, "end": at + len(line)})
                    at += len(line) + 1
                texts.append("\n".join(left))
                spans.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "text", "kept"])

    return docs.select("doc_id", "text", "gone").mapInArrow(run, "doc_id long, text string, kept array<struct<start:long,end:long>>")


ORACLE = """
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS row FROM documents),
lines AS (
  SELECT doc_id, row, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS unit
  FROM docs),
placed AS (
  SELECT doc_id, row, unit, line, sum(length(line) + 1) OVER w - length(line) - 1 AS start, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words,
    sum(CASE WHEN regexp_matches(line, '[^\\x20\\x09-\\x0D]') THEN 0 ELSE 1 END) OVER w AS block
  FROM lines WINDOW w AS (PARTITION BY doc_id, row ORDER BY unit)),
units AS (
  SELECT doc_id, row, 'line' AS kind, unit, 1 AS n_lines, start, start + length(line) AS "end", len(words) AS n_words, lower(array_to_string(words, ' ')) AS norm
  FROM placed WHERE len(words) >= 1
  UNION ALL
  SELECT doc_id, row, 'paragraph', min(unit), count(*), min(start), max(start + length(line)), sum(len(words)), string_agg(lower(array_to_string(words, ' ')), ' ' ORDER BY unit)
  FROM placed WHERE len(words) >= 1 GROUP BY doc_id, row, block HAVING count(*) > 1),
ranked AS (
  SELECT *, row_number() OVER w AS r, first_value(doc_id) OVER w AS keeper_doc_id, first_value(unit) OVER w AS keeper_unit
  FROM units WINDOW w AS (PARTITION BY norm ORDER BY doc_id NULLS FIRST, row, unit))
SELECT doc_id, kind, CAST(unit AS BIGINT) AS unit, CAST(n_lines AS BIGINT) AS n_lines, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
  CAST(n_words AS BIGINT) AS n_words, keeper_doc_id, CAST(keeper_unit AS BIGINT) AS keeper_unit
FROM ranked WHERE r > 1
"""
