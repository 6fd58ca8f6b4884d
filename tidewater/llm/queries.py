"""The registered queries of the subpackage: QUERIES by name, ORACLE by name where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import chat, contamination, linechunks, linehash, manifest, mixing, near, quality, repair, revisits, scratch, substrings, tokenstore, wrapper

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the content-addressed store of all documents and reads it back."""
    tokenizer, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    path = scratch.folder(spark, "token-store", keep=True)
    tokenstore.write(table(spark, sf_dir, "documents"), path, tokenizer, pattern)
    return tokenstore.digests(spark, path, tokenstore.id_kind(tokenizer, pattern))


@query
def op2_line_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line and paragraph that goes because an earlier one says the same."""
    return linehash.removals(table(spark, sf_dir, "documents")).drop("row", "keeper_row")


ORACLE["op2_line_hashes"] = linehash.ORACLE


@query
def op3_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrapper.extract(table(spark, sf_dir, "pages")).drop("by_template")


@query
def op4_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, the base verdict and the method's."""
    out = quality.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_clean_chars")


ORACLE["op4_quality_lines"] = quality.ORACLE


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, or an edited copy of one, with the item and the score."""
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the page table's archive, resolved; headers as one string."""
    out = revisits.resolve(revisits.captures(table(spark, sf_dir, "pages")))
    headers = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return out.withColumn("headers", headers)


ORACLE["op6_warc_revisits"] = revisits.ORACLE


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.text_weight(docs["text"])).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op7_mix_sources"] = mixing.ORACLE


@query
def op8_suffix_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing every repeated 200-byte string leaves of each document."""
    return substrings.repeated(table(spark, sf_dir, "documents")).drop("spans", "kept")


@query
def op9_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class of near copies."""
    return near.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query
def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk of lines that goes because an earlier one has the same bytes."""
    return linechunks.removals(table(spark, sf_dir, "documents")).drop("row", "keeper_row")


ORACLE["op10_line_chunks"] = linechunks.ORACLE


#: A conversation whose texts are control strings of the template.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query
def op11_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all conversations, and one of control strings, as prefix trees of token ids, and reads them back."""
    tokenizer, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    more = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    path = scratch.folder(spark, "chat-trees", keep=True)
    chat.write(rows, path, tokenizer, pattern)
    return chat.digests(chat.read(spark, path, tokenizer, pattern))


ORACLE["op11_chat_tree"] = chat.oracle(CONTROL)


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and what the proof says of a copy in which some rows are changed."""
    return manifest.digests(table(spark, sf_dir, "documents"))


ORACLE["op12_merkle_manifest"] = manifest.ORACLE


@query
def op13_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired turns of every conversation, after known damage."""
    rows = table(spark, sf_dir, "conversations")
    return repair.digests(repair.repair(repair.damaged(rows), rows))


ORACLE["op13_repair_turns"] = repair.ORACLE
