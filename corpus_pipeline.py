"""A training corpus from the documents table, in five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import contamination, mixing, near, quality, scratch, tokenstore

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that fail or lose too much text."""
    return quality.stage(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near.stage(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return contamination.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.stage(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids in the content-addressed store, read back: doc_id, start, n_tokens, ids_crc32."""
    tokenizer, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    path = scratch.folder(spark, "token-store", keep=True)
    tokenstore.write(docs, path, tokenizer, pattern)
    return tokenstore.digests(spark, path, tokenstore.id_kind(tokenizer, pattern))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", clean_lines),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", token_ids),
]

#: SQL can't express the near-duplicate, decontamination and token stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage has written on its way goes once its result is."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.mark()
    for name, stage in STAGES:
        path = scratch.folder(spark, f"stage-{name}")
        docs = scratch.written(stage(spark, docs, sf_dir), f"stage-{name}", path)
        scratch.clear(spark, since, path)
    return docs
