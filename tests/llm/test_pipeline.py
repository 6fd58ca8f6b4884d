from collections import Counter

import corpus_pipeline
from tidewater.llm import contamination, near, quality


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5
    clean = steps["quality_rules"](spark, docs, sf_dir).cache()
    assert clean.columns == names and {r.doc_id for r in clean.collect()} == {r.doc_id for r in quality.quality(docs).filter("kept").collect()}
    single = steps["near_duplicates"](spark, clean, sf_dir).cache()
    classes = {r.doc_id: r.class_id for r in near.near_duplicates(clean).collect()}
    assert Counter(classes[r.doc_id] for r in single.collect()) == Counter(set(classes.values()))
    pure = steps["decontamination"](spark, single, sf_dir).cache()
    bad = {r.doc_id for r in contamination.contaminated(single, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in pure.collect()} == {r.doc_id for r in single.collect()} - bad
    mixed = steps["mixing"](spark, pure, sf_dir).cache()
    assert mixed.columns == names and mixed.count() > pure.count()
    ids = steps["token_ids"](spark, mixed, sf_dir)
    assert Counter(r.doc_id for r in ids.collect()) == Counter(r.doc_id for r in mixed.collect())


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_stages_of_odd_rows(spark, odd, sf_dir):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() == docs.count()
