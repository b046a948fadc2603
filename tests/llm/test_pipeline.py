"""The pipeline's stages, each against brute force on what it was given."""

import re

import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from bandlex.llm.shared import new_path
from test_outliers import brute_counts
from test_packing import check
from test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows before and after each stage."""
    docs, found = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        found[name] = (docs.collect(), after.collect())
        if name != "packing":
            assert after.columns == docs.columns
        docs = after
    return found


def labels_of(spark, sf):
    return {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}


def test_quality_rules(spark, sf, stages):
    before, after = stages["quality rules"]
    kept, label = {r.doc_id for r in after}, labels_of(spark, sf)
    assert set(after) <= set(before) and len(after) == len(kept)
    for d in before:
        c = brute_counts(d.text)
        failed = c["n_words"] < 50 or 2 * c["n_repeat_words"] > c["n_words"]
        assert not (failed and d.doc_id in kept)
        if not failed and d.doc_id in label:
            assert (d.doc_id in kept) == bool(label[d.doc_id][0])


def test_exact_dedup(stages):
    before, after = stages["exact dedup"]
    least = {}
    for d in before:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", d.text)
        least[text] = min(d.doc_id, least.get(text, d.doc_id))
    assert {d.doc_id for d in after} == set(least.values()) and len(after) == len(least)
    assert len(after) < len(before)


def test_near_dedup(stages):
    before, after = stages["near dedup"]
    components = brute_components([d.doc_id for d in before], [brute_print(d.text) for d in before])
    assert sorted(d.doc_id for d in after) == sorted(set(components))
    assert set(after) <= set(before) and len(after) < len(before)


def test_mixing(spark, sf, stages):
    before, after = stages["mixing"]
    assert set(after) <= set(before) and len(set(after)) == len(after) < len(before)
    kept, label = {d.doc_id for d in after}, labels_of(spark, sf)
    gone = [label[d.doc_id] for d in before if d.doc_id not in kept and d.doc_id in label]
    assert sum(toxic for _, toxic in gone) > 0.7 * len(gone)


def test_packing(stages):
    before, after = stages["packing"]
    assert check(after, before) < 0.01


def test_odd_rows(spark, odd_docs, sf):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert {r.doc_id for r in docs.collect()} <= {5, 6}
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd_docs, sf).collect()
        assert stage(spark, odd_docs.limit(0), sf).collect() == []


def test_near_dedup_keeps_one_of_repeated_rows(spark, odd_docs, sf):
    docs = odd_docs.where("doc_id = 2 or doc_id is null or doc_id = 8")
    rows = corpus_pipeline.near_dedup(spark, docs, sf).collect()
    expected = brute_components(range(docs.count()), [brute_print(d.text) for d in docs.collect()])
    assert len(rows) == len(set(expected))


def test_columns_of_any_name_come_through(spark, sf):
    """Every stage but the last returns rows as they were, whatever their columns are called."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 300")
    names = ["n_tokens", "p", "rate", "copies", "_digest", "_words", "_present", "_score", "_odds", "_copy", "words", "lines", "windows",
             "kept", "own", "g", "x0", "id", "row", "least", "carried", "fingerprint", "component", "digest", "_id", "_key"]
    docs = docs.select("*", *(F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in names)).cache()
    before = set(docs.collect())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        rows = after.collect()
        assert after.columns == docs.columns and rows and set(rows) <= before
    assert check(corpus_pipeline.packing(spark, docs, sf).collect(), list(before)) < 0.02
