"""Ids that a float cannot hold, beside null ones, through every operator on documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from alertflow.llm import jaccard, packing, repeats, sharding, spelling, toxicity
from alertflow.llm.queries import vocabulary

BIG = 2**53 + 1
IDS = [None, BIG, BIG + 2, None, -BIG, 7, 7]
TEXTS = ["a b c d e f g", "a b c d e f g", None, "", "other words that stand here alone", "x", "a b c d e f g"]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "clash") for i, t in zip(IDS, TEXTS, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, length string").coalesce(1)


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def test_ids_come_back_as_they_are(spark, docs):
    want = sorted(IDS, key=str)
    found = jaccard.join_similar(docs)
    assert ids(found) == want
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {
        (None, 7), (BIG, 7), (7, 7), (7, 7), (BIG + 2, BIG + 2), (None, None), (-BIG, -BIG),
    }
    assert ids(packing.pack(packing.tokenised(docs, vocabulary()))) == want
    assert ids(repeats.without_repeats(docs), "doc.doc_id") == want
    assert ids(sharding.with_slots(sharding.with_shards(docs, "doc_id", 4), "doc_id")) == want
    labels = spark.createDataFrame([(BIG, 1), (7, 0)], "doc_id long, toxic int")
    assert ids(toxicity.fit(spark, docs, labels).score(docs)) == want


def test_ids_through_the_pipeline(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        left = set(ids(out))
        assert left <= set(IDS) and BIG + 2 in left, name
        if name not in ("jaccard", "packing", "mixing"):
            assert out.columns == docs.columns
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0 and empty.columns == out.columns, name


def test_checksums_of_large_ids(spark, docs):
    long = docs.withColumn("text", F.lit("spelling spelling spelling"))
    assert [(r.word, r.n) for r in spelling.word_counts(long).collect() if r.word == "spelling"] == [("spelling", 21)]
