"""A corpus from raw documents to packed sequences, in five written stages.

Every stage works on all rows that its predecessor kept and, but for the last, returns the columns of
its input. Columns that are not used are carried inside a struct, so their names clash with nothing.

* toxicity: documents that the model rejects go;
* jaccard: one document of each near-duplicate group stays, that with the smallest id;
* secrets: each found span becomes a mark, and n_chars the new length;
* mixing: documents are repeated so that tokens of the quality domains come to their targets. Rates are
  at least 1, so none goes;
* packing: documents become pieces in sequences of at most 2048 tokens.

Null and empty texts pass every stage: they are scored, are nobody's copy, hold no secret, are repeated
at their rate and pack as their end token. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.llm import jaccard, mixing, packing, secret_scan, toxicity
from alertflow.llm.common import drop, small_batches, table, written
from alertflow.llm.queries import TARGETS, quality_domains, vocabulary


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    kept = model.score(_packed(docs), ["doc"]).filter("predicted = 0").select("doc.*")
    model.drop()
    return kept


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(_packed(docs))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = ~F.col("text").eqNullSafe(F.col("doc.text"))
        new["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("doc.n_chars"))
    return masked.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = mixing.fit(docs.select("doc_id", "text"), quality_domains(spark, sf_dir), TARGETS, lowest=1.0)
    rated = model.rates(_packed(docs))
    times = F.sequence(F.lit(1), mixing.copies(F.col("_rate"), "doc_id"))
    return rated.withColumn("_copy", F.explode(times)).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        return packing.pack(packing.tokenised(docs, vocabulary()))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", keep_one_of_each),
    ("secrets", mask_secrets),
    ("mixing", mix_domains),
    ("packing", pack),
]

#: No SQL can express the fitted models; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
