"""Mixing sources to target weights by soft membership, with DataFrame functions only.

A table of labelled rows names the domain of some documents. A naive Bayes classifier over hashed words
gives every document posteriors over the domains. Nonnegative rates are then fitted to the documents, so that
the expected tokens of each domain, the sum of rate x tokens x posterior, match the targets: projected gradient
on the least squares of the misses, whitened by the documents' Gram matrix (one number per pair of
domains), which makes 1 the right step. A step is one aggregation in Spark; its multipliers, one per
domain, are all that comes to the driver, and a document's rate follows from its posteriors and the steps' multipliers.

Defined results: null and empty texts have no tokens, the domains' shares as posteriors and a rate like others; null ids
are never labelled; an id labelled with two domains counts for each; labels of domains without a target are
ignored; domains without labelled rows take no part, and the other targets are scaled up to fill their
place; with no domain left every rate is 1; repeated rows get equal rates; other columns are carried.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import drop, written

BUCKETS = 1024
#: Words that a text's evidence counts as at most; more of the same text are not independent.
EVIDENCE_WORDS = 40
STEPS = 40
#: Steps whose multipliers are folded into rates before the rates are written again.
FOLDED = 8
CLOSE = 1e-6
#: Sums are kept in whole parts of a token, so they don't depend on the order of rows.
UNIT = 4096


def word_buckets(text: str) -> Column:
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("short"))


def _constant(values: Sequence, kind: str) -> Column:
    """A nested list of numbers as one literal, which the optimizer folds once."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _numbers(values: Sequence[float]) -> Column:
    return _constant([float(v) for v in values], "array<double>")


@dataclass
class MixingModel:
    """Weights of hashed words, and the multipliers of the steps taken."""

    domains: list[str]
    priors: list[float]
    weights: list[list[float]]
    lowest: float = 0.0
    steps: list[list[float]] = field(default_factory=list)
    targets: list[float] = field(default_factory=list)
    reached: list[float] = field(default_factory=list)

    def posteriors(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``_tokens`` and ``_p``, the posteriors in the order of ``domains``."""
        size = len(self.domains)
        table = _constant(self.weights, "array<array<double>>")
        zero = _numbers([0.0] * size)
        total = F.aggregate(
            "_words", zero, lambda acc, b: F.zip_with(acc, F.get(table, b), lambda x, y: x + y)
        )
        # Each explode of one row keeps what follows from working the words out again.
        known = docs.withColumn("_words", F.explode(F.array(word_buckets(text))))
        known = known.withColumn("_tokens", F.size("_words").cast("long"))
        scale = F.least(F.col("_tokens"), F.lit(EVIDENCE_WORDS)) / F.greatest(F.col("_tokens"), F.lit(1))
        scores = F.zip_with(total, _numbers([math.log(p) for p in self.priors]), lambda t, p: t * scale + p)
        known = known.withColumn("_scores", F.explode(F.array(scores)))
        shifted = F.transform("_scores", lambda s: F.exp(s - F.array_max("_scores")))
        known = known.withColumn("_shifted", F.explode(F.array(shifted)))
        whole = F.aggregate("_shifted", F.lit(0.0), lambda acc, x: acc + x)
        p = F.transform("_shifted", lambda x: x / whole)
        return known.withColumn("_p", F.explode(F.array(p))).drop("_words", "_scores", "_shifted")

    def stepped(self, rate: Column, steps: Sequence[Sequence[float]]) -> Column:
        """``rate`` after more steps: down by the multipliers' mean under the posteriors, projected."""
        if not steps:
            return rate
        all_steps = _constant([list(map(float, s)) for s in steps], "array<array<double>>")

        def step(r: Column, s: Column) -> Column:
            change = F.aggregate(F.zip_with("_p", s, lambda p, m: p * m), F.lit(0.0), lambda acc, x: acc + x)
            return F.greatest(F.lit(self.lowest), r - change)

        return F.aggregate(all_steps, rate, step)

    def rates(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``_tokens``, ``_p`` and ``_rate``."""
        if not self.domains:
            return docs.select(
                "*", F.size(word_buckets(text)).cast("long").alias("_tokens"),
                F.array().cast("array<double>").alias("_p"), F.lit(1.0).alias("_rate"),
            )
        return self.posteriors(docs, text).withColumn("_rate", self.stepped(F.lit(1.0), self.steps))


def classify(docs: DataFrame, labelled: DataFrame, domains: Sequence[str]) -> MixingModel:
    """The classifier from ``labelled`` (doc_id, domain); only counts per domain and bucket reach the driver."""
    marks = labelled.filter(F.col("domain").isin(list(domains)) & F.col("doc_id").isNotNull()).distinct()
    # One plan at every size: labels grow with the documents, so they are never broadcast.
    rows = docs.select("doc_id", word_buckets("text").alias("_words")).join(marks.hint("merge"), "doc_id")
    rows = written(rows.select("domain", "_words"), "labelled")
    words = rows.select("domain", F.explode("_words").alias("bucket")).groupBy("domain", "bucket").count().collect()
    documents = {row["domain"]: row["count"] for row in rows.groupBy("domain").count().collect()}
    drop(rows)
    present = [d for d in domains if documents.get(d)]
    counts = np.full((BUCKETS, len(present)), 0.5)
    for row in words:
        if row["domain"] in present:
            counts[row["bucket"], present.index(row["domain"])] += row["count"]
    weights = np.log(counts / counts.sum(axis=0, keepdims=True)) if present else counts
    # Only differences between domains matter; smaller numbers keep the sums exact.
    weights = weights - weights.mean(axis=1, keepdims=True) if present else weights
    total = sum(documents[d] for d in present)
    return MixingModel(present, [documents[d] / total for d in present], weights.round(9).tolist())


def fit(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], lowest: float = 0.0) -> MixingModel:
    """Fit rates of at least ``lowest``.

    ``targets`` are shares. With ``lowest`` 0 their total is the tokens there are; with 1 it is the
    smallest total for which no domain has to shrink, so documents are only ever repeated.
    """
    model = classify(docs, labelled, list(targets))
    model.lowest = lowest
    if not model.domains:
        return model
    size = len(model.domains)
    narrow = model.posteriors(docs.select("text")).select("_tokens", "_p", F.lit(1.0).alias("_rate"))
    table = written(narrow, "rates")

    def sums(weight: Column, frame: DataFrame, pairs: list[tuple[int, ...]]) -> list[float]:
        parts = []
        for n, pair in enumerate(pairs):
            value = weight * F.col("_tokens")
            for k in pair:
                value = value * F.get("_p", F.lit(k))
            parts.append(F.sum(F.round(value * UNIT).cast("decimal(38,0)")).alias(f"s{n}"))
        row = frame.agg(*parts).first()
        return [float(x or 0) / UNIT for x in row]

    singles = [(k,) for k in range(size)]
    have = np.array(sums(F.lit(1.0), table, singles))
    pairs = [(k, m) for k in range(size) for m in range(size)]
    gram = np.array(sums(F.lit(1.0), table, pairs)).reshape(size, size)
    whiten = np.linalg.pinv(gram, rcond=1e-9)
    shares = np.array([targets[d] for d in model.domains])
    shares = shares / shares.sum()
    whole = have.sum() if lowest <= 0 else lowest * max((have / np.maximum(shares, 1e-12)).max(), 0.0)
    wanted = shares * whole
    model.targets, reached = wanted.tolist(), have
    pending: list[list[float]] = []
    for _ in range(STEPS):
        if np.abs(reached - wanted).max() <= CLOSE * max(whole, 1.0):
            break
        step = (whiten @ (reached - wanted)).round(12).tolist()
        model.steps.append(step)
        pending.append(step)
        if len(pending) == FOLDED:
            newer = written(table.withColumn("_rate", model.stepped(F.col("_rate"), pending)), "rates")
            drop(table)
            table, pending = newer, []
        reached = np.array(sums(model.stepped(F.col("_rate"), pending), table, singles))
    model.reached = reached.tolist()
    drop(table)
    return model


def copies(rate: Column, *key: str) -> Column:
    """Whole copies for a rate: its floor, and one more for the share of keys that its fraction is."""
    draw = F.pmod(F.xxhash64(*key), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")
