"""Class probabilities from an array of logits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertflow.functions.binding import let


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Array of probabilities, shifted by the greatest logit so that exp cannot overflow."""
    def shifted(row: Column) -> Column:
        return let(F.array_max(row), lambda top: F.transform(row, lambda x: F.exp(x - top)))

    def scaled(weights: Column) -> Column:
        return let(_sum(weights), lambda total: F.transform(weights, lambda w: w / total))

    return let(let(logits, shifted), scaled)


def top_class(logits: Column) -> Column:
    """struct<prediction, confidence>: the likeliest class, first one on ties, and its probability.

    The greatest softmax value is 1 / sum(exp(x - max)), so the whole array is not needed.
    """
    def pick(row: Column) -> Column:
        def at(top: Column) -> Column:
            spread = F.aggregate(row, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
            return F.struct(
                (F.array_position(row, top) - 1).cast("int").alias("prediction"),
                (F.lit(1.0) / spread).alias("confidence"),
            )

        return let(F.array_max(row), at)

    return let(logits, pick)
