"""Tokens of texts looked up in a table of terms.

The joins name no strategy and copy nothing: Spark broadcasts a table that its own size check
allows, and beyond that shuffles both sides. A hot token, place or message makes a large
partition, which adaptive execution splits by its blocks, rows equal in every column included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "_key"
POSITION = "_pos"
LENGTH = "_length"


def with_key(df: DataFrame, text: str, key: Sequence[str] | None) -> DataFrame:
    """Add what tells messages with different texts apart: the named columns, or a hash of the text.

    As a struct it is never null, and equal nulls inside it count as equal.
    """
    whole = F.unhex(F.sha2(F.col(text), 256)).alias("hash")
    return df.withColumn(KEY, F.struct(*key) if key else F.struct(whole))


def listed_tokens(keyed: DataFrame, terms: DataFrame, tokens: Column) -> DataFrame:
    """Key and position of every token that is a term, with the other columns of ``terms``."""
    # The token array is made inside the generator: as a column of its own, Spark would make it
    # twice more to filter out empty ones.
    words = keyed.select(KEY, F.posexplode(tokens).alias(POSITION, "term"))
    return words.join(terms.distinct(), "term").drop("term")


def listed_phrases(keyed: DataFrame, terms: DataFrame, tokens: Column, lengths: Sequence[int]) -> DataFrame:
    """Key, position, number of tokens and text of every run of tokens that is a phrase, with the other columns of ``terms``.

    ``lengths`` are the numbers of tokens that phrases have. Whole runs are looked up, not their first tokens, so a token
    that begins many phrases makes no large group.
    """
    run = f"array<struct<{POSITION}:int,{LENGTH}:int,term:string>>"

    def of_length(n: int) -> Column:
        def one(at: Column) -> Column:
            return F.struct(at.alias(POSITION), F.lit(n).alias(LENGTH), F.array_join(F.slice("_tokens", at, n), " ").alias("term"))

        starts = F.sequence(F.lit(1), F.size("_tokens") - n + 1)
        # In a shorter text the sequence would count backwards.
        return F.when(F.size("_tokens") >= n, F.transform(starts, one)).otherwise(F.array().cast(run))

    words = keyed.select(KEY, F.explode(F.array(tokens)).alias("_tokens"))
    words = words.select(KEY, F.inline(F.concat(*map(of_length, lengths))))
    return words.join(terms.distinct(), "term")
