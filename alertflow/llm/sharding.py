"""Shards by jump consistent hashing.

A stable key and the number of shards decide a row's shard; there is no table of the ring. With one
shard more, the rows that move all move into the new shard. Rows with equal keys share a shard.

Defined results: a null key has the hash of the text ``null`` and so one shard of its own choice; a
null text has no bytes and the checksum 0; repeated rows each get a slot; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import ranked


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key: jump ahead by pseudo-random steps while inside the range."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = np.floor((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def stable_key(column: Column) -> Column:
    """Sixty bits of the MD5 of a value's text, the same in every run and on every machine."""
    text = F.coalesce(column.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards).astype(np.int32))

    return assign(key)


def with_shards(docs: DataFrame, key: str, shards: int) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard``, the shard if there were one more."""
    keyed = docs.withColumn("_key", stable_key(F.col(key)))
    return keyed.select(
        *docs.columns, shard_of(F.col("_key"), shards).alias("shard"), shard_of(F.col("_key"), shards + 1).alias("grown_shard")
    )


def with_slots(sharded: DataFrame, order: str) -> DataFrame:
    """``sharded`` with ``slot``: its gapless place from 0 in its shard, by ``order``.

    Rows are range-partitioned by the order and their place in the table, so many rows of one key are
    split too; slots are counted file by file, and no shard meets in one task.
    """
    placed = sharded.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(F.col(order), F.col("_place")).sortWithinPartitions(order, "_place")
    return ranked(placed, ["shard"], "slot", "shards").drop("_place")
