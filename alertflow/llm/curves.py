"""Nearest neighbours along shifted space-filling curves.

Each curve projects the vectors to a few dimensions by its own random directions, shifts them by its own random
offset, and orders them by their place on a Hilbert curve. Spark range-partitions that order; a vector's window is
the rows near it. Windows of all curves are searched in blocks, by exact distances on the original
vectors, and merged.

How wide a window must be depends on the data: it is fitted on a sample of at most ``SAMPLE_ROWS`` rows, as the share of
all rows at which the windows of all curves together hold ``TARGET`` of the sample's true neighbours. All rows are
indexed. In a sample neighbours lie further off than among all rows, so the window errs on the wide side.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of
different length are never compared; a null id is no query and no candidate; rows that repeat an id count as one
vector at its least distance; ties go to the smaller id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertflow.llm.common import ranked, written
from alertflow.llm.vectors import matrix, usable

CURVES = 3
DIMENSIONS, BITS = 6, 8
NEIGHBOURS = 10
QUERY_EVERY = 100
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 256
TARGET = 0.96
#: Rows of a block of candidates, and rows in whose span queries are searched together.
CHUNK = 2048
SPAN = 51_200
SEED = 7


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on a Hilbert curve of each row of cells (unsigned, below 2**bits), by Gray-code rotations."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        mask = level - 1
        for i in range(dims):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(high, mask, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(x: np.ndarray, curve: int, scale: float) -> np.ndarray:
    """Keys of vectors on one curve. ``scale`` is a typical length, which sets the size of a cell."""
    random = np.random.default_rng([SEED, curve, x.shape[1]])
    directions = np.linalg.qr(random.normal(size=(x.shape[1], min(DIMENSIONS, x.shape[1]))))[0]
    spread = scale / np.sqrt(x.shape[1])
    shifted = (x @ directions) / max(spread, 1e-300) + random.uniform(-0.5, 0.5, directions.shape[1])
    cells = np.floor((shifted + 4) / 8 * (1 << BITS))
    return hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)


def fit_share(sample: np.ndarray, scale: float, neighbours: int, target: float) -> float:
    """The least share of rows on either side of a query at which all curves' windows reach ``target``."""
    n = len(sample)
    if n <= neighbours + 1:
        return 1.0
    queries = np.linspace(0, n - 1, min(n, SAMPLE_QUERIES)).astype(int)
    squares = (sample**2).sum(1)
    distance = squares[queries, None] + squares[None] - 2 * sample[queries] @ sample.T
    distance[np.arange(len(queries)), queries] = np.inf
    near = np.argpartition(distance, neighbours - 1, axis=1)[:, :neighbours]
    gaps = []
    for curve in range(CURVES):
        rank = np.empty(n, np.int64)
        rank[np.argsort(curve_keys(sample, curve, scale), kind="stable")] = np.arange(n)
        gaps.append(np.abs(rank[near] - rank[queries][:, None]))
    return float(min(1.0, (np.quantile(np.min(gaps, axis=0), target) + 1) / n))


def nearest(rows: DataFrame, neighbours: int = NEIGHBOURS, every: int = QUERY_EVERY, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest vectors of every row whose id ``every`` divides."""
    vector = F.col("embedding").cast("array<double>")
    good = rows.select("vec_id", vector.alias("vector")).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    good = written(good.withColumn("dims", F.size("vector")), "vectors")
    total = good.count()
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))
    sample = good.filter(part * max(total, 1) < SAMPLE_ROWS * (1 << 20) // 2).limit(SAMPLE_ROWS).toPandas()
    shares, scales = {}, {}
    for dims, group in sample.groupby("dims"):
        x = matrix(group["vector"])
        scales[int(dims)] = float(np.median(np.linalg.norm(x, axis=1)))
        shares[int(dims)] = fit_share(x, scales[int(dims)], neighbours, target)
    share = max(shares.values(), default=1.0)
    width = int(np.ceil(share * total)) + neighbours

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, group in batch.groupby("dims"):
                x = matrix(group["vector"])
                for curve in range(CURVES):
                    yield group.assign(curve=curve, key=curve_keys(x, curve, scales.get(int(dims), 1.0)))

    ordered = good.mapInPandas(put, "vec_id long, vector array<double>, dims int, curve int, key long")
    ordered = ordered.repartitionByRange("dims", "curve", "key", "vec_id").sortWithinPartitions("dims", "curve", "key", "vec_id")
    placed = ranked(ordered, ["dims", "curve"], "place", "curves")
    placed = written(placed, "places")
    queries = placed.filter(F.col("vec_id") % every == 0)
    low, high = F.greatest(F.col("place") - width, F.lit(0)), F.least(F.col("place") + width, F.lit(total - 1))
    span = F.floor(F.col("place") / SPAN)
    asked = queries.select(
        "dims", "curve", span.alias("span"), F.explode(F.sequence(F.floor(low / CHUNK), F.floor(high / CHUNK))).alias("chunk"),
        F.col("vec_id").alias("query_id"), "vector", "place",
    )
    # A chunk meets every span whose queries' windows can reach it.
    chunk = F.floor(F.col("place") / CHUNK)
    first, last = chunk * CHUNK - width, chunk * CHUNK + CHUNK - 1 + width
    spans = F.sequence(F.floor(F.greatest(first, F.lit(0)) / SPAN), F.floor(F.least(last, F.lit(total - 1)) / SPAN))
    held = placed.select("dims", "curve", F.explode(spans).alias("span"), chunk.alias("chunk"), "vec_id", "vector", "place")

    def search(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q, x = matrix(queries["vector"]), matrix(candidates["vector"])
        ids, places = candidates["vec_id"].to_numpy(np.int64), candidates["place"].to_numpy(np.int64)
        rough = (q**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * q @ x.T
        own = queries["query_id"].to_numpy(np.int64)
        out_of = np.abs(queries["place"].to_numpy(np.int64)[:, None] - places[None]) > width
        rough[out_of | (own[:, None] == ids[None])] = np.inf
        out = []
        slack = 1e-9 * ((q**2).sum(1) + (x**2).sum(1).max())
        for i in range(len(q)):
            most = np.partition(rough[i], neighbours - 1)[neighbours - 1] if len(ids) > neighbours else np.inf
            some = np.flatnonzero((rough[i] <= most + slack[i]) & np.isfinite(rough[i]))
            exact = np.sqrt(((x[some] - q[i]) ** 2).sum(1))
            best = np.lexsort((ids[some], exact))[:neighbours]
            out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[some][best], "score": exact[best]}))
        return pd.concat(out, ignore_index=True)[names]

    keys = ["dims", "curve", "span", "chunk"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
    return best.select("query_id", "rank", "vec_id", "score")
