"""Near-duplicate vectors by cross-polytope hashing.

A hash function rotates a vector by three rounds of random signs and a fast Hadamard transform, and takes
the nearest signed axis. A table joins ``FUNCTIONS`` of them; a vector is put into the bucket of its nearest axes and
into those where one function takes its second-nearest axis (multiprobe). Vectors that meet in a
bucket are compared by cosine, in blocks of at most about ``BLOCK`` rows a side, so a bucket of any size is split and no
pair leaves its task: a block gives numbers of links, each pair counted only in the first bucket that
both share, and a star for each group that its links join.

Equal vectors of one label become one node with a weight before hashing. Found links are exact; pairs just
above the threshold are missed with a probability that the tables make small (see the README's measured recall).

Defined results: null labels, and vectors that are null, zero, or hold null or non-finite components link
with nothing; vectors of different length are never compared; repeated rows are rows of their own and link
with each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import components, written
from alertflow.llm.vectors import matrix, usable

LEAST = 0.98
TABLES, FUNCTIONS = 10, 3
BLOCK = 1024
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the length is a power of two."""
    rows, size = x.shape
    step = 1
    while step < size:
        x = x.reshape(rows, size // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        step *= 2
    return x.reshape(rows, size)


def axes(x: np.ndarray, function: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second-nearest signed axis of each row after one random rotation."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    random = np.random.default_rng([SEED, function, size])
    turned = np.zeros((len(x), size))
    turned[:, : x.shape[1]] = x
    for _ in range(3):
        turned = hadamard(turned * random.choice([-1.0, 1.0], size))
    best = np.argpartition(-np.abs(turned), 1, axis=1)[:, :2]
    values = np.take_along_axis(turned, best, 1)
    order = np.argsort(-np.abs(values), axis=1, kind="stable")
    best, values = np.take_along_axis(best, order, 1), np.take_along_axis(values, order, 1)
    signed = 2 * best + (values < 0)
    return signed[:, 0], signed[:, 1]


def bucket_keys(x: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS) -> np.ndarray:
    """Keys (rows, tables * (1 + functions)): per table the bucket and its probes, in the order of tables."""
    out = []
    base = 2 << max(1, (x.shape[1] - 1).bit_length())
    for t in range(tables):
        near = [axes(x, t * functions + f) for f in range(functions)]
        power = [base**f for f in range(functions)]
        key = sum(first * p for (first, _), p in zip(near, power, strict=True))
        probes = [key + (second - first) * p for (first, second), p in zip(near, power, strict=True)]
        out += [k * tables + t for k in (key, *probes)]
    return np.stack(out, axis=1).astype(np.int64)


def _first_shared(keys: np.ndarray, i: np.ndarray, j: np.ndarray, here: int, tables: int) -> np.ndarray:
    """Which of the pairs (i, j) share no bucket before the bucket ``here``."""
    per, table = keys.shape[1] // tables, here % tables
    first = np.ones(len(i), bool)
    for t in range(table + 1):
        a, b = keys[i, t * per : (t + 1) * per], keys[j, t * per : (t + 1) * per]
        for p in range(per):
            shared = (b == a[:, p : p + 1]).any(1)
            first &= ~(shared & (a[:, p] < here)) if t == table else ~shared
    return first


def _compare(group: dict, here: int, sides: np.ndarray, tables: int, least: float):
    """(node, links) and star edges (src, dst) of one block; sides 0/1, or all 0 within one block."""
    x, node, weight, keys = group["x"], group["node"], group["weight"], group["keys"]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    if sides.any():
        near &= sides[:, None] != sides[None, :]
    i, j = np.nonzero(near)
    if not len(i):
        return None
    new = _first_shared(keys, i, j, here, tables)
    links = np.bincount(i[new], weights=weight[j[new]], minlength=len(node)).astype(np.int64)
    label = node.copy()
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        if (low == label).all():
            break
        label = low
    return links, label


def link_blocks(rows: DataFrame, tables: int, least: float) -> DataFrame:
    """(node, links, star): what each block of each bucket finds. ``rows`` is sorted by block in each partition."""

    def finish(held: pd.DataFrame) -> pd.DataFrame:
        same = (held[["bucket", "label", "one", "two"]].values[1:] == held[["bucket", "label", "one", "two"]].values[:-1]).all(1)
        cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(held)]
        node, weight = held["node"].to_numpy(np.int64), held["weight"].to_numpy(np.float64)
        here, side = held["bucket"].to_numpy(np.int64), held["side"].to_numpy(np.int64)
        out = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a < 2:
                continue
            keys = np.stack([np.frombuffer(k, np.int64) for k in held["keys"].iloc[a:b]])
            group = {"x": matrix(held["vector"].iloc[a:b]), "node": node[a:b], "weight": weight[a:b], "keys": keys}
            found = _compare(group, int(here[a]), side[a:b], tables, least)
            if found is not None:
                some = (found[0] > 0) | (found[1] != node[a:b])
                out.append(np.stack([node[a:b][some], found[0][some], found[1][some]], axis=1))
        table = np.concatenate([*out, np.zeros((0, 3), np.int64)])
        return pd.DataFrame(table, columns=["node", "links", "star"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            names = ["bucket", "label", "one", "two"]
            open_rows = (held[names] == held[names].iloc[-1]).all(axis=1).to_numpy()
            done = int(np.argmax(open_rows))
            if done:
                yield finish(held.iloc[:done])
                held = held.iloc[done:]
        if held is not None and len(held):
            yield finish(held)

    return rows.mapInPandas(run, "node long, links long, star long")


def near_duplicates(
    rows: DataFrame, least: float = LEAST, tables: int = TABLES, functions: int = FUNCTIONS, block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row (vec_id, embedding, label)."""
    numbered = rows.select("vec_id", "embedding", "label", F.monotonically_increasing_id().alias("row"))
    numbered = written(numbered, "vectors")
    good = numbered.filter(usable(F.col("embedding")) & F.col("label").isNotNull())
    # Equal vectors in their exact bits meet by hash; a node is the first of its rows.
    vector = F.col("embedding").cast("array<double>")
    same = F.sha1(F.concat_ws(",", F.transform(vector, lambda v: F.hex((v + F.lit(0.0)).cast("string")))))
    hashed = good.select("vec_id", "row", F.col("label").cast("string").alias("label"), same.alias("same"), vector.alias("vector"))
    nodes = hashed.groupBy("label", "same").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"))
    members = written(hashed.drop("vector").join(nodes, ["label", "same"]).select("vec_id", "row", "node", "weight"), "members")
    points = members.filter("row = node").select("node", "weight").join(hashed.select(F.col("row").alias("node"), "label", "vector"), "node")

    def hash_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                x = matrix(part["vector"])
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                keys = bucket_keys(unit, tables, functions)
                label = part["label"] + ":" + str(x.shape[1])
                yield part.assign(label=label, keys=[k.tobytes() for k in keys], buckets=list(keys))

    schema = "node long, weight long, label string, vector array<double>, keys binary, buckets array<long>"
    points = written(points.select("node", "weight", "label", "vector").mapInPandas(hash_all, schema), "points")
    put = points.select("node", "label", F.explode(F.array_distinct("buckets")).alias("bucket"))
    sizes = put.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    put = put.join(sizes, ["label", "bucket"])
    blocks = F.ceil(F.col("rows") / block).cast("int")
    put = put.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    put = put.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    put = put.select(
        "node", "bucket", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    full = put.join(points.drop("buckets"), "node").repartition("bucket", "label", "one", "two")
    found = written(link_blocks(full.sortWithinPartitions("bucket", "label", "one", "two"), tables, least), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("node").alias("src"), F.col("star").alias("dst")).filter("src <> dst").distinct()
    joined = components(edges)
    linked = members.join(counts, "node", "left").join(joined, "node", "left").select(
        "row", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    placed = numbered.select("vec_id", "row").join(linked, "row", "left")
    placed = placed.withColumn("component", F.coalesce("component", -1 - F.col("row")))
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(smallest, "component").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
