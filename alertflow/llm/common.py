"""Steps that several operators share: written tables, ranks without hot groups, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertflow.streaming.scratch import new_folder

#: Rows in one file of a ranked table, and so in one window of ``ranked``.
ROWS_PER_FILE = 500_000
#: Bits of the map that tells which keys a join will want.
BITMAP = 1 << 24
#: Bytes of a batch of rows with texts, on their way to Python and back.
BATCH_BYTES = 1 << 22


def written(df: DataFrame, purpose: str, **options) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut and any executor can read it again.

    The folder goes when the session's file system is closed.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.options(**options).parquet(folder)
    delete_on_exit(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Tables written meanwhile send ``BATCH_BYTES`` at a time to Python: an executor holds batches beside its heap, in vectors that double."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def together(*tables: DataFrame) -> DataFrame:
    """The rows of several tables made by ``written`` with one schema, as one scan: plans stay small however many there are."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*(f for df in tables for f in sorted(_folders(df))))


def delete_on_exit(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in tables:
        _drop(df)


def _folders(df: DataFrame) -> set[str]:
    return {name.rsplit("/", 1)[0] for name in df.inputFiles()}


def _drop(df: DataFrame) -> None:
    spark = df.sparkSession
    for folder in _folders(df):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, keys: Sequence[str], rank: str, purpose: str) -> DataFrame:
    """``df`` with a gapless rank from 0 among the rows of equal ``keys``, in the order of its partitions.

    A key with any share of the rows is ranked in pieces: by position inside each written file,
    plus the counts of the files before it. No window holds more rows than one file does.
    """
    table = written(df, purpose, maxRecordsPerFile=ROWS_PER_FILE).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    names = list(keys)
    before = Window.partitionBy(*names).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        table.groupBy(*names, "_file")
        .agg(F.count(F.lit(1)).alias("_count"))
        .select(*names, "_file", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*names, "_file").orderBy("_row")
    local = table.withColumn("_local", F.row_number().over(inside) - 1)
    same = [local[name].eqNullSafe(starts[name]) for name in [*names, "_file"]]
    joined = local.join(starts, on=_all(same))
    return joined.select(
        *(local[c] for c in df.columns), (local["_local"] + starts["_start"]).cast("long").alias(rank)
    )


def _all(conditions: Sequence[Column]) -> Column:
    total = conditions[0]
    for condition in conditions[1:]:
        total = total & condition
    return total


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst longs): the smallest node that links reach.

    Rounds of contraction: each node points at its smallest neighbour or itself, pointers are doubled
    until they stand still, and the links between the nodes that are left go on. Each round at least
    halves the nodes that still have links, so the number of rounds follows the logarithm of the
    largest component. Links and labels stay in written tables.
    """
    ordered = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    left = written(ordered.filter("src < dst").distinct(), "links")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        pointers = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("to"))
        pointers = written(pointers.select("node", F.least("node", "to").alias("to")), "pointers")
        while True:
            target = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
            doubled = written(pointers.join(target, "to").select("node", "to", "next"), "pointers")
            moved = not doubled.filter("next <> to").isEmpty()
            drop(pointers)
            pointers = doubled.select("node", F.col("next").alias("to"))
            if not moved:
                break
        if labels is None:
            labels = pointers.select("node", F.col("to").alias("component"))
        else:
            step = pointers.select(F.col("node").alias("component"), F.col("to").alias("_next"))
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("_next", "component").alias("component")
            )
            labels = written(labels, "labels")
        low = pointers.select(F.col("node").alias("src"), F.col("to").alias("a"))
        high = pointers.select(F.col("node").alias("dst"), F.col("to").alias("b"))
        onward = left.join(low, "src").join(high, "dst")
        onward = onward.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        onward = written(onward.filter("src < dst").distinct(), "links")
        drop(left)
        left = onward
    if labels is None:
        return left.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return labels


def bitmap(slots: DataFrame, slot: str, bits: int) -> np.ndarray:
    """The places (0 to ``bits`` - 1) in a column as a map of ``bits`` // 64 numbers.

    Spark sets the bits, so however many rows there are, no more than the map comes to the driver.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(slot), F.lit(64)).cast("int"))
    words = slots.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the ``slots`` (unsigned) are set in a ``bitmap``."""
    return (bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


def place_map(key: str, wanted: DataFrame) -> tuple[Column, Broadcast]:
    """A key's place in a map of ``BITMAP`` bits, and the broadcast ``bitmap`` of the places in ``wanted``.

    The map has a fixed size, so it keeps most rows that a join would drop from being shuffled, not all; of very many keys
    it keeps none.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP)).alias("place")
    return place, wanted.sparkSession.sparkContext.broadcast(bitmap(wanted.select(place), "place", BITMAP))


def likely_in(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` without most of the rows whose ``key`` is not in ``wanted``, before a join that finds the rest."""
    place, bits = place_map(key, wanted)

    @F.pandas_udf("boolean")
    def known(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in places:
            yield pd.Series(in_bitmap(bits.value, batch.to_numpy(np.uint64)))

    return df.filter(known(place))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of ``key``, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if held and values[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = values[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that few texts at a time become Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def blocks(batches: Iterator[pa.RecordBatch], answer: str) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Whether these are answers, and rows of one block: from batches sorted by ``block``, answers first.

    Rows with a value in the column ``answer`` are answers; a block always has its answers in one or more parts, empty if there
    is none, before its other rows.
    """
    current = None
    for batch in batches:
        block, answers = batch.column("block").to_numpy(), batch.column(answer).is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (answers[1:] != answers[:-1])) + 1
        for start, end in itertools.pairwise([0, *cuts.tolist(), len(block)]):
            if start == end:
                continue
            if block[start] != current:
                current = block[start]
                yield True, batch.slice(start, 0)
            yield bool(answers[start]), batch.slice(start, end - start)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
