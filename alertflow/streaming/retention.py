"""Keeping the shared folder of a fan-out small: files go when every sink has committed them.

What a sink has read is in its checkpoint: the file source logs each file with the number of its own batch, and the
offsets of the last committed micro-batch say up to which of these it has come. A file that all sinks are past is counted by kind,
so that totals stay, and deleted. A crash between the two leaves a file that is counted once all the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.operators.reports import totals

#: Files that one call deletes at most, since the driver deletes them one by one; the next call goes on.
FILES_AT_ONCE = 10_000
_LOG = "path string, timestamp long, batchId long"
_COUNTS = "file string, kind string, n long"


def _system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The batches that have a file in a folder of a checkpoint."""
    root, system = _system(spark, folder)
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    return sorted(int(name) for name in names if name.isdigit())


def committed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path) of the source files that a query with one file source has committed."""
    checkpoint = checkpoint.rstrip("/")
    done = _numbers(spark, f"{checkpoint}/commits")
    if not done:
        return spark.createDataFrame([], "path string")
    offsets = spark.read.text(f"{checkpoint}/offsets/{done[-1]}", wholetext=True).first()[0]
    reached = F.from_json(F.element_at(F.split(F.lit(offsets), "\n"), -1), "logOffset long")["logOffset"]
    entries = spark.read.text(f"{checkpoint}/sources/0").filter(F.col("value").startswith("{"))
    return entries.select(F.from_json("value", _LOG).alias("e")).filter(F.col("e.batchId") <= reached).select("e.path").distinct()


def retire(spark: SparkSession, path: str, checkpoints: Sequence[str], counts: str, most: int = FILES_AT_ONCE) -> int:
    """Delete files of ``path`` that all queries with these checkpoints have committed; how many went.

    The rows of each file are counted by kind into the folder ``counts`` first. ``totals_so_far`` reads both.
    """
    all_read = reduce(lambda a, b: a.join(b, "path", "left_semi"), [committed_files(spark, c) for c in checkpoints])
    names = all_read.select("path", F.element_at(F.split("path", "/"), -1).alias("file"))
    there = _rows(spark, path).groupBy("file", "kind").agg(F.count(F.lit(1)).alias("n"))
    going = [row[0] for row in names.join(there, "file", "left_semi").orderBy("path").limit(most).select("path").collect()]
    if not going:
        return 0
    files = spark.createDataFrame([(p.rsplit("/", 1)[1],) for p in going], "file string")
    new = there.join(files, "file", "left_semi")
    known = _counted(spark, counts)
    new.join(known.select("file"), "file", "left_anti").write.mode("append").parquet(counts)
    _, system = _system(spark, path)
    for name in going:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)), False)
    return len(going)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    # The folder's log names files that are gone.
    rows = spark.read.schema("kind string, kafka_timestamp timestamp_ntz").option("ignoreMissingFiles", "true").parquet(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "kind")


def _counted(spark: SparkSession, counts: str) -> DataFrame:
    root, system = _system(spark, counts)
    if not system.exists(root):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(counts)


def totals_so_far(spark: SparkSession, path: str, counts: str) -> DataFrame:
    """``running_totals`` of a folder whose old files may be gone."""
    before = _counted(spark, counts)
    left = _rows(spark, path).join(before.select("file").distinct(), "file", "left_anti").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    both = left.unionByName(before.select("kind", "n"))
    return totals(both.groupBy("kind").agg(F.sum("n").alias("n")), F.col("n"))
