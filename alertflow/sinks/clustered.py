"""A store laid out for look-ups by type, place and confidence alike, without an index to keep.

Rows are ranged along a curve that interleaves the ranks of all three columns, so every file holds a small box of them
whichever column is asked for. A table beside the files has one row per file with the bounds of the box; a look-up
reads that first and then only the files whose box it meets. ``files_met`` tells how many these are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.schemas import STORED
from alertflow.sources.store import sub_folders
from alertflow.streaming.scratch import new_folder, remove_folder

#: Columns that look-ups filter by, and bits of the rank of each on the curve.
CLUSTERED = ("disaster_type", "location", "confidence")
RANK_BITS = 6
ROWS_PER_FILE = 1_000_000
#: Files of fewer rows than that are no more than so many: each costs a task when written and when looked up, and its name goes to the driver.
FILES_MOST = 1024
_FILES, _BOXES = "files", "boxes"


def _number(column: str, kind: str) -> Column:
    """A number in the order of the column; of texts, that of their first seven bytes. Nulls come first."""
    if kind != "string":
        return F.coalesce(F.col(column).cast("double"), F.lit(float("-inf")))
    first = F.rpad(F.substring(F.hex(F.encode(column, "utf-8")), 1, 14), 14, "0")
    return F.coalesce(F.conv(first, 16, 10).cast("double"), F.lit(-1.0))


def on_curve(rows: DataFrame, columns: Sequence[str] = CLUSTERED) -> DataFrame:
    """``rows`` with ``_place``, the place on the curve: the bits of the ranks of the columns in turn, highest first.

    Ranks are by quantiles, found in one pass with sketches of fixed size. A value that many rows have is several quantiles, and
    takes its share of the ranks, so each column uses all its bits.
    """
    kinds = dict(rows.dtypes)
    numbers = {c: _number(c, kinds[c]) for c in columns}
    steps = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    found = rows.agg(*[F.percentile_approx(numbers[c], steps, 10_000).alias(c) for c in columns]).first()
    ranks = {f"_rank_{c}": _rank(numbers[c], found[c] or []) for c in columns}
    place = F.lit(0).cast("long")
    for level in reversed(range(RANK_BITS)):
        for name in ranks:
            place = place * 2 + F.shiftright(name, level).bitwiseAND(F.lit(1))
    return rows.withColumns(ranks).withColumn("_place", place).drop(*ranks)


def _rank(value: Column, bounds: list[float]) -> Column:
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= value))


def file_count(rows: int, rows_per_file: int) -> int:
    """How many files so many rows make: beyond ``FILES_MOST`` files hold more rows, up to ``ROWS_PER_FILE`` of them."""
    full = -(-rows // max(rows_per_file, ROWS_PER_FILE))
    return max(1, full, min(-(-rows // rows_per_file), FILES_MOST))


def write_clustered(stored: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write stored rows as a clustered store of its own; new rows go into another one, or all are written anew.

    The rows are worked out once, into a table in the shared folder, which is counted, ranked and shuffled by range; one more
    pass over three columns finds the boxes of the files.
    """
    folder = new_folder(stored.sparkSession, "clustered")
    try:
        stored.select(*STORED.names).write.parquet(folder)
        _write_placed(stored.sparkSession.read.schema(STORED).parquet(folder), path, rows_per_file)
    finally:
        remove_folder(stored.sparkSession, folder)


def _write_placed(rows: DataFrame, path: str, rows_per_file: int) -> None:
    files = file_count(rows.count(), rows_per_file)
    placed = on_curve(rows).repartitionByRange(files, "_place", "row_key").sortWithinPartitions("_place", *CLUSTERED)
    placed.drop("_place").write.parquet(f"{path}/{_FILES}")
    spark = rows.sparkSession
    written = spark.read.schema(STORED).parquet(f"{path}/{_FILES}").select(*CLUSTERED, F.col("_metadata.file_name").alias("file"))
    bounds = [part(c).alias(f"{name}_{c}") for c in CLUSTERED for name, part in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in CLUSTERED]
    boxes = written.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds, *nulls)
    boxes.coalesce(1).write.parquet(f"{path}/{_BOXES}")


def _meets(wanted: Mapping[str, object], at_least: Mapping[str, object]) -> Column:
    met = F.lit(True)
    for c, value in wanted.items():
        met = met & ((F.col(f"nulls_{c}") > 0) if value is None else F.lit(value).between(F.col(f"min_{c}"), F.col(f"max_{c}")))
    for c, value in at_least.items():
        met = met & (F.col(f"max_{c}") >= F.lit(value))
    return met


def files_met(spark: SparkSession, path: str, wanted: Mapping[str, object], at_least: Mapping[str, object] | None = None) -> list[str]:
    """The files of the store that may hold such rows."""
    met = spark.read.parquet(f"{path}/{_BOXES}").filter(_meets(wanted, at_least or {}))
    return [f"{path}/{_FILES}/{row['file']}" for row in met.select("file").orderBy("file").collect()]


def read_clustered(
    spark: SparkSession,
    path: str,
    wanted: Mapping[str, object] | None = None,
    at_least: Mapping[str, object] | None = None,
) -> DataFrame:
    """Stored rows whose columns have the ``wanted`` values, null included, and are ``at_least`` so much; all rows by default."""
    wanted, at_least = wanted or {}, at_least or {}
    unknown = [c for c in (*wanted, *at_least) if c not in CLUSTERED]
    if unknown:
        raise ValueError(f"the store is not clustered by {unknown}")
    if not sub_folders(spark, path, _FILES):
        raise ValueError(f"no clustered store in {path}")
    kinds = {f.name: f.dataType for f in STORED.fields}
    files = files_met(spark, path, wanted, at_least)
    rows = spark.read.schema(STORED).parquet(*files) if files else spark.createDataFrame([], STORED)
    for c, value in wanted.items():
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(value).cast(kinds[c])))
    for c, value in at_least.items():
        rows = rows.filter(F.col(c) >= F.lit(value).cast(kinds[c]))
    return rows
