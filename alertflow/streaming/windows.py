"""Windowed reports of a stream that miss nothing: parts are written, windows are merged when read.

A watermark drops rows that come too late and holds back the windows that are still open. Here no micro-batch
needs to know another: each writes what it adds to its windows, one row per window and type, and a reader sums
these parts. A late row is one more part of an old window, the newest window is there after its first batch, and
there is no state to keep. The parts are written by the file sink, so each batch counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from alertflow.functions.times import in_utc, naive_utc, utc_time
from alertflow.streaming.jobs import FILE_TRIGGER, paced

#: Groups after which a task hands on what it has added up.
HELD_GROUPS = 100_000

PART = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("type", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DecimalType(38, 4)),
        T.StructField("n_measured", T.LongType()),
    ]
)
WINDOW_DAY = T.StructField("window_day", T.DateType())
_KEYS = ["window_start", "window_end", "type"]
_SUMS = ["n", "total", "n_measured"]


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        whole = pa.concat_tables(held)
        out = whole.group_by(_KEYS, use_threads=False).aggregate([(c, "sum") for c in _SUMS])
        out = out.select([*_KEYS, *(f"{c}_sum" for c in _SUMS)]).rename_columns([*_KEYS, *_SUMS])
        return out.cast(whole.schema)

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(part.num_rows for part in held) > HELD_GROUPS:
            held[:] = [summed()]
            if held[0].num_rows > HELD_GROUPS // 2:
                yield from held.pop().to_batches()
    if held:
        yield from summed().to_batches()


def window_parts(
    events: DataFrame,
    width: str = "1 hour",
    timestamp: str = "kafka_timestamp",
    kind: str = "disaster_type",
    measure: str = "confidence",
) -> DataFrame:
    """What these rows add to their windows; works alike on a batch and on each micro-batch of a stream.

    Rows are added up where they are read, and only sums are shuffled. Rows without a time are in no window.
    """
    rows = in_utc(events, timestamp).filter(F.col(timestamp).isNotNull())
    value = F.col(measure).cast("decimal(18,4)").cast(PART["total"].dataType)
    one = rows.select(
        F.window(timestamp, width).alias("w"), F.col(kind).cast("string").alias("type"), F.lit(1).cast("long").alias("n"),
        F.coalesce(value, F.lit(0).cast(PART["total"].dataType)).alias("total"), F.col(measure).isNotNull().cast("long").alias("n_measured"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "type", *_SUMS)
    local = one.mapInArrow(_added_up, PART)
    return local.repartition("window_start", "type").mapInArrow(_added_up, PART)


def start_windows(events: DataFrame, path: str, checkpoint: str, every: str | None = FILE_TRIGGER, **report) -> StreamingQuery:
    """Write the parts of every micro-batch, in folders by the day of the window; ``report`` goes to ``window_parts``."""
    parts = window_parts(events, **report).withColumn(WINDOW_DAY.name, F.to_date("window_start"))
    writer = parts.writeStream.outputMode("append").format("parquet").partitionBy(WINDOW_DAY.name)
    return paced(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def merged(parts: DataFrame) -> DataFrame:
    """The windows that parts make up, as ``type_by_window`` gives them."""
    summed = parts.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("total").alias("_total"), F.sum("n_measured").alias("n_measured"))
    total = F.when(F.col("n_measured") > 0, F.col("_total").cast("double")).alias("total")
    return summed.select(*_KEYS, "n", total, "n_measured").select(
        *_KEYS, "n", "total", F.try_divide("total", "n_measured").alias("mean")
    )


def read_windows(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """All windows so far, open ones included; with bounds, those that begin in [start, end), from their folders only."""
    parts = spark.read.schema(T.StructType([*PART.fields, WINDOW_DAY])).parquet(path)
    for bound, before in ((start, False), (end, True)):
        if bound is not None:
            time, begins, day = naive_utc(bound), F.col("window_start"), F.col(WINDOW_DAY.name)
            parts = parts.filter(begins < utc_time(time) if before else begins >= utc_time(time))
            parts = parts.filter(day <= F.lit(time.date()) if before else day >= F.lit(time.date()))
    return merged(parts)
