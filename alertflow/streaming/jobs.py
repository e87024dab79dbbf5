"""Streaming queries: sinks, fan-out, waiting.

Every query has its own checkpoint folder. File sinks are exactly-once; ``foreachBatch`` sinks
may see a batch twice after a failure, so their writers replace what the batch wrote before.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from alertflow.operators.reports import totals
from alertflow.operators.storage import checked, quarantine_rows, storage_rows
from alertflow.sinks.stores import BLOOM, with_folder, write_files
from alertflow.sources.store import read_runs

# Pace of the file and the store sink, rows shown on the console.
FILE_TRIGGER = "20 seconds"
STORE_TRIGGER = "15 seconds"
CONSOLE_ROWS = 10

# How long a running stream remembers the keys it has seen.
REMEMBERED = "1 day"

BatchWriter = Callable[[DataFrame, int], None]


def paced(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A processing-time trigger, or with None one run over all there is."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def start_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    file_format: str = "json",
) -> StreamingQuery:
    """Append to a folder of files; started again on its checkpoint it goes on where it stopped."""
    writer = df.writeStream.outputMode("append").format(file_format)
    return paced(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def start_store(alerts: DataFrame, path: str, checkpoint: str, every: str | None = FILE_TRIGGER) -> StreamingQuery:
    """Append the alerts that fit to stored files in folders by day."""
    rows = with_folder(storage_rows(checked(alerts)))
    writer = rows.writeStream.outputMode("append").format("parquet").partitionBy("event_day").options(**BLOOM)
    return paced(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def start_new_rows(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    remember: str = REMEMBERED,
    since: date | None = None,
) -> StreamingQuery:
    """``start_store`` for feeds that may be sent again: a message that the store has is not added.

    A running stream remembers the row keys of the last ``remember`` of its own clock, so no message is late for it,
    whatever time it carries. Messages of earlier runs, those of other checkpoints, are looked up in what the store held when the
    query started, from the days after ``since`` on. Each run writes a folder of its own below ``path``; ``read_runs`` reads them all.
    """
    spark = alerts.sparkSession
    rows = storage_rows(checked(alerts)).withColumn("_arrived", F.current_timestamp())
    rows = rows.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["row_key"]).drop("_arrived")
    known = read_runs(spark, path)
    if since is not None:
        known = known.filter((F.col("event_day") >= F.lit(since)) | F.col("event_day").isNull())
    new = with_folder(rows).join(known.select("row_key"), "row_key", "left_anti")
    writer = new.writeStream.outputMode("append").format("parquet").partitionBy("event_day").options(**BLOOM)
    folder = f"{path.rstrip('/')}/run={run_id(spark, checkpoint)}"
    return paced(writer.option("path", folder).option("checkpointLocation", checkpoint), every).start()


def start_quarantine(alerts: DataFrame, path: str, checkpoint: str, every: str | None = FILE_TRIGGER) -> StreamingQuery:
    """Append the alerts that do not fit the store, with the reasons."""
    return start_files(quarantine_rows(checked(alerts)), path, checkpoint, every)


def start_console(
    df: DataFrame,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    rows: int = CONSOLE_ROWS,
) -> StreamingQuery:
    """Print the first rows of every micro-batch."""
    writer = df.writeStream.outputMode("append").format("console").options(truncate="false", numRows=rows)
    return paced(writer.option("checkpointLocation", checkpoint), every).start()


def start_kafka(
    envelopes: DataFrame,
    options: dict[str, str],
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
) -> StreamingQuery:
    """Send envelopes to a topic; ``options`` come from ``kafka_write_options``."""
    writer = envelopes.select("value").writeStream.format("kafka").options(**options)
    return paced(writer.option("checkpointLocation", checkpoint), every).start()


def start_batches(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    every: str | None = STORE_TRIGGER,
) -> StreamingQuery:
    """Hand every micro-batch to a writer, for stores that have no streaming sink."""
    writer = df.writeStream.outputMode("append").foreachBatch(write)
    return paced(writer.option("checkpointLocation", checkpoint), every).start()


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that this checkpoint belongs to, made on first use and kept in its folder.

    Batch ids start again at 0 with a new checkpoint, so only run and batch together name a batch.
    """
    folder = f"{checkpoint.rstrip('/')}/run"
    for mode in ("ignore", "overwrite"):
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("run")).coalesce(1).write.mode(mode).text(folder)
        kept = spark.read.text(folder).first()
        if kept is not None:
            return kept[0]
    raise OSError(f"no run id can be kept in {folder}")


def file_batch_writer(path: str, quarantine_path: str, run: str) -> BatchWriter:
    """Micro-batches of alerts into stored files, in folders by day, and a quarantine.

    ``run`` comes from ``run_id``. A batch of a run owns one sub-folder and overwrites it, so the
    same batch written twice is there once and no other run's rows are touched. ``read_files``
    reads the folder; other writers need a folder of their own. The batch is persisted for its
    two outputs, so it is scored once; a lost block is worked out again from the source.
    """

    def write(alerts: DataFrame, batch_id: int) -> None:
        rows = checked(alerts).persist()
        try:
            below = f"run={run}/batch_id={batch_id}"
            write_files(storage_rows(rows), f"{path}/{below}", mode="overwrite")
            quarantine_rows(rows).write.mode("overwrite").parquet(f"{quarantine_path}/{below}")
        finally:
            rows.unpersist()

    return write


def jdbc_batch_writer(
    read: Callable[[SparkSession], DataFrame],
    write: Callable[[DataFrame], None],
    run: str,
) -> BatchWriter:
    """Micro-batches of alerts into a database table that also has columns ``run`` and ``batch_id``.

    A database commits per task, so a failed batch may be there in part. When it comes again,
    each row key is added as often as it is still missing: copies of a message stay copies.
    """

    def append(alerts: DataFrame, batch_id: int) -> None:
        rows = storage_rows(checked(alerts)).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
        mine = (F.col("run") == run) & (F.col("batch_id") == batch_id)
        there = read(alerts.sparkSession).filter(mine).select("row_key")
        if there.isEmpty():
            write(rows)
            return
        wanted = rows.groupBy("row_key").agg(
            F.count(F.lit(1)).alias("n"), F.first(F.struct(*rows.columns)).alias("row")
        )
        written = there.groupBy("row_key").agg(F.count(F.lit(1)).alias("n_written"))
        missing = F.col("n") - F.coalesce("n_written", F.lit(0))
        left = wanted.join(written, "row_key", "left").select("row", missing.alias("n")).filter("n > 0")
        write(left.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("row.*"))

    return append


def start_fan_out(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    sinks: Iterable[Callable[[DataFrame], StreamingQuery]],
    every: str | None = FILE_TRIGGER,
) -> list[StreamingQuery]:
    """Score once, serve many: alerts go to files, and every sink is a stream over those files.

    Queries started on one scored frame would each read the source and score every message for
    themselves, and could disagree. Here all of them see the same rows, each with its own
    progress. With ``every`` None the files are complete before the sinks start.
    """
    first = start_files(alerts, path, checkpoint, every, "parquet")
    if every is None:
        first.awaitTermination()
    shared = alerts.sparkSession.readStream.schema(alerts.schema).parquet(path)
    return [first, *[start(shared) for start in sinks]]


def start_routed(
    routed_rows: DataFrame,
    path: str,
    checkpoint: str,
    sinks: Iterable[Callable[[DataFrame], StreamingQuery]],
    every: str | None = FILE_TRIGGER,
) -> list[StreamingQuery]:
    """``start_fan_out`` of all that became of the messages, in folders by kind; every sink gets the rows of ``routed``.

    A sink that filters by kind reads that folder only. What is written here counts once, whatever batch is
    tried again and however often the query is stopped, so ``running_totals`` of this folder are exact.
    """
    writer = routed_rows.writeStream.outputMode("append").format("parquet").partitionBy("kind")
    first = paced(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()
    if every is None:
        first.awaitTermination()
    spark = routed_rows.sparkSession
    return [first, *[start(spark.readStream.schema(routed_rows.schema).parquet(path)) for start in sinks]]


def running_totals(spark: SparkSession, path: str) -> DataFrame:
    """What became of all messages so far, one row; counts come from the folders' names and the files' row counts."""
    kinds = spark.read.schema("kind string, kafka_timestamp timestamp_ntz").parquet(path)
    return totals(kinds.select("kind"))


def wait(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait for the query to end, for so long at most; it runs on if it has not ended."""
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))


def run_all(
    queries: Iterable[StreamingQuery],
    poll_seconds: float = 1.0,
    report: Callable[[], None] | None = None,
    report_seconds: float = 20.0,
) -> None:
    """Wait until any query ends, then stop all; the failure of any one is raised.

    Waiting for the first query, then the second, would hide a failure of the second. Meanwhile ``report`` is called every
    ``report_seconds``.
    """
    queries = list(queries)
    due = time.monotonic() + report_seconds
    try:
        while all(query.isActive for query in queries):
            time.sleep(poll_seconds)
            if report is not None and time.monotonic() >= due:
                report()
                due = time.monotonic() + report_seconds
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        failure = query.exception()
        if failure is not None:
            raise failure
