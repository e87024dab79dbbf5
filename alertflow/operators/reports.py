"""Reports over scored, alert and stored rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from alertflow.functions import text as txt
from alertflow.functions.times import as_moment, in_utc, naive_utc, utc, utc_time
from alertflow.operators.storage import type_folder


def positive_count(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction") == 1).agg(F.count(F.lit(1)).alias("n_positive"))


def _counters() -> list[Column]:
    """Counters over scored rows; all of them combine on the map side."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(txt.is_blank(F.col("text"))).alias("n_blank"),
        F.count_if(F.col("prediction") == 1).alias("n_positive"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    ]


def batch_metrics(scored: DataFrame) -> DataFrame:
    return scored.agg(*_counters())


def totals(kinds: DataFrame, times: Column | None = None) -> DataFrame:
    """The counters of ``batch_metrics`` over rows with the ``kind`` that ``routed`` gives, and two more for what has no score.

    ``times`` says how many rows each stands for, one by default.
    """
    def of(*names: str) -> Column:
        is_one = F.col("kind").isin(*names)
        return F.count_if(is_one) if times is None else F.coalesce(F.sum(F.when(is_one, times)), F.lit(0))

    return kinds.agg(
        of("blank", "quiet", "alert", "prediction_failed").alias("n_rows"), of("blank").alias("n_blank"), of("alert").alias("n_positive"),
        of("prediction_failed").alias("n_failed"), of("empty").alias("n_empty"), of("undecodable").alias("n_undecodable"),
    )


def observed(scored: DataFrame, observation: Observation | str) -> DataFrame:
    """The same counters, taken along the way by whatever action runs the frame.

    With a name, a streaming query reports them in its progress under that name.
    """
    return scored.observe(observation, *_counters())


#: Rows of a report whose keys are looked up as literals; longer ones are joined.
KEYS_LISTED = 1_000


def _first_rows(rows: DataFrame, n: int, order: Sequence[str], key: str, folder: str | None) -> DataFrame:
    """The first n rows by the given columns, descending, nulls last; ties go by the key.

    Two phases. The first reads what the order needs and no more, and brings n keys to the driver. The second
    reads whole rows, from the folders of these keys, and of these only row groups that may hold one.
    """
    order = [*order, key]
    by = [F.desc(c) for c in order]
    place = [folder] if folder in rows.columns else []
    keys = rows.select(*order, *place).orderBy(*by).limit(n)
    if n > KEYS_LISTED:
        same = F.struct(*order).alias("_order")
        return rows.withColumn("_order", F.struct(*order)).join(keys.select(same).distinct(), "_order", "left_semi").drop("_order").orderBy(*by).limit(n)
    found = keys.collect()
    wanted = _one_of(key, [row[key] for row in found])
    if place:
        wanted = wanted & _one_of(folder, [row[folder] for row in found])
    # Copies of a row have its key too.
    return rows.filter(wanted).orderBy(*by).limit(n)


def _one_of(column: str, values: Sequence) -> Column:
    known = F.col(column).isin([v for v in dict.fromkeys(values) if v is not None])
    return known | F.col(column).isNull() if None in values else known


def newest_folders(rows: DataFrame, folder: str, n: int) -> DataFrame:
    """The rows of as many of the newest folders as hold n rows, found without opening older ones.

    ``folder`` is the day column that names the folders of ``rows``; rows without a day come last.
    """
    names = {unquote(part.partition("=")[2]) for file in rows.inputFiles() for part in file.split("/") if part.startswith(f"{folder}=")}
    days = sorted((name for name in names if name[:1].isdigit()), reverse=True)
    count = 1
    while count < len(days):
        newest = rows.filter(F.col(folder) >= F.lit(days[count - 1]).cast("date"))
        if newest.select(folder).limit(n).count() >= n:
            return newest
        count *= 2
    return rows


def _shown(stored: DataFrame, time: str) -> DataFrame:
    preview = txt.preview(F.col("text")).alias("text_preview")
    return stored.select("tweet_id", "disaster_type", "location", "confidence", preview, time)


def latest_predictions(stored: DataFrame, n: int = 10) -> DataFrame:
    """The newest n stored rows."""
    rows = _first_rows(stored, n, ["processing_timestamp", "tweet_id"], "row_key", "event_day")
    return _shown(rows, "processing_timestamp")


def top_confidence(stored: DataFrame, n: int = 10) -> DataFrame:
    """The n most confident rows, newest first among equals."""
    rows = _first_rows(stored, n, ["confidence", "kafka_timestamp", "tweet_id"], "row_key", "event_day")
    return _shown(rows, "kafka_timestamp")


def latest_documents(documents: DataFrame, n: int = 10) -> DataFrame:
    """The newest n documents as display texts, with stand-ins for missing fields.

    Documents in folders by day are read from the newest folder on, until there are n.
    """
    if "processing_day" in documents.columns:
        documents = newest_folders(documents, "processing_day", n)
    narrow = documents.select(
        "processing_timestamp", "id", "disaster", "location", "confidence", txt.preview(F.col("text")).alias("text")
    )
    rest = [c for c in narrow.columns if c not in ("processing_timestamp", "id")]
    first = narrow.orderBy(*[F.desc(c) for c in ("processing_timestamp", "id", *rest)]).limit(n)
    time = F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss")
    return first.select(
        *[F.coalesce(c, F.lit("N/A")).alias(c) for c in ("id", "disaster", "location")],
        F.format_string("%.3f", F.coalesce("confidence", F.lit(0.0))).alias("confidence"),
        F.concat(F.coalesce("text", F.lit("")), F.lit("...")).alias("text"),
        F.coalesce(time, F.lit("N/A")).alias("timestamp"),
    )


def by_type(stored: DataFrame, disaster_type: str) -> DataFrame:
    """Rows of one type; in files by type only its folder is read."""
    rows = stored.filter(F.col("disaster_type") == disaster_type)
    if "type_folder" in stored.columns:
        rows = rows.filter(F.col("type_folder") == type_folder(F.lit(disaster_type)))
    return rows


def by_location(stored: DataFrame, location: str) -> DataFrame:
    return stored.filter(F.col("location") == location)


def confident(stored: DataFrame, at_least: float) -> DataFrame:
    return stored.filter(F.col("confidence") >= F.lit(at_least).cast("decimal(5,4)"))


def time_range(stored: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= kafka_timestamp < end, newest first.

    Bounds with a zone are moved to UTC. On stored files the day bounds prune partitions before
    any row is read.
    """
    start, end = naive_utc(start), naive_utc(end)
    t = F.col("kafka_timestamp")
    rows = stored.filter((t >= utc_time(start)) & (t < utc_time(end)))
    if "event_day" in stored.columns:
        rows = rows.filter(F.col("event_day").between(F.lit(start.date()), F.lit(end.date())))
    return rows.orderBy(F.desc("kafka_timestamp"), F.desc("tweet_id"), F.desc("row_key"))


def type_by_window(
    df: DataFrame,
    width: str = "1 hour",
    timestamp: str = "kafka_timestamp",
    kind: str = "disaster_type",
    measure: str = "confidence",
    watermark: str | None = None,
) -> DataFrame:
    """Count, total and mean of a measure per type and time window.

    The measure is summed as a decimal, so that the result does not depend on the order in
    which tasks finish. Windows begin at full units of UTC. On a stream, ``watermark`` says how
    late a row may come.
    """
    if watermark is None:
        df = in_utc(df, timestamp)
        shown = lambda bound: bound
    else:
        # A watermark needs moments; everything else is cheaper on zone-less times.
        df = as_moment(df, timestamp).withWatermark(timestamp, watermark)
        shown = utc
    n = F.count(F.lit(1))
    total = F.sum(F.col(measure).cast("decimal(18,4)")).cast("double")
    return (
        df.groupBy(F.window(timestamp, width).alias("w"), F.col(kind).alias("type"))
        .agg(n.alias("n"), total.alias("total"), F.count(measure).alias("n_measured"))
        .select(
            shown(F.col("w.start")).alias("window_start"),
            shown(F.col("w.end")).alias("window_end"),
            "type",
            "n",
            "total",
            F.try_divide("total", "n_measured").alias("mean"),
        )
    )
