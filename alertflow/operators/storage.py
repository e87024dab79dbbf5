"""From alerts to rows of the prediction store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.functions.keys import row_key
from alertflow.functions.times import in_utc, utc
from alertflow.operators.messages import expand
from alertflow.schemas import CONFIDENCE, MAX_DISASTER_TYPE, MAX_LOCATION, MAX_TWEET_ID, STORED

# Alert field -> stored column.
STORED_NAMES = {"id": "tweet_id", "disaster": "disaster_type"}


def surrogate_id(df: DataFrame) -> DataFrame:
    """Add a row key that a replay of the same message gets again, in any time zone."""
    return in_utc(df, "kafka_timestamp").select(row_key("id", "kafka_timestamp", "text").alias("row_key"), "*")


def stamped(df: DataFrame) -> DataFrame:
    """Add the two storage times where the caller has not set them; one UTC value per (micro-)batch."""
    now = utc(F.current_timestamp())
    missing = [c for c in ("processing_timestamp", "created_at") if c not in df.columns]
    return df.select("*", *[now.alias(c) for c in missing])


def type_folder(disaster_type: Column) -> Column:
    """Folder name of an event type; null and empty types, which make no folder name, share one."""
    return F.coalesce(F.nullif(disaster_type, F.lit("")), F.lit("(no type)"))


def _broken_rules(text_times: bool) -> Column:
    """Names of the storage rules that the alert on this row breaks."""
    too_long = {
        "tweet_id_too_long": ("id", MAX_TWEET_ID),
        "disaster_type_too_long": ("disaster", MAX_DISASTER_TYPE),
        "location_too_long": ("location", MAX_LOCATION),
    }
    rules = {
        "text_missing": F.col("text").isNull(),
        **{name: F.length(column) > width for name, (column, width) in too_long.items()},
        "confidence_out_of_range": F.col("confidence").isNotNull()
        & F.col("confidence").try_cast(CONFIDENCE).isNull(),
    }
    if text_times:
        time = F.col("kafka_timestamp")
        rules["kafka_timestamp_unreadable"] = time.isNotNull() & time.try_cast("timestamp_ntz").isNull()
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def checked(alerts: DataFrame) -> DataFrame:
    """Alerts with an array ``broken_rules``, worked out once; empty means the row fits the store."""
    text_times = dict(alerts.dtypes)["kafka_timestamp"] == "string"
    return expand(alerts, F.struct(_broken_rules(text_times).alias("broken_rules")))


def storage_rows(checked_alerts: DataFrame) -> DataFrame:
    """The rows that fit, renamed and narrowed to the stored types."""
    fit = stamped(surrogate_id(checked_alerts.filter(F.size("broken_rules") == 0)))
    renamed = fit.withColumnsRenamed(STORED_NAMES)
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED.fields])


def quarantine_rows(checked_alerts: DataFrame) -> DataFrame:
    """The rows that do not fit, as they came, with the reasons."""
    return checked_alerts.filter(F.size("broken_rules") > 0).withColumn(
        "reason", F.array_join("broken_rules", ",")
    ).drop("broken_rules")
