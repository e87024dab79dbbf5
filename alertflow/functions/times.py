"""Moments and zone-less times, exchanged by arithmetic in UTC, whatever the session's time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def naive_utc(value: datetime) -> datetime:
    """The value as a clock in UTC shows it; one without a zone is taken to be that already."""
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def utc_time(value: datetime) -> Column:
    """A zone-less literal. A datetime as such would be taken for local time and moved."""
    return F.lit(naive_utc(value).isoformat(sep=" ")).cast("timestamp_ntz")


def utc(moment: Column) -> Column:
    """TIMESTAMP to the TIMESTAMP_NTZ that a clock in UTC shows."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), utc_time(datetime(1970, 1, 1)))


def moment(time: Column) -> Column:
    """TIMESTAMP_NTZ, read as UTC, to TIMESTAMP.

    Worked out from the parts: a cast goes through the session's zone, where some times of day
    do not exist on the day the clocks change.
    """
    days = F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(time)) * 60 + F.minute(time)
    micros_in_minute = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")
    return F.timestamp_micros(minutes * 60_000_000 + micros_in_minute)


def in_utc(df: DataFrame, column: str) -> DataFrame:
    """Make a TIMESTAMP column zone-less; columns of other types stay as they are."""
    return df.withColumn(column, utc(F.col(column))) if dict(df.dtypes)[column] == "timestamp" else df


def as_moment(df: DataFrame, column: str) -> DataFrame:
    """Make a zone-less column a TIMESTAMP; columns of other types stay as they are."""
    return df.withColumn(column, moment(F.col(column))) if dict(df.dtypes)[column] == "timestamp_ntz" else df
