"""Message steps: decode, flatten, clean, label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.functions.codec import decode_message, encode_message
from alertflow.functions.times import in_utc
from alertflow.schemas import MESSAGE


def expand(df: DataFrame, struct: Column) -> DataFrame:
    """Add the fields of ``struct`` as columns, working it out exactly once per row.

    A filter on a field of a plain projection is pushed below it and the struct, a JSON parse
    or a model call, is computed there a second time. Filters stop at a generator.
    """
    return df.select("*", F.inline(F.array(struct)))


def encode_messages(df: DataFrame, timestamp: Column | str = "kafka_timestamp") -> DataFrame:
    """Rows to message envelopes: ``value`` (JSON bytes) and ``timestamp``."""
    named = isinstance(timestamp, str)
    stamp = F.col(timestamp) if named else timestamp
    fields = [c for c in df.columns if not (named and c == timestamp)]
    return df.select(encode_message(*fields).alias("value"), stamp.alias("timestamp"))


def parse_messages(envelopes: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Message fields plus ``kafka_timestamp``, one row per envelope."""
    return envelopes.select(
        F.inline(F.array(decode_message(F.col("value"), schema))),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_messages_explicit(envelopes: DataFrame) -> DataFrame:
    """Messages that have a text, with the fields and the order that ``MESSAGE`` lists."""
    return nonempty_text(parse_messages(envelopes)).select(*MESSAGE.names, "kafka_timestamp")


def undecodable(envelopes: DataFrame) -> DataFrame:
    """Envelopes whose value is not a JSON object."""
    return envelopes.filter(F.json_object_keys(F.col("value").cast("string")).isNull())


def nonempty_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop null and empty texts; white space alone counts as text here."""
    return df.filter(F.col(text).isNotNull() & (F.col(text) != ""))


def positives(df: DataFrame) -> DataFrame:
    return df.filter(F.col("prediction") == 1)


def processed_rows(scored: DataFrame) -> DataFrame:
    """The wide text-typed view of scored messages, with a class label and times in UTC."""
    # Order and names of the columns, the two labels, the formats.
    return in_utc(scored, "kafka_timestamp").select(
        "id",
        "keyword",
        "location",
        "text",
        "prediction",
        F.format_string("%.4f", "confidence").alias("confidence"),
        F.when(F.col("prediction") == 1, "DISASTER").otherwise("NOT_DISASTER").alias("disaster_label"),
        F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )
