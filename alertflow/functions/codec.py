"""JSON messages and the packed score text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.schemas import EXTRACTION, MESSAGE

# Fixed value: the packed score of a blank text.
BLANK_PACKED = "0,0.0"


def encode_message(*columns: Column | str) -> Column:
    """UTF-8 JSON bytes of the given columns; null fields are written, as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")


def decode_message(value: Column, schema: T.StructType = MESSAGE) -> Column:
    """Struct of the message fields; malformed JSON gives a struct of nulls."""
    return F.from_json(value.cast("string"), schema)


def decode_extraction(response: Column) -> Column:
    """struct<location, disaster> of an extractor's answer; malformed answers give nulls."""
    return F.from_json(response, EXTRACTION)


def pack_score(prediction: Column, confidence: Column) -> Column:
    return F.concat_ws(",", prediction.cast("string"), F.format_string("%.4f", confidence))


def unpack_score(packed: Column) -> Column:
    """struct<prediction, confidence>; null where a part is missing or not a number."""
    parts = F.split(packed, ",")
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("int").alias("prediction"),
        F.get(parts, F.lit(1)).try_cast("double").alias("confidence"),
    )
