"""The main plan: message envelopes in, alerts out. One function for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.functions import text as txt
from alertflow.functions.times import in_utc
from alertflow.operators.extraction import Extractor, extract_fields
from alertflow.operators.messages import expand, nonempty_text, parse_messages, positives
from alertflow.operators.reports import observed
from alertflow.operators.scoring import Scorer, score_text
from alertflow.schemas import ALERT, ALERT_MESSAGE, EXTRACTION


def scored_messages(envelopes: DataFrame, scorer: Scorer) -> DataFrame:
    """Decoded messages that have a text, with their score."""
    return score_text(nonempty_text(parse_messages(envelopes, ALERT_MESSAGE)), scorer)


def alerts(
    envelopes: DataFrame,
    scorer: Scorer,
    extractor: Extractor,
    counters: Observation | str | None = None,
) -> DataFrame:
    """Positive messages with location and event type; their times zone-less, in UTC.

    No shuffle: a scan, one JSON parse, one score and, for positives only, one extraction.
    With ``counters``, rows, blanks, positives and failures are counted along the way.
    """
    scored = scored_messages(envelopes, scorer)
    if counters is not None:
        scored = observed(scored, counters)
    found = extract_fields(positives(scored), extractor)
    return in_utc(found, "kafka_timestamp").select(*ALERT.names)


# What becomes of an envelope. The first two are dead letters.
UNDECODABLE, FAILED, EMPTY, BLANK, QUIET, ALERTED = "undecodable", "prediction_failed", "empty", "blank", "quiet", "alert"

BROKEN = "_broken"
MARKED_MESSAGE = T.StructType([*ALERT_MESSAGE.fields, T.StructField(BROKEN, T.StringType())])


def routed(envelopes: DataFrame, scorer: Scorer, extractor: Extractor | None = None) -> DataFrame:
    """One row per envelope with ``kind``, what became of it, in one scan with one JSON parse and one score.

    The fields of ``ALERT`` are filled for alerts; ``payload`` for dead letters: the envelope's value as text, or the text that
    the scorer failed on. Others carry their kind only, so they cost next to nothing in a table. Without an extractor no
    place and type are looked for.
    """
    value = F.col("value").cast("string")
    parsed = expand(
        envelopes.select(value.alias("_value"), F.col("timestamp").alias("kafka_timestamp")),
        F.from_json("_value", MARKED_MESSAGE, {"columnNameOfCorruptRecord": BROKEN}),
    )
    # An array of objects would be read as its first one.
    decoded = F.coalesce(F.col("_value").rlike(r"\A\s*\{") & F.col(BROKEN).isNull(), F.lit(False))
    opened = parsed.select("_value", "kafka_timestamp", decoded.alias("_decoded"), "id", "text")
    scored = score_text(opened, scorer)
    empty = F.col("text").isNull() | (F.col("text") == "")
    kind = (
        F.when(~F.col("_decoded"), UNDECODABLE)
        .when(empty, EMPTY)
        .when(~F.col("ok"), FAILED)
        .when(F.col("prediction") == 1, ALERTED)
        .when(txt.is_blank(F.col("text")), BLANK)
        .otherwise(QUIET)
    )
    sorted_out = scored.withColumn("kind", kind)
    is_alert, is_dead = F.col("kind") == ALERTED, F.col("kind").isin(UNDECODABLE, FAILED)
    if extractor is not None:
        found = F.when(is_alert, extractor(F.when(is_alert, F.col("text"))))
    else:
        found = F.lit(None).cast(EXTRACTION)
    fields = expand(sorted_out, F.struct(found.alias("_found")))
    kept = {
        "id": F.when(is_alert | (F.col("kind") == FAILED), F.col("id")),
        "text": F.when(is_alert, F.col("text")),
        "disaster": F.col("_found.disaster"),
        "location": F.col("_found.location"),
        "confidence": F.when(is_alert, F.col("confidence")),
        "kafka_timestamp": F.when(is_alert | is_dead, F.col("kafka_timestamp")),
    }
    payload = F.when(F.col("kind") == UNDECODABLE, F.col("_value")).when(F.col("kind") == FAILED, F.col("text"))
    rows = fields.select("kind", *[kept[name].alias(name) for name in ALERT.names], payload.alias("payload"))
    return in_utc(rows, "kafka_timestamp")


def dead_letters(routed_rows: DataFrame) -> DataFrame:
    """The rows of ``routed`` that hold no JSON object or whose prediction failed, with the reason."""
    dead = routed_rows.filter(F.col("kind").isin(UNDECODABLE, FAILED))
    return dead.select(F.col("kind").alias("reason"), "id", "payload", "kafka_timestamp")


def alert_rows(routed_rows: DataFrame) -> DataFrame:
    return routed_rows.filter(F.col("kind") == ALERTED).select(*ALERT.names)


def failed_rows(envelopes: DataFrame, scorer: Scorer) -> DataFrame:
    """Dead letters: envelopes that hold no JSON object, and messages whose prediction failed.

    ``payload`` is the envelope's value as text, or the text that the scorer failed on.
    """
    return dead_letters(routed(envelopes, scorer))
