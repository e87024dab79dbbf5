"""Session settings for the jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins and shuffles are sized, and skewed partitions split, at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Message times carry no zone; window bounds must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # Texts may be long, so the batches that go to a Python model are bounded in bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # A crash inside a model's native code shows a traceback.
    "spark.sql.execution.pyspark.udf.faulthandler.enabled": "true",
    "spark.python.worker.faulthandler.enabled": "true",
}


def open_session(name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """The running session, or a new one with these settings; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
