"""Writing message envelopes to Kafka, or to files in its stead."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def kafka_write_options(servers: str | Iterable[str], topic: str) -> dict[str, str]:
    """Options of the Kafka sink; the producer's retry and time limits are fixed values."""
    return {
        "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
        "topic": topic,
        "kafka.retries": "3",
        "kafka.request.timeout.ms": "30000",
        "kafka.max.block.ms": "30000",
    }


def write_kafka(envelopes: DataFrame, servers: str | Iterable[str], topic: str) -> None:
    options = kafka_write_options(servers, topic)
    envelopes.select("value").write.format("kafka").options(**options).save()


def write_envelopes(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """The stand-in for a topic: a folder of files with ``value`` and ``timestamp``."""
    envelopes.select("value", "timestamp").write.mode(mode).parquet(path)
