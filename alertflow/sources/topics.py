"""Message envelopes ``value BINARY, timestamp`` from Kafka or from files.

The Kafka connector is a Spark package that the cluster supplies
(``org.apache.spark:spark-sql-kafka-0-10_2.13``); without it, files of envelopes stand in.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_read_options(
    servers: str | Iterable[str],
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. Several servers replace a hand-written fail-over loop.

    ``max_offsets_per_trigger`` bounds a micro-batch; ``min_partitions`` splits a topic
    partition that holds far more than its share over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_read_options(**options))
    return reader.load().select("value", "timestamp")


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """What the topic holds now, as a batch; it starts at the earliest offset unless told otherwise."""
    settings = kafka_read_options(**{"starting_offsets": "earliest", **options})
    settings.pop("maxOffsetsPerTrigger", None)
    return spark.read.format("kafka").options(**settings).load().select("value", "timestamp")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A growing folder as a stream, oldest file first; ``max_files_per_trigger`` paces it."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
