"""CSV feeds with a header line: every header name becomes a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Quoted fields may hold line breaks and doubled quotes.
QUOTING = {"header": "true", "escape": '"', "encoding": "UTF-8"}


def csv_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """Text columns named by the header; Spark reads one line for this."""
    names = spark.read.options(**QUOTING, multiLine=multi_line).csv(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def filled(df: DataFrame) -> DataFrame:
    """Empty and missing cells are empty texts, whatever the column."""
    return df.na.fill("")


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV file or folder. All files must have one header; another one raises.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file. For a
    feed without them, set it to False and large files are split; ``read_csv_ranges`` splits files that have them.
    """
    schema = csv_schema(spark, path, multi_line)
    reader = spark.read.schema(schema).options(**QUOTING, multiLine=multi_line, enforceSchema=False)
    return filled(reader.csv(path))


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same feed as a stream; ``max_files_per_trigger`` bounds each micro-batch."""
    reader = spark.readStream.schema(schema).options(**QUOTING, multiLine=multi_line, enforceSchema=False)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return filled(reader.csv(path))
