"""Record types that cross a boundary: messages, scores, extractions, stored rows."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Field names and order of the message, extraction and feed records.
MESSAGE = _strings("id", "keyword", "location", "text")
EXTRACTION = _strings("location", "disaster")
FEED_ITEM = _strings("title", "published_date", "abstract")

# The alert plan uses two of the four message fields, so only those are parsed.
ALERT_MESSAGE = _strings("id", "text")

FEED = T.StructType([T.StructField("results", T.ArrayType(FEED_ITEM))])

# What a batch model returns; numbers only, so ``ok`` is 0 or 1.
MODEL_SCORE = T.StructType(
    [
        T.StructField("prediction", T.IntegerType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("ok", T.IntegerType()),
    ]
)

# Fields of an alert.
ALERT = T.StructType(
    _strings("id", "text", "disaster", "location").fields
    + [
        T.StructField("confidence", T.DoubleType()),
        T.StructField("kafka_timestamp", T.TimestampNTZType()),
    ]
)

# Widths and scale of the stored prediction columns.
MAX_TWEET_ID = 50
MAX_DISASTER_TYPE = 100
MAX_LOCATION = 200
CONFIDENCE = T.DecimalType(5, 4)

# Columns of the prediction store. Plain string types here: files carry no width, the width check runs on write.
STORED = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("tweet_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("disaster_type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("confidence", CONFIDENCE),
        T.StructField("kafka_timestamp", T.TimestampNTZType()),
        T.StructField("processing_timestamp", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# The same widths for a table that Spark creates in a database.
DATABASE_TYPES = (
    f"tweet_id VARCHAR({MAX_TWEET_ID}), disaster_type VARCHAR({MAX_DISASTER_TYPE}), "
    f"location VARCHAR({MAX_LOCATION}), confidence DECIMAL(5,4)"
)

# Stored files have one more column, derived from the others, that names their folder.
EVENT_DAY = T.StructField("event_day", T.DateType())
TYPE_FOLDER = T.StructField("type_folder", T.StringType())

# The same table for a catalog, where Spark enforces the widths.
STORED_DDL = f"""
    row_key STRING,
    tweet_id VARCHAR({MAX_TWEET_ID}),
    text STRING NOT NULL,
    disaster_type VARCHAR({MAX_DISASTER_TYPE}),
    location VARCHAR({MAX_LOCATION}),
    confidence DECIMAL(5,4),
    kafka_timestamp TIMESTAMP_NTZ,
    processing_timestamp TIMESTAMP_NTZ,
    created_at TIMESTAMP_NTZ,
    event_day DATE
"""

# Documents have one more column, which names their folder.
DOCUMENT_DAY = T.StructField("processing_day", T.DateType())
DOCUMENT = T.StructType(ALERT.fields + [T.StructField("processing_timestamp", T.TimestampNTZType())])
