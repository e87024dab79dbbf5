"""Row keys that come out the same when a message is replayed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(value: Column) -> Column:
    """Length-prefixed text, so that neighbouring parts cannot run into each other."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-;")).otherwise(
        F.concat(F.length(text).cast("string"), F.lit(":"), text, F.lit(";"))
    )


def row_key(*columns: Column | str) -> Column:
    """SHA-256 of the columns: 64-bit hashes would collide among 10^11 rows, this will not."""
    parts = [_part(F.col(c) if isinstance(c, str) else c) for c in columns]
    return F.sha2(F.concat(*parts), 256)
