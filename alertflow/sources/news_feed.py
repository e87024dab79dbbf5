"""News feed payloads: JSON text with an array of items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.schemas import FEED


def feed_items(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per item with title, published_date and abstract; other columns are carried along."""
    rest = [c for c in payloads.columns if c != payload]
    return payloads.select(*rest, F.inline(F.from_json(payload, FEED)["results"]))
