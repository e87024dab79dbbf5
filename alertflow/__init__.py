"""Turn feeds of short text messages into a queryable table of alerts, on Spark."""
