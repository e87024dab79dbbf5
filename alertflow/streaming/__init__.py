"""Structured Streaming jobs around the batch steps."""
