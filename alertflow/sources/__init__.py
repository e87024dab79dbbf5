"""Readers: CSV feeds, message topics, news feeds, stored predictions."""
