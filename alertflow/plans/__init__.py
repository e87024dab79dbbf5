"""Whole plans put together from the steps."""
