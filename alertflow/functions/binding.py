"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result inside ``body``.

    A plain expression used inside a lambda is worked out again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
