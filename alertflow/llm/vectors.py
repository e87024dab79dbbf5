"""Columns of vectors: which ones can be compared, and their form in tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def matrix(vectors) -> np.ndarray:
    """A batch of equally long vectors in double precision."""
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))

