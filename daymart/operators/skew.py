"""Finding the keys that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.session import materialise


def oversized_keys(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or ``None``; runs one pre-aggregated count, once.

    There are at most (all rows / ``limit``) of them.
    """
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).drop("_n")
    stored = materialise(large)
    return None if stored.isEmpty() else stored
