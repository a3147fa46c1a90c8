"""Completeness checks that replace waiting for upstream runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(requested: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Requested keys that never arrived."""
    return requested.select(key).distinct().join(received.select(key).distinct(), key, "left_anti")


def split_rejects(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the others."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return rows.where(complete), rows.where(~complete)


def required_days(spark, first: dt.date, last: dt.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("p_date"))


def missing_partitions(required: DataFrame, table: DataFrame, day: str = "p_date") -> DataFrame:
    """Required days for which ``table`` has no rows."""
    return required.select(day).join(table.select(day).distinct(), day, "left_anti")


def off_partition_rows(rows: DataFrame, ds: dt.date, day: str = "p_date") -> DataFrame:
    """Rows whose own date is not the partition they are about to be written to, for
    instance posts stamped in UTC around a local midnight."""
    return rows.where(~F.col(day).eqNullSafe(F.lit(ds)))
