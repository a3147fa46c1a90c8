"""Truncate-and-replace writes of day partitions.

A daily run may legitimately produce no rows, and rerunning a day must leave exactly the new rows.  All writes go through
dynamic partition overwrite, which puts new files in place only when the job has succeeded: a load that fails
leaves the old day as it was.  Such a write leaves days without new rows alone, so those are emptied afterwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.functions.dates import as_date


def day_path(table: str, ds: dt.date | str) -> str:
    return f"{table}/p_date={as_date(ds).isoformat()}"


def overwrite_day(rows: DataFrame, table: str, ds: dt.date | str) -> None:
    """Replace one day by ``rows``, whatever day they name themselves; ``rows`` may come from the day's own folder."""
    overwrite_days(rows.withColumn("p_date", F.lit(as_date(ds))), table, [ds])


def overwrite_days(rows: DataFrame, table: str, days: Iterable[dt.date | str]) -> None:
    """Replace the given days in one job; days without rows become empty.

    Rows of other days are not written.  The rebalance keeps files at the advisory size and
    lets adaptive execution split a day that is much larger than the others.
    """
    days = sorted({as_date(d) for d in days})
    if not days:
        return
    spark = rows.sparkSession
    before = {day: _files(spark, day_path(table, day)) for day in days}
    (
        rows.where(F.col("p_date").isin(days))
        .hint("rebalance", "p_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("p_date")
        .parquet(table)
    )
    # A day that still holds the files of before got no rows.
    blank = spark.createDataFrame([], rows.drop("p_date").schema)
    for day in days:
        if _files(spark, day_path(table, day)) == before[day]:
            blank.write.mode("overwrite").parquet(day_path(table, day))


def _files(spark: SparkSession, path: str) -> set[str]:
    """Names of the files in a folder; none if it isn't there.  Each job names its files anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {entry.getPath().getName() for entry in system.listStatus(folder)} if system.exists(folder) else set()
