"""Scans of day-partitioned tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import as_date


def read_table(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table)


def on_day(rows: DataFrame, ds: dt.date | str | None, day: str = "p_date") -> DataFrame:
    """Rows of one day, or all rows for ``None``; prunes partitions of a day table."""
    return rows if ds is None else rows.where(F.col(day) == F.lit(as_date(ds)))


def on_stamp_day(rows: DataFrame, ds: dt.date | str, stamp: str) -> DataFrame:
    """Rows whose time stamp falls on a day, as a range that reaches the file scan."""
    start = dt.datetime.combine(as_date(ds), dt.time())
    low, high = (F.lit(str(t)).cast(rows.schema[stamp].dataType) for t in (start, start + dt.timedelta(days=1)))
    return rows.where((F.col(stamp) >= low) & (F.col(stamp) < high))


def latest_day(spark: SparkSession, table: str, day: str = "p_date") -> dt.date | None:
    """The newest day of a day table by the names of its folders; no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    names = [entry.getPath().getName() for entry in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    days = [name.removeprefix(f"{day}=") for name in names if name.startswith(f"{day}=")]
    return as_date(max(days)) if days else None


def latest_partition(spark: SparkSession, table: str, schema: T.StructType, day: str = "p_date") -> DataFrame:
    """Rows of the newest day, read from its folder only."""
    newest = latest_day(spark, table, day)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(f"{table}/{day}={newest.isoformat()}")


def query_day(spark: SparkSession, text: str, ds: dt.date | str, **tables: DataFrame) -> DataFrame:
    """A SQL text with ``{table}`` holes and a typed ``:ds`` date parameter."""
    return spark.sql(text, args={"ds": as_date(ds)}, **tables)
