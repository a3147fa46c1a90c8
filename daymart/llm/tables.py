"""Reading the test tables and writing intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the warehouse where none is set, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


_recorders: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that ``written`` fills meanwhile."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def written(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    for paths in _recorders:
        paths.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_written(spark: SparkSession, paths: list[str], still_read: DataFrame) -> None:
    """Remove these tables of ``written``, but for those that ``still_read`` reads from."""
    needed = {part for file in still_read.inputFiles() for part in file.split("/")} if paths else set()
    for path in paths:
        if path.rsplit("/", 1)[-1] not in needed:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def extended(schema: StructType, ddl: str) -> StructType:
    """``schema`` and the columns of ``ddl`` behind it."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``docs`` is called so."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty, and holds finite numbers only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)


def usual_length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of a vector, the longer of two equally frequent ones; 0 without rows."""
    lengths = rows.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return lengths[0]["length"] if lengths else 0
