"""Session settings the operators are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "daymart", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution and UTC days.

    Joins carry no broadcast hints on tables: below
    ``spark.sql.autoBroadcastJoinThreshold`` Spark broadcasts by measured size, above it
    the sort-merge join and the adaptive skew split take over.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: ``spark.checkpoint.dir``, or the warehouse where none is set.

    All executors and the driver must share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def _stage_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stages/{spark.sparkContext.applicationId}"


def drop_stages(spark: SparkSession) -> None:
    """Remove what ``materialise`` wrote in this application; to be called when its results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stage_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that losing an executor loses nothing, and unlike a checkpoint the result
    is planned with its real size, which loops of joins depend on.  The stages of an
    application share one folder; ``drop_stages`` removes it.
    """
    spark = df.sparkSession
    path = f"{_stage_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
