"""Where jobs put intermediate tables: a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where that is unset, one in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application so that a finished one's can be removed."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/forgemeter/{application}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: written once, read as often as needed."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
