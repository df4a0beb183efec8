"""Where jobs put data that outlives a stage: the shared folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, or under the warehouse, which is shared too, where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a Parquet table in the shared folder and read back: lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
