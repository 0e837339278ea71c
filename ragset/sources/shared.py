"""Tables written between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_dir(spark) -> str:
    """The folder of spark.checkpoint.dir, or where that is unset a new one on the one machine of a local session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.getCheckpointDir() is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ragset-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark) -> str:
    return f"{shared_dir(spark)}/ragset-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended(df: DataFrame, path: str) -> DataFrame:
    """All rows written to path so far, with those of df."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
