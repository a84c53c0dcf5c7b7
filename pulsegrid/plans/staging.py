"""Cutting a plan at a table in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "pulsegrid-"


def stage_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, the session's checkpoint folder or else its warehouse, shared like it."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def shared_folder(spark: SparkSession, stage_dir: str | None = None) -> str:
    """The name of a new folder below ``stage_dir`` or the root of the session."""
    return f"{(stage_dir or stage_root(spark)).rstrip('/')}/{FOLDER}{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def staged(df: DataFrame, stage_dir: str | None = None) -> DataFrame:
    """Writes the frame once and reads it back: later work neither repeats nor depends on what made it."""
    path = shared_folder(df.sparkSession, stage_dir)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stages(spark: SparkSession, stage_dir: str | None = None) -> bool:
    """Deletes everything that this application has staged; frames that read it can no longer run."""
    root = f"{(stage_dir or stage_root(spark)).rstrip('/')}/{FOLDER}{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
