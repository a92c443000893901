"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode a new one where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="matchday-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: evaluated a single time, however often it is used."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
