"""Where intermediate results go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session,
    else the checkpoint folder already set. Only a local session may fall back
    to a temporary folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as a table in the shared folder and read back. Later passes
    read the very same rows, only the columns they need, and nothing before them
    runs again when executors are lost."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
