"""Where intermediate tables and stream states go: the shared folder that the session names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder: lineage ends there, and lost executors lose nothing."""
    path = new_folder(df.sparkSession, "rounds")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
