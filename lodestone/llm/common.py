"""Small helpers that several training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A side is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 * 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where the session names none and runs on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        found = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    return found


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at replicated files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lodestone-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df (file sizes for a scan), without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def block_count(df: DataFrame, bytes_a_block: int, most: int = 1 << 20) -> int:
    """How many blocks keep each at about bytes_a_block of stored data."""
    size = stored_bytes(df)
    if size > 1 << 58:  # a source without statistics
        size = 4096 * df.count()
    return int(min(most, max(1, -(-size // bytes_a_block))))


def maybe_broadcast(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """Broadcast df only when its counted size is small; otherwise Spark shuffles.

    row_bytes bounds a row's bytes; for rows without a bound it is a column that measures each.
    """
    if isinstance(row_bytes, int):
        size = df.count() * row_bytes
    else:
        size = df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def held_out(doc_id):
    """crc32 of doc_id as text, modulo 5, is 0; a null id counts as empty text (held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def column_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have yet."""
    name, taken = stem, {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get Arrow batches bounded by bytes, so long texts do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def trim() -> None:
    """Gives a Python worker's freed memory back: workers are kept and used again."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc
