"""Structured Streaming forms of the task queue, roll-ups and windowed statistics.

Every function takes a streaming DataFrame and drains it with the availableNow trigger into the
shared folder, then returns the result as a table: the same code runs on with another trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lodestone.streaming.shared import new_folder

LATENESS = "1 day"
RETRIES = 3


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A table's files as a stream; times without a zone are taken in the session's."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    # A stream's source is a folder: a table of one file is picked out of its folder.
    stream = reader.parquet(path) if is_folder else reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return stream.withColumns({c: F.col(c).cast("timestamp") for c, kind in table.dtypes if kind == "timestamp_ntz"})


def drain_complete(result: DataFrame, name: str) -> DataFrame:
    """A complete-mode aggregation: each batch replaces the table, so a replay changes nothing."""
    spark, out = result.sparkSession, new_folder(result.sparkSession, name)
    q = result.writeStream.outputMode("complete").option("checkpointLocation", new_folder(spark, name + "-state")).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def drain_append(result: DataFrame, name: str) -> DataFrame:
    spark, out = result.sparkSession, new_folder(result.sparkSession, name)
    q = result.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", new_folder(spark, name + "-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def windowed(events: DataFrame, time: str, length: str, slide: str | None, *keys: str) -> DataFrame:
    w = F.window(time, length, slide) if slide else F.window(time, length)
    counts = events.withWatermark(time, LATENESS).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, key: str) -> DataFrame:
    counts = events.withWatermark(time, LATENESS).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), key, "n")


def deduplicated(events: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """At-least-once delivery made idempotent by a content key."""
    return events.withWatermark(time, LATENESS).dropDuplicatesWithinWatermark(keys)


def retries(tasks: DataFrame, key: str, failed: str) -> DataFrame:
    """Per task: failures so far, and whether it is given up (custom state across batches)."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        for b in batches:
            seen += int(b[failed].sum())
        state.update((seen,))
        yield pd.DataFrame([(k[0], seen, seen >= RETRIES)], columns=["task", "failures", "given_up"])

    return tasks.groupBy(key).applyInPandasWithState(update, "task long, failures long, given_up boolean", "failures long", "update", "NoTimeout")


def drain_update(result: DataFrame, name: str, key: str) -> DataFrame:
    """Update-mode rows, the last of each key."""
    spark, out = result.sparkSession, new_folder(result.sparkSession, name)
    q = result.writeStream.outputMode("update").option("checkpointLocation", new_folder(spark, name + "-state")).foreachBatch(lambda df, i: df.withColumn("__batch", F.lit(i)).write.mode("overwrite").parquet(f"{out}/batch={i}")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.schema(StructType([*result.schema.fields, StructField("__batch", LongType())])).parquet(out)
    return rows.groupBy(key).agg(*(F.max_by(c, "__batch").alias(c) for c in result.columns if c != key))


def apply_changes(changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], first: DataFrame, name: str) -> DataFrame:
    """A change feed folded into a table batch by batch: each batch writes the next version."""
    spark, out = changes.sparkSession, new_folder(changes.sparkSession, name)
    first.write.parquet(f"{out}/v0")
    last = [0]

    def step(df: DataFrame, i: int) -> None:
        merge(spark.read.parquet(f"{out}/v{i}"), df).write.mode("overwrite").parquet(f"{out}/v{i + 1}")
        last[0] = i + 1

    q = changes.writeStream.option("checkpointLocation", new_folder(spark, name + "-state")).foreachBatch(step).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(first.schema).parquet(f"{out}/v{last[0]}")
