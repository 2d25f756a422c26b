"""How a plan module lists its queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """tables.documents reads the documents table of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def lists(queries: dict, oracles: dict) -> Callable:
    """A decorator @query(sql) for functions of Tables, named after the query."""

    def query(sql: str | None = None):
        def add(f: Callable[[Tables], DataFrame]):
            queries[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return query
