"""Files as tables.  Formats that need OCR, layout models or office libraries enter through `sections`."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lodestone.functions import text as T
from lodestone.operators import chunking as C

#: Fixed value: extensions read as plain text.
PLAIN = ("txt", "py", "js", "java", "c", "cpp", "h", "php", "go", "ts", "sh", "cs", "kt", "sql")


def plain_files(spark: SparkSession, path: str, limit: int = C.CHUNK_TOKENS) -> DataFrame:
    """(path, chunk, content) of text and code files."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    return files.where(kind.isin(*PLAIN)).select("path", F.posexplode(C.plain_chunks(F.col("value"), limit)).alias("chunk", "content"))


def delimited(spark: SparkSession, path: str, sep: str = "\t", rows: tuple[int, int] | None = None) -> DataFrame:
    """A table file; rows of another width than the header go.  rows picks [from, to) by order in the file."""
    df = spark.read.csv(path, sep=sep, header=True, mode="DROPMALFORMED")
    if rows is None:
        return df
    numbered = df.rdd.zipWithIndex().filter(lambda x: rows[0] <= x[1] < rows[1]).map(lambda x: x[0])  # order in a file has no column
    return spark.createDataFrame(numbered, df.schema)


def html_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", T.html_title(F.col("value")).alias("title"), T.html_text(F.col("value")).alias("content"))


def json_files(spark: SparkSession, path: str, limit: int = 2000) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(C.json_chunks(F.col("value"), limit, max(limit - 200, 50))).alias("chunk", "content"))


def mail_files(spark: SparkSession, path: str) -> DataFrame:
    return C.mail_parts(spark.read.format("binaryFile").load(path))


def sections(spark: SparkSession, path: str, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """(path, section, content) by an extractor for formats without one here (PDF, office, pictures, sound)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(p, i, s) for p, raw in zip(b["path"], b["content"]) for i, s in enumerate(extract(raw))], columns=["path", "section", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, section int, content string")


def point_get(chunks: DataFrame, key: str, value) -> DataFrame:
    return chunks.where(F.col(key) == value).limit(1)


class WebSearch(DataSource):
    """A search tool as a source: options `terms` (separated by |) and `top_n`; subclasses give `fetch`."""

    @classmethod
    def name(cls) -> str:
        return "lodestone_web"

    def schema(self) -> str:
        return "term string, rank int, content string"

    def fetch(self, term: str, top_n: int) -> list[str]:
        """Contents for a term; offline there are none but the term itself."""
        return [term][:top_n]

    def reader(self, schema) -> DataSourceReader:
        source, options = self, dict(self.options)

        class Reader(DataSourceReader):
            def partitions(self):
                return [InputPartition(t) for t in options.get("terms", "").split("|") if t]

            def read(self, partition):
                n = int(options.get("top_n", "10"))
                for i, content in enumerate(source.fetch(partition.value, n)[:n]):
                    yield (partition.value, i, content)

        return Reader()
