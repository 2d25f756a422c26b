"""Functions for SQL: register(spark) makes them known by name."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession, functions as F

# Numerals.
_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
_CJK = dict(zip("零一二三四五六七八九十", range(11)))
_ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}


def index_number(text: str | None) -> int:
    """A bullet's number: digits, an English word, a Chinese or Roman numeral; else -1."""
    if text is None:
        return -1
    t = text.strip()
    if re.fullmatch(r"[0-9]+", t):
        return int(t)
    if t.lower() in _WORDS:
        return _WORDS.index(t.lower())
    if t and all(c in _CJK for c in t):
        tens, ten, ones = t.partition("十")
        if ten:
            return (_CJK[tens] if tens else 1) * 10 + (_CJK[ones] if ones else 0)
        return int("".join(str(_CJK[c]) for c in t))
    if t and all(c in _ROMAN for c in t):
        values = [_ROMAN[c] for c in t]
        return sum(-v if v < max(values[i:]) else v for i, v in enumerate(values))
    return -1


def register(spark: SparkSession) -> None:
    """index_number(text), and the table functions chunk_text(text, n) and graph_records(text)."""

    @F.pandas_udf("int")
    def numbers(texts: pd.Series) -> pd.Series:
        return texts.map(index_number).astype("int32")

    spark.udf.register("index_number", numbers)

    class ChunkText:
        def eval(self, text: str, n: int):
            for i in range(0, len(text or ""), n):
                yield i // n, text[i : i + n]

    class GraphRecords:
        def eval(self, text: str):
            for i, record in enumerate(filter(str.strip, (text or "").replace("<|COMPLETE|>", "").split("##"))):
                fields = [f.strip().strip('"') for f in re.sub(r"^\(|\)$", "", record.strip()).split("<|>")]
                yield i, fields[0], fields[1:]

    spark.udtf.register("chunk_text", F.udtf(ChunkText, returnType="chunk int, content string"))
    spark.udtf.register("graph_records", F.udtf(GraphRecords, returnType="record int, kind string, fields array<string>"))
