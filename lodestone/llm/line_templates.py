"""Line dedup by a log-template tree.

The tree has fixed depth: a line goes to the leaf of its token count and its first LEADING tokens,
where tokens with digits count as variables.  Inside a leaf a token is constant at its position
if at least min_docs documents of the leaf have it there, and a variable otherwise; the line's
template is its constants.  A template of too few constants is none.  Unlike a tree that is grown
line by line, this gives the same templates in any order of rows.

A template is recurring if it stands in at least min_docs documents of different text.  Its first
line (least doc_id, then line number) stays, all others are dropped: nothing vanishes from the corpus
altogether.  Whole copies count as one document here, they are the near-duplicate stage's work.

Leaves that fewer than min_docs documents reach are gone after the first aggregation; only
numbers are shuffled until then.  Texts are joined to the dropped lines last.

Defined results: a null text stays null and an empty one empty; lines of fewer than
LEAST_TOKENS tokens stay; rows that share doc_id and text share their decisions; a null id sorts first;
extra columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.common import bounded_batches, column_name, cut, maybe_broadcast, trim

LEADING, LEAST_TOKENS, MIN_DOCS, CONSTANT_SHARE = 3, 3, 5, 0.6
VARIABLE = "<*>"
_DIGIT = re.compile(r"\d")


def masked(line: str) -> list[str]:
    """Tokens of a line, those with digits as variables."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [VARIABLE if _DIGIT.search(t) else t for t in tokens]
    return tokens


def _hash(parts: list[str]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(" ".join(parts)) - (1 << 63)


def _leaf(tokens: list[str]) -> int:
    return _hash([str(len(tokens)), *tokens[:LEADING]])


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text_hash, text in zip(batch["doc_id"].tolist(), batch["text_hash"].tolist(), batch["text"]):
            for i, line in enumerate(text.split("\n")):
                tokens = masked(line)
                if len(tokens) >= LEAST_TOKENS:
                    rows.append((doc, text_hash, i, _leaf(tokens), _hash(tokens)))
        yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "line_no", "leaf", "line"])
    trim()


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, wanted in zip(batch["text"], batch["wanted"]):
            lines = text.split("\n")
            for w in wanted:
                tokens = masked(lines[w["line_no"]])
                rows.append((_leaf(tokens), _hash(tokens), np.array([_hash([t]) for t in tokens], "int64")))
        yield pd.DataFrame(rows, columns=["leaf", "line", "tokens"])
    trim()


def _keyed(docs: DataFrame) -> DataFrame:
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(id_.alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").where("text is not null")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_hash, dropped): line numbers, from 0, that go from rows of this id and text."""
    bounded_batches(docs.sparkSession)
    texts = _keyed(docs)
    lines = cut(texts.mapInPandas(_lines, "doc_id long, text_hash long, line_no int, leaf long, line long"), "lines")
    # Small sides are cut first: then they are broadcast by their measured size, or Spark splits a hot key of the large side.
    reached = lines.select("leaf", "text_hash").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf")
    found = cut(lines.join(maybe_broadcast(cut(reached, "reached"), 16), "leaf"), "found")
    by_line = cut(
        found.select("leaf", "line", "text_hash", "doc_id", "line_no").groupBy("leaf", "line", "text_hash").agg(F.min(F.struct("doc_id", "line_no")).alias("at")).groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min(F.struct("at.doc_id", "at.line_no", "text_hash")).alias("at")),
        "by-line",
    )
    # One place of each different line brings its tokens.
    wanted = by_line.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.text_hash").alias("text_hash")).agg(F.collect_list(F.struct(F.col("at.line_no").alias("line_no"))).alias("wanted"))
    wanted = maybe_broadcast(cut(wanted, "wanted"), 64 + 24 * F.size("wanted"))
    tokens = texts.join(wanted, ["doc_id", "text_hash"]).select("text", "wanted").mapInPandas(_tokens, "leaf long, line long, tokens array<long>").dropDuplicates(["leaf", "line"])
    tokens = cut(tokens.join(by_line.select("leaf", "line", "docs"), ["leaf", "line"]), "tokens")
    each = tokens.select("leaf", "line", "docs", F.posexplode("tokens").alias("place", "token"))
    constant = each.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs).select("leaf", "place", "token")
    kept = each.join(maybe_broadcast(cut(constant, "constant"), 32), ["leaf", "place", "token"]).groupBy("leaf", "line").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("constants"))
    named = tokens.join(kept, ["leaf", "line"]).where(F.size("constants") >= F.lit(CONSTANT_SHARE) * F.size("tokens"))
    named = named.select("leaf", "line", F.xxhash64("leaf", F.col("constants.place"), F.col("constants.token")).alias("template"))
    of = cut(found.join(maybe_broadcast(cut(named, "named"), 32), ["leaf", "line"]).select("template", "doc_id", "text_hash", "line_no"), "of")
    recurring = of.groupBy("template", "text_hash").agg(F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first")).groupBy("template").agg(F.count("*").alias("docs"), F.min("first").alias("first")).where(F.col("docs") >= min_docs)
    recurring = maybe_broadcast(cut(recurring.select("template", "first"), "recurring"), 48)
    later = of.join(recurring, "template").where(F.struct("doc_id", "line_no", "text_hash") != F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))


def without(text: Column, dropped: Column) -> Column:
    """The text without its dropped lines."""
    lines = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(dropped, i))
    return F.when(dropped.isNull(), text).otherwise(F.array_join(lines, "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, into: str = "dropped") -> DataFrame:
    """docs with text less its dropped lines and a column of their numbers (null: none); a column named `into` is replaced."""
    docs = docs.drop(into)
    dropped = maybe_broadcast(cut(dropped_lines(docs, min_docs), "dropped"), 64 + 4 * F.size("dropped"))
    a, b = column_name(docs, "key_id"), column_name(docs, "key_text")
    keyed = docs.withColumn(a, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).withColumn(b, F.xxhash64("text"))
    dropped = dropped.select(F.col("doc_id").alias(a), F.col("text_hash").alias(b), F.col("dropped").alias(into))
    return keyed.join(dropped, [a, b], "left").withColumn("text", without(F.col("text"), F.col(into))).select(*docs.columns, into)
