"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.  Between stages the result is a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestone.llm import language_id, line_templates, minhash_join, packing, secret_scan
from lodestone.llm.common import column_name, cut, held_out, maybe_broadcast, read_table
from lodestone.llm.registry import split_pattern, vocabulary

#: A document goes if its language is unknown or less likely than this.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that the model knows well enough, go.

    So do null and empty texts.  The model learns from rows with a label outside the held-out ids; without any, every
    document is unknown and goes.  Rows are decided one by one, repeated ones alike; other columns stay as they are.
    """
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    name = column_name(docs, "language")
    found = language_id.identify(docs, model, into=name)
    sure = (F.col(f"{name}.lang_pred") != language_id.UNKNOWN) & (F.col(f"{name}.score") >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for the first; so do documents of which no line is left.

    A template's first line is that of the least doc_id (a null one sorts first), then line number, then text.  Null and empty
    texts stay; rows of one id and text share their decisions; n_chars is counted anew where a line went.
    """
    name = column_name(docs, "dropped")
    found = line_templates.dedup_lines(docs, into=name)
    changed = F.col(name).isNotNull()
    left = found.where(~changed | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, that of the least doc_id; so does every row without words.

    A null doc_id comes last; of rows of one id in a class one stays.  Decisions hold for rows: other rows of an id stay or go by their own text.
    """
    gone, again = minhash_join.surplus(docs)
    a, b = column_name(docs, "key_id"), column_name(docs, "key_text")
    keyed = docs.withColumn(a, F.col("doc_id").cast("long")).withColumn(b, F.xxhash64("text"))
    same = lambda t: F.col("s.doc_id").eqNullSafe(F.col(f"t.{a}")) & (F.col("s.text_hash") == F.col(f"t.{b}"))
    rows = keyed.alias("t").join(maybe_broadcast(gone, 32).alias("s"), same("t"), "left_anti")
    if again.isEmpty():
        return rows.select(docs.columns)
    again = maybe_broadcast(again, 32).alias("s")
    once = rows.alias("t").join(again, same("t"), "left_semi").dropDuplicates([a, b])
    return rows.alias("t").join(again, same("t"), "left_anti").unionByName(once).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, a null text as null.

    Overlapping spans are replaced once; repeated rows alike; n_chars is counted anew where a text changed.
    """
    return secret_scan.redact(docs, vocabulary("byte_bpe_50k.tiktoken"), split_pattern())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of training sequences, with their texts.

    Null and empty texts have no piece; repeated rows are pieces of their own; a null source conflicts with
    nothing.  The stage before last left one row of each class of near duplicates, so classes of texts equal but for case and
    blanks (which redaction may have made) are the clusters left to keep apart.
    """
    return packing.pack(docs, with_text=True)


STAGES = [("language_id", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secret_scan", secrets), ("packing", pack)]

#: Language models, template trees and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
