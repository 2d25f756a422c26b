"""Queries of the training-data operators: opN_<name>, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestone.llm.common import held_out, read_table


def vocabulary(name: str) -> str:
    """Where the public tokenizers' files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm import quality_rules as q

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"))
    rules = q.fit(docs.where(~out), labels.where(~out))
    scored = q.score(docs.select("doc_id", "text"), rules)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= q.THRESHOLD).cast("int").alias("predicted"))


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.line_templates import dedup_lines

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.size(F.split("text", "\n")).cast("long")
    found = dedup_lines(docs.withColumn("n_lines", F.when(F.col("text").isNotNull(), lines).otherwise(0)))
    return found.select("doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.common import cut
    from lodestone.llm.minhash_join import text_classes
    from lodestone.llm.packing import pack

    docs = read_table(spark, sf_dir, "documents")
    return pack(docs, classes=cut(text_classes(docs, words=4), "classes"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.winnowing import edited

    return edited(read_table(spark, sf_dir, "documents"))


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.secret_scan import digests, secret_spans

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(secret_spans(docs, vocabulary("byte_bpe_50k.tiktoken"), split_pattern()))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.license_scan import labels

    return labels(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.language_id import fit, identify

    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


def op8_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.minhash_join import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4).select("doc_id", "n_shingles", "component_id", "kept")


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.word_bpe import word_bpe

    return word_bpe(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), whole=False)


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodestone.llm.media_columns import round_trip

    return round_trip(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from lodestone.llm.oracles import ORACLES

    return dict(ORACLES)
