"""Queries of index reads, exports, checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import index as I
from lodestone.plans.catalogue import Tables, lists
from lodestone.plans.retrieval import ORACLES as RETRIEVAL_SQL
from lodestone.plans.retrieval import QUERIES as RETRIEVAL

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


@query("SELECT c_custkey, c_name, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 100) AS INTEGER) AS page FROM customer ORDER BY c_custkey LIMIT 300")
def scroll_pages(t: Tables) -> DataFrame:
    """Three pages of a scroll, each from the last one's cursor."""
    out, after = None, None
    for page in range(3):
        rows = I.scroll(t.customer.select("c_custkey", "c_name"), "c_custkey", after).withColumn("page", F.lit(page))
        after = rows.agg(F.max("c_custkey")).first()[0]
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT vec_id, label FROM embeddings")
def visible_fields(t: Tables) -> DataFrame:
    return I.visible(t.embeddings.withColumnRenamed("embedding", "q_64_vec").withColumn("title_tks", F.lit("x")))


@query("""SELECT doc_id, 'lines_kwd' AS field, md5(replace(text, chr(10), chr(9))) AS text FROM documents UNION ALL SELECT doc_id, 'lang', md5(lang) FROM documents UNION ALL SELECT doc_id, 'n_chars', md5(n_chars::VARCHAR) FROM documents""")
def field_texts(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.split("text", "\n").alias("lines_kwd"), "lang", "n_chars")
    return I.field_texts(rows, "doc_id").withColumn("text", F.md5("text"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 600 SECONDS")
def recent_changes(t: Tables) -> DataFrame:
    return I.recent(t.events, "ts", F.lit("2024-01-20 12:00:00").cast("timestamp")).select("event_id")


@query("""SELECT p_partkey, p_partkey || ',"' || replace(p_name || ', "x"', '"', '""') || '",' || p_brand AS line FROM part""")
def csv_export(t: Tables) -> DataFrame:
    rows = t.part.withColumn("name", F.concat("p_name", F.lit(', "x"')))
    return rows.select("p_partkey", I.csv_lines(rows, ["p_partkey", "name", "p_brand"]).alias("line"))


@query("SELECT event_id, event_id % 3 <> 2 AS valid FROM events")
def json_fields(t: Tables) -> DataFrame:
    """Answers with a list and a rating; every third has a rating of the wrong type."""
    rating = F.when(F.col("event_id") % 3 == 2, F.lit('"high"')).when(F.col("event_id") % 3 == 1, F.lit("7")).otherwise("7.5")
    answer = F.concat(F.lit('{"title": "'), "event_type", F.lit('", "findings": [1], "rating": '), rating, F.lit("}"))
    return t.events.select("event_id", I.has_fields(answer, {"title": "string", "findings": "array", "rating": "number"}).alias("valid"))


@query("SELECT o_orderkey, o_custkey > 0 AS a, TRUE AS b, o_totalprice <= 200000 AS c, o_orderstatus IN ('O') AS d, FALSE AS e FROM orders")
def parameter_checks(t: Tables) -> DataFrame:
    v = I.valid_parameter
    price = F.col("o_totalprice").cast("string")
    return t.orders.select(
        "o_orderkey",
        v(F.col("o_custkey").cast("string"), "positive_integer").alias("a"),
        v(F.col("o_orderstatus"), "string").alias("b"),
        v(price, "nonnegative_number", 200_000).alias("c"),
        v(F.when(F.col("o_orderstatus") == "O", "True").otherwise("o"), "boolean").alias("d"),
        v(F.concat("o_orderstatus", F.lit("1.5")), "decimal").alias("e"),
    )


@query("WITH m AS (" + RETRIEVAL_SQL["ndcg_map_mrr"] + """) SELECT 0 AS part, '| query | score |' AS line UNION ALL SELECT 0, '| --- | --- |' UNION ALL SELECT 1, '| ' || q || ' | ' || format('{:.4f}', ndcg) || ' |' FROM m
 UNION ALL SELECT 2, '| mean | ' || format('{:.4f}', avg(ndcg)) || ' |' FROM m""")
def benchmark_report(t: Tables) -> DataFrame:
    return I.report_lines(RETRIEVAL["ndcg_map_mrr"](t.spark, t.folder), "q", "ndcg").select("place.part", "line")


@query("""SELECT p_brand, chunk, '<table><caption>parts</caption><tr><th>p_name</th><th>p_size</th></tr>' || string_agg('<tr><td>' || p_name || '</td><td>' || p_size || '</td></tr>', '' ORDER BY p_partkey) || '</table>' AS content
 FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) / 12) AS INTEGER) AS chunk FROM part) GROUP BY p_brand, chunk""")
def html_sheet_blocks(t: Tables) -> DataFrame:
    return I.html_blocks(t.part, "p_brand", "p_partkey", ["p_name", "p_size"], 12, "parts")


@query("""WITH RECURSIVE k AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS c, len(string_split(text, ' ')) AS n FROM conversations),
 g AS (SELECT conv_id, turn, i, c, n AS total, n AS new FROM k WHERE i = 1 UNION ALL SELECT k.conv_id, k.turn, k.i, k.c, g.total + k.n, CASE WHEN g.new >= 16 THEN k.n ELSE g.new + k.n END FROM g JOIN k ON k.conv_id = g.conv_id AND k.i = g.i + 1)
 SELECT conv_id, turn AS at, total FROM g WHERE new >= 16 OR i = c""")
def answer_stream(t: Tables) -> DataFrame:
    pieces = t.conversations.select("conv_id", "turn", F.size(F.split("text", " ")).alias("n"))
    return I.sent_parts(pieces, "conv_id", "turn", "n")
