"""Queries of parser dispatch, résumé fields, detections and answers from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import parsers as P
from lodestone.plans.catalogue import Tables, lists
from lodestone.plans.chunking import ORACLES as CHUNKING_SQL

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)

_NAIVE = CHUNKING_SQL["chunk_parser_txt"].replace("FROM documents)", "FROM documents WHERE doc_id % 4 = 0)", 1)


@query(f"""SELECT doc_id, 'naive' AS parser, chunk, content FROM ({_NAIVE}) UNION ALL SELECT doc_id, 'one', 0, md5(text) FROM documents WHERE doc_id % 4 = 1
 UNION ALL SELECT doc_id, 'table', unnest(generate_series(0, 1)), unnest([md5('lang:' || lang || '; source:' || source), md5('lang:' || source)]) FROM documents WHERE doc_id % 4 = 2
 UNION ALL SELECT doc_id, 'qa', unnest(generate_series(0, 1)), unnest([md5('q1' || chr(9) || lang || chr(10) || 'more'), md5('q2' || chr(9) || source)]) FROM documents WHERE doc_id % 4 = 3""")
def parser_dispatch(t: Tables) -> DataFrame:
    kind = F.col("doc_id") % 4
    table = F.concat(F.lit("lang\tsource\n"), "lang", F.lit("\t"), "source", F.lit("\n"), "source", F.lit("\t"))
    qa = F.concat(F.lit("none\nq1\t"), "lang", F.lit("\nmore\nq2\t"), "source")
    files = t.documents.select("doc_id", F.when(kind == 0, "unheard of").when(kind == 1, "one").when(kind == 2, "table").otherwise("qa").alias("parser"), F.when(kind == 2, table).when(kind == 3, qa).otherwise(F.col("text")).alias("text"))
    return P.dispatch(files, "parser", "text", "doc_id").withColumn("content", F.md5("content"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS birth_dt, strftime(o_orderdate, '%m%d') AS birthday_kwd, 2024 - year(o_orderdate) AS age_int,
 CASE o_orderkey % 3 WHEN 0 THEN '博士' WHEN 1 THEN '本科' ELSE 'none' END AS degree, o_orderstatus || '   ' || o_orderpriority AS bare FROM orders""")
def resume_fields(t: Tables) -> DataFrame:
    degrees = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("本科"), F.lit("博士"), F.lit("高中"))).when(F.col("o_orderkey") % 3 == 1, F.array(F.lit("none"), F.lit("本科"))).otherwise(F.array(F.lit("none")))
    # Dates come as epoch milliseconds, or in one of two ways of writing.
    written = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.concat(F.unix_timestamp("o_orderdate").cast("string"), F.lit("000")))
    written = F.when(F.unix_timestamp("o_orderdate") < 1_000_000_000, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(written)
    b = P.birth(written, F.lit("2024-06-01").cast("date"))
    bare = P.field_text(F.concat("o_orderstatus", F.lit(' <b class="x"> '), "o_orderpriority"))
    return t.orders.select("o_orderkey", b["birth_dt"].alias("birth_dt"), b["birthday_kwd"].alias("birthday_kwd"), b["age_int"].alias("age_int"), P.highest_degree(degrees).alias("degree"), bare.alias("bare"))


@query("SELECT greatest(max(strftime(ts, '%Y-%m-%d %H:%M:%S')), '1970-01-01 00:00:00') AS time FROM events")
def greatest_time(t: Tables) -> DataFrame:
    lines = t.events.select(F.when(F.col("event_id") % 7 == 0, "nan").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("line"))
    return P.greatest_time(lines.unionByName(t.events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("line"))), "line")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders), b AS (SELECT o_custkey AS page, o_orderkey AS id, o_orderkey % 37 AS x0, o_orderkey % 37 + 20 AS x1, (o_orderkey * 7 % 100) / 100 AS score FROM o WHERE r <= 2 AND (o_orderkey * 7 % 100) / 100 >= 0.3),
 p AS (SELECT a.page, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) AS wide, CASE WHEN a.score >= b.score THEN b.id ELSE a.id END AS worse FROM b a JOIN b ON a.page = b.page AND a.id < b.id)
 SELECT page, id FROM b WHERE id NOT IN (SELECT worse FROM p WHERE wide * 10 >= 0.2 * (400 - wide * 10))""")
def detections_kept(t: Tables) -> DataFrame:
    """Two boxes a page, so that SQL can say which one goes."""
    from lodestone.operators.relational import first_by

    one = first_by(t.orders, ["o_custkey"], F.col("o_orderkey"))
    two = first_by(t.orders.join(one.select("o_orderkey"), "o_orderkey", "left_anti"), ["o_custkey"], F.col("o_orderkey"))
    left = (F.col("o_orderkey") % 37).cast("double")
    boxes = one.unionByName(two).select(F.col("o_custkey").alias("page"), F.lit("text").alias("type"), F.col("o_orderkey").alias("id"), left.alias("x0"), F.lit(0.0).alias("top"), (left + 20).alias("x1"), F.lit(10.0).alias("bottom"), (F.col("o_orderkey") * 7 % 100 / 100).alias("score"))
    return P.kept_detections(boxes, "page", "type", least_score=0.3).select("page", "id")


@query("""WITH r AS (SELECT c_nationkey, count(*) AS n, row_number() OVER (ORDER BY c_nationkey) - 1 AS i FROM customer GROUP BY c_nationkey) SELECT -2 AS place, '|nation|customers|Source|' AS line UNION ALL SELECT -1, '|------|------|------|' UNION ALL SELECT i, '|' || c_nationkey || '|' || n || '| ##' || i || '$$ |' FROM r""")
def sql_answer(t: Tables) -> DataFrame:
    """The model's first statement is wrong; it gets the error and corrects it."""
    answers = iter(["SELECT nothing FROM customers", "```SELECT c_nationkey, count(*) AS n FROM customers group by c_nationkey;```"])
    rows = P.ask_sql(t.spark, lambda prompt: next(answers), "customers", t.customer, {"c_nationkey": "nation/land", "n": "customers（all）"}, "How many customers has a nation?")
    return P.cited_table(rows.withColumn("doc_id", F.lit(1)).withColumn("docnm_kwd", F.lit("d")), {"c_nationkey": "nation/land", "n": "customers（all）"}, ["c_nationkey"])[0]


@query("SELECT page_id, length(regexp_replace('<table><tr class=\"a\"><td>' || url || '</td></tr></table>', '</?(table|td|caption|tr|th)( [^<>]{0,12})?>', ' ', 'g')) AS n FROM pages")
def table_tags(t: Tables) -> DataFrame:
    html = F.concat(F.lit('<table><tr class="a"><td>'), "url", F.lit("</td></tr></table>"))
    return t.pages.select("page_id", F.length(P.table_text(html)).alias("n"))
