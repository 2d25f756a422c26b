"""Filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lodestone.functions import text as T
from lodestone.operators import relational as R
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3') AND n_chars >= 500")
def scan_filter_project(t: Tables) -> DataFrame:
    return t.documents.where(F.col("lang").isin("en", "de") & F.col("source").isin("src1", "src2", "src3") & (F.col("n_chars") >= 500)).select("doc_id", "source", "n_chars")


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(l.quality, 1) >= 1")
def availability_filter(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left").where(R.available(F.col("quality"))).select("doc_id", "quality")


@query("SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality < 1")
def unavailable_filter(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id").where(R.available(F.col("quality"), 0)).select("doc_id")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000 AND o_orderstatus IN ('O', 'F') AND o_orderkey >= 100")
def orm_between_in(t: Tables) -> DataFrame:
    return R.dynamic_filter(t.orders, o_totalprice=(1000, 50000), o_orderstatus=["O", "F"], o_orderkey=(100, None)).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%' AND p_size <> 7 AND p_brand LIKE 'Brand#1%' AND p_type ILIKE '%S%'")
def expression_operators(t: Tables) -> DataFrame:
    found = R.expression_filter(t.part, [("p_size", "!=", 7), ("p_brand", "%", "Brand#1%"), ("p_type", "**", "%S%")])
    return found.where(F.lower("p_name").contains("ring")).select("p_partkey", "p_name")


@query("""SELECT event_id, CASE WHEN event_type = 'purchase' AND value > 50 THEN 'big' WHEN contains(lower(event_type), 'sign') OR contains(lower(event_type), 'view') THEN 'visit'
 WHEN starts_with(lower(event_type), 'c') THEN 'click' ELSE 'rest' END AS route FROM events""")
def switch_routes(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value").cast("string")
    route = F.when(T.compare(kind, "=", F.lit("purchase")) & T.compare(value, ">", F.lit("50")), "big").when(T.compare(kind, "contains", F.lit("SIGN")) | T.compare(kind, "contains", F.lit("view")), "visit")
    return t.events.select("event_id", route.when(T.compare(kind, "start with", F.lit("C")), "click").otherwise("rest").alias("route"))


@query("""SELECT n_name, count(*) AS lines, round(sum(l_extendedprice), 2) AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def task_4way_join(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    named = lines.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows: Spark's own size check broadcasts it
    return named.groupBy("n_name").agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("SELECT DISTINCT d.source, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def left_outer_distinct_coalesce(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left").select("source", F.coalesce("quality", F.lit(-1)).alias("quality")).distinct()


@query("SELECT o_orderkey, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND o_orderstatus = 'O'")
def compound_on_join(t: Tables) -> DataFrame:
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_mktsegment") == "BUILDING") & (F.col("o_orderstatus") == "O")
    return t.orders.join(t.customer, on).select("o_orderkey", "o_orderdate")


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def semi_entities_reports(t: Tables) -> DataFrame:
    return t.documents.join(t.labels.where("toxic = 1"), "doc_id", "left_semi").select("doc_id")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_missing_docs(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def missing_batch_responses(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").exceptAll(t.labels.select("doc_id"))


@query("""WITH e AS (SELECT o_custkey % 40 AS s, o_orderkey % 40 AS d FROM orders) SELECT s, d, count(*) AS n FROM e WHERE s IN (1, 5, 9) OR d IN (1, 5, 9) GROUP BY s, d""")
def edges_of_community(t: Tables) -> DataFrame:
    edges = t.orders.select((F.col("o_custkey") % 40).alias("s"), (F.col("o_orderkey") % 40).alias("d"))
    members = t.spark.createDataFrame([(1,), (5,), (9,)], "m long")
    counted = edges.groupBy("s", "d").agg(F.count("*").alias("n"))  # distinct edges before the two equi-joins
    by = lambda c: counted.join(members, counted[c] == members["m"], "left_semi")
    return by("s").unionByName(by("d")).distinct()


@query("""SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS day, count(event_id) AS pv, count(DISTINCT user_id) AS uv, round(sum(value), 4) AS tokens, round(avg(value), 6) AS mean,
 round(sum(value) / (count(*) + 0.1), 6) AS speed, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS thumb_up FROM events GROUP BY 1""")
def usage_stats_daily(t: Tables) -> DataFrame:
    day = F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss")
    return t.events.groupBy(day.alias("day")).agg(
        F.count("event_id").alias("pv"),
        F.count_distinct("user_id").alias("uv"),
        F.round(F.sum("value"), 4).alias("tokens"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.sum("value") / (F.count("*") + F.lit(0.1)), 6).alias("speed"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("thumb_up"),
    )


@query("SELECT source AS name, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE lang = 'en' GROUP BY source ORDER BY n DESC, first_doc")
def facet_counts(t: Tables) -> DataFrame:
    return t.documents.where("lang = 'en'").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).orderBy(F.desc("n"), "first_doc")


@query("SELECT count(*) AS total FROM documents WHERE n_chars > 1000")
def total_hits(t: Tables) -> DataFrame:
    return t.documents.where("n_chars > 1000").agg(F.count("*").alias("total"))


@query("""WITH v AS (SELECT 'event_id' AS c, CAST(event_id AS VARCHAR) AS x FROM events UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events UNION ALL SELECT 'event_type', event_type FROM events
 UNION ALL SELECT 'day', strftime(ts, '%Y-%m-%d') FROM events), k AS (SELECT c, CASE WHEN regexp_full_match(x, '[+-]?[0-9]{0,19}(\\.0+)?%*') THEN 'int' WHEN regexp_full_match(x, '[+-]?[0-9.]{0,19}%*') THEN 'float'
 WHEN lower(x) IN ('true', 'yes', 'false', 'no') THEN 'bool' WHEN regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9:]+)?') THEN 'datetime' ELSE 'text' END AS kind FROM v),
 n AS (SELECT c, kind, count(*) AS n FROM k GROUP BY c, kind) SELECT c AS column_name, kind AS type_name FROM
 (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, list_position(['int', 'float', 'text', 'datetime', 'bool'], kind)) AS r FROM n) WHERE r = 1""".replace("\\\\", "\\"))
def column_type_vote(t: Tables) -> DataFrame:
    e = t.events.select(F.col("event_id").cast("string"), F.col("value").cast("string"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    cells = e.unpivot([], ["event_id", "value", "event_type", "day"], "column_name", "x")
    kind = (
        F.when(F.col("x").rlike(r"^[+-]?[0-9]{0,19}(\.0+)?%*$"), "int")
        .when(F.col("x").rlike(r"^[+-]?[0-9.]{0,19}%*$"), "float")
        .when(F.lower("x").isin("true", "yes", "false", "no"), "bool")
        .when(F.col("x").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9:]+)?$"), "datetime")
        .otherwise("text")
    )
    votes = cells.groupBy("column_name", kind.alias("type_name")).agg(F.count("*").alias("n"))
    order = F.array_position(F.array(*map(F.lit, ("int", "float", "text", "datetime", "bool"))), F.col("type_name"))
    return R.first_by(votes, ["column_name"], F.desc("n"), order).drop("n")


@query("SELECT p_brand AS label, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, label LIMIT 20")
def group_label_top20(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_brand").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(20)


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedupe_keep_first(t: Tables) -> DataFrame:
    return t.documents.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")


@query("SELECT md5(text) AS id, count(*) AS n, min(doc_id) AS keeper FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_groups_having(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.md5("text").alias("id")).agg(F.count("*").alias("n"), F.min("doc_id").alias("keeper")).where("n > 1")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_snapshot_per_key(t: Tables) -> DataFrame:
    return R.first_by(t.orders, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderdate")


@query("""SELECT user_id, event_id, sum(CASE WHEN event_type = 'signup' AND prev IS DISTINCT FROM 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS section
 FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)""")
def section_ids_lag_runsum(t: Tables) -> DataFrame:
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    starts = F.when((F.col("event_type") == "signup") & ~F.col("prev").eqNullSafe(F.lit("signup")), 1).otherwise(0)
    return t.events.withColumn("prev", F.lag("event_type").over(w)).select("user_id", "event_id", F.sum(starts).over(w).alias("section"))


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 3")
def history_window_last_n(t: Tables) -> DataFrame:
    return R.last_n_by(t.conversations, ["conv_id"], F.desc("turn"), 3).select("conv_id", "turn", "role")


@query("SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations WHERE role = 'user') WHERE r <= 3")
def last3_questions(t: Tables) -> DataFrame:
    return R.last_n_by(t.conversations.where("role = 'user'"), ["conv_id"], F.desc("turn"), 3).select("conv_id", "turn", "text")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 40")
def paginate_sorted(t: Tables) -> DataFrame:
    return R.page(t.documents.select("doc_id", "n_chars"), 3, 20, F.desc("n_chars"), F.col("doc_id"))


@query("""WITH a AS (SELECT text AS content, 0 AS f, conv_id AS id FROM conversations UNION ALL SELECT text, 1, doc_id FROM documents)
 SELECT content, id FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY f, id) AS r FROM a) WHERE r = 1""")
def union_dedupe_content(t: Tables) -> DataFrame:
    a = t.conversations.select(F.col("text").alias("content"), F.col("conv_id").alias("id"))
    return R.content_union(a, t.documents.select(F.col("text").alias("content"), F.col("doc_id").alias("id")))


@query("""SELECT user_id, list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',') AS kinds, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 AS failed,
 round(avg(greatest(value, 0)), 6) AS progress FROM events GROUP BY user_id""")
def progress_rollup(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"),
        F.bool_or(F.col("event_type") == "error").alias("failed"),
        F.round(F.avg(F.greatest("value", F.lit(0.0))), 6).alias("progress"),
    )


@query("SELECT CAST(median(l_extendedprice) AS DOUBLE) AS middle, l_returnflag FROM lineitem GROUP BY l_returnflag")
def median_heights(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_extendedprice").alias("middle"))


@query("""WITH RECURSIVE up AS (SELECT p_partkey AS id, p_partkey AS cur, 0 AS depth FROM part UNION ALL SELECT id, CAST((cur - cur % 10) / 10 AS BIGINT), depth + 1 FROM up WHERE cur >= 10)
 SELECT id, list_aggregate(list(cur ORDER BY depth), 'string_agg', '/') AS path FROM up GROUP BY id""")
def file_tree_ancestors(t: Tables) -> DataFrame:
    # A parent is the key without its last digit, so the path follows from the key: no iteration.
    key = F.col("p_partkey").cast("string")
    path = F.transform(F.sequence(F.length(key), F.lit(1), F.lit(-1)), lambda n: F.substring(key, F.lit(1), n))
    return t.part.select(F.col("p_partkey").alias("id"), F.array_join(path, "/").alias("path"))


@query("""WITH RECURSIVE up AS (SELECT p_partkey AS cur, p_size AS size FROM part UNION ALL SELECT CAST((cur - cur % 10) / 10 AS BIGINT), size FROM up WHERE cur >= 10)
 SELECT cur AS folder, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files FROM up GROUP BY cur""")
def file_tree_sizes(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    up = t.part.select("p_size", F.explode(F.transform(F.sequence(F.lit(1), F.length(key)), lambda n: F.substring(key, F.lit(1), n).cast("long"))).alias("folder"))
    return up.groupBy("folder").agg(F.sum("p_size").alias("bytes"), F.count("*").alias("files"))
