"""Upserts, updates, deletes and rendered results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import dml as D
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


@query("""WITH n AS (SELECT o_orderkey + 7 AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'X' END AS s, o_totalprice * 2 AS p FROM orders WHERE o_orderkey % 5 = 0)
 SELECT coalesce(o.o_orderkey, n.k) AS o_orderkey, coalesce(n.s, o.o_orderstatus) AS o_orderstatus, coalesce(o.o_totalprice, n.p) AS o_totalprice
 FROM orders o FULL OUTER JOIN n ON o.o_orderkey = n.k""")
def upsert_merge(t: Tables) -> DataFrame:
    old = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = t.orders.where("o_orderkey % 5 = 0").select((F.col("o_orderkey") + 7).alias("o_orderkey"), F.when(F.col("o_orderkey") % 3 != 0, "X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return D.upsert(old, new, "o_orderkey", keep=("o_totalprice",))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 = 1 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def update_by_query(t: Tables) -> DataFrame:
    return D.update_where(t.orders, F.col("o_custkey") % 4 == 1, o_orderstatus=F.lit("Z")).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 1000)")
def delete_by_query(t: Tables) -> DataFrame:
    return D.delete_where(t.orders, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)).select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_by_ids(t: Tables) -> DataFrame:
    return D.delete_ids(t.documents, t.labels.where("toxic = 1"), "doc_id").select("doc_id")


@query("SELECT source, count(*) AS chunk_num, CAST(sum(n_chars) AS BIGINT) AS token_num FROM documents GROUP BY source")
def counters_recomputed(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count("*").alias("chunk_num"), F.sum("n_chars").alias("token_num"))


@query("""SELECT '|n_nationkey|n_name|' || chr(10) || '|---|---|' || chr(10) || string_agg('|' || n_nationkey || '|' || n_name || '|', chr(10) ORDER BY n_nationkey) AS markdown FROM nation""")
def sql_markdown(t: Tables) -> DataFrame:
    return D.markdown_table(t.nation, ["n_nationkey", "n_name"], ["n_nationkey"])
