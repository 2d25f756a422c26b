"""Queries of graphs as index chunks; the graphs are those of plans.graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import graph as G
from lodestone.operators import knowledge as K
from lodestone.operators import sql_surface as S
from lodestone.plans.catalogue import Tables, lists
from lodestone.plans.graph import _E, _N, _rows

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)

_RANK = f"WITH n AS ({_N}), e AS (SELECT DISTINCT src, dst FROM ({_E})), r AS (SELECT name, count(*) AS rank FROM (SELECT src AS name FROM e UNION ALL SELECT dst FROM e) GROUP BY name)"


def _graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = _rows(t)
    edges = G.merge_edges(G.edges_of(rows, "o_orderkey"))
    nodes = G.merge_nodes(G.nodes_of(rows, "o_orderkey")).join(G.degrees(edges), "name", "left").fillna(0, ["rank"])
    return nodes, edges


@query(_RANK + " SELECT n.name AS name_kwd, array_to_string(regexp_extract_all(lower(n.name), '[a-z0-9]+'), ' ') AS title_tks, max(rank) AS rank_int, 'entity' AS knowledge_graph_kwd FROM n JOIN r ON n.name = r.name GROUP BY n.name")
def graph_entity_chunks(t: Tables) -> DataFrame:
    return K.entity_chunks(_graph(t)[0]).select("name_kwd", "title_tks", "rank_int", "knowledge_graph_kwd")


@query("""SELECT o_orderkey AS doc, '{"directed":false,"multigraph":false,"nodes":[{"id":"' || upper(c_name) || '"}],"links":[{"source":"' || least(upper(c_name), upper(o_orderpriority)) || '","target":"' || greatest(upper(c_name), upper(o_orderpriority)) || '","weight":1}]}' AS content_with_weight, 'graph' AS knowledge_graph_kwd FROM orders JOIN customer ON o_custkey = c_custkey""")
def graph_document_chunks(t: Tables) -> DataFrame:
    rows = _rows(t)
    key = lambda df: df.withColumn("doc", F.col("source_id").cast("long"))
    return K.graph_chunks(key(G.nodes_of(rows, "o_orderkey")), key(G.edges_of(rows, "o_orderkey")).withColumn("weight", F.lit(1).cast("long")), "doc")


@query(f"WITH n AS ({_N}) SELECT name, type, source_id FROM n WHERE source_id = '1' OR name IN ('CUSTOMER#000000007', 'CUSTOMER#000000010')")
def graph_load(t: Tables) -> DataFrame:
    nodes = G.nodes_of(_rows(t), "o_orderkey").withColumn("doc_id", F.col("source_id"))
    return K.load(nodes, "1", ["CUSTOMER#000000007", "CUSTOMER#000000010"]).select("name", "type", "source_id")


@query(f"WITH n AS ({_N}), k AS (SELECT * FROM n WHERE source_id <> '7') SELECT name, count(*) AS sources FROM k GROUP BY name")
def graph_remove_document(t: Tables) -> DataFrame:
    left = K.without_source(G.merge_nodes(G.nodes_of(_rows(t), "o_orderkey")), F.lit("7"))
    return left.select("name", F.size(F.split("source_id", "\n")).cast("long").alias("sources"))


@query("""WITH a AS (SELECT c_name AS name, c_custkey AS weight, 'd' || c_nationkey AS description, '1' || chr(10) || '2' AS source_id FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_name AS name, 5 AS weight, 'd1' AS description, '2' || chr(10) || '3' AS source_id FROM customer WHERE c_custkey % 3 = 0)
 SELECT name, coalesce(a.weight, 0) + coalesce(b.weight, 0) AS weight, CASE WHEN a.name IS NULL THEN b.description WHEN b.name IS NULL OR a.description = b.description THEN a.description ELSE least(a.description, b.description) || chr(10) || greatest(a.description, b.description) END AS description,
 CASE WHEN a.name IS NULL THEN b.source_id WHEN b.name IS NULL THEN a.source_id ELSE '1' || chr(10) || '2' || chr(10) || '3' END AS source_id FROM a FULL JOIN b USING (name)""")
def graph_add_document(t: Tables) -> DataFrame:
    side = lambda where, w, d, s: t.customer.where(where).select(F.col("c_name").alias("name"), w.alias("weight"), d.alias("description"), F.lit(s).alias("source_id"))
    old = side("c_custkey % 2 = 0", F.col("c_custkey"), F.concat(F.lit("d"), "c_nationkey"), "1\n2")
    return K.with_source(old, side("c_custkey % 3 = 0", F.lit(5).cast("long"), F.lit("d1"), "2\n3"), ["name"])


@query("""WITH m AS (SELECT n_name AS name, n_regionkey AS community FROM nation), e AS (SELECT name, community, row_number() OVER (PARTITION BY community ORDER BY name) - 1 AS i FROM m)
 SELECT community, 'id,entity,type,description' || chr(10) || string_agg(i || ',' || name || ',NATION,', chr(10) ORDER BY i) AS entities, CAST(count(*) - 1 AS BIGINT) AS n_relations FROM e GROUP BY community""")
def community_report_inputs(t: Tables) -> DataFrame:
    """Nations are entities, regions communities; each nation is tied to the first of its region."""
    nation = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("community"))
    first = nation.groupBy("community").agg(F.min("name").alias("first"))
    edges = nation.join(first, "community").where("name <> first").select(F.col("first").alias("src"), F.col("name").alias("dst"), F.lit(1).alias("weight"), F.lit("same, region").alias("description"))
    nodes = nation.select("name", F.lit("NATION").alias("type"), F.lit("").alias("description"))
    out = K.report_inputs(nation.select(F.col("name").alias("node"), "community"), nodes, edges)
    return out.select("community", "entities", (F.size(F.split("relations", "\n")) - 1).cast("long").alias("n_relations"))


@query("SELECT o_orderkey, 'C' || (o_custkey % 100) AS subject_id, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS object_id FROM orders")
def claims_resolved(t: Tables) -> DataFrame:
    claims = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("subject_id"), F.col("o_orderstatus").alias("object_id"))
    names = t.customer.select(F.col("c_custkey").cast("string").alias("name"), F.concat(F.lit("C"), F.col("c_custkey") % 100).alias("entity"))
    names = names.unionByName(t.spark.createDataFrame([("O", "open")], "name string, entity string"))
    return K.resolved_claims(claims, names).select("o_orderkey", "subject_id", "object_id")


@query("SELECT doc_id, source AS docnm_kwd, lang, n_chars FROM documents WHERE lang = 'fr'")
def sql_auto_projection(t: Tables) -> DataFrame:
    chunks = t.documents.select("doc_id", F.col("source").alias("docnm_kwd"), "lang", "n_chars", "text")
    return S.run(t.spark, {"chunks": chunks}, K.projected("select * from chunks where lang = 'fr'", ["lang", "n_chars", "text"], hidden=("text",)))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 2 END AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'the following ' || o_orderpriority || ' orders are to be checked again:' END AS title FROM orders")
def colon_titles(t: Tables) -> DataFrame:
    long = F.concat(F.lit("It came late. the following "), "o_orderpriority", F.lit(" orders are to be checked again:"))
    sections = F.array(F.lit("a line"), F.when(F.col("o_orderkey") % 2 == 0, long).otherwise("Short. So:"))
    found = t.orders.select("o_orderkey", K.colon_titles(sections).alias("s"))
    return found.select("o_orderkey", F.size("s").alias("n"), F.when(F.size("s") == 3, F.get("s", F.lit(1))).alias("title"))
