"""Knowledge-graph queries; extraction answers are rendered from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import graph as G
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


def _answers(t: Tables) -> DataFrame:
    """One extraction answer for each order: a customer, its segment, and the order's tie to its clerk's priority."""
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    entity = F.concat(F.lit('("entity"<|>'), "c_name", F.lit("<|>"), "c_mktsegment", F.lit("<|>status "), "o_orderstatus", F.lit(")"))
    relation = F.concat(F.lit('##("relationship"<|>'), "c_name", F.lit("<|>"), "o_orderpriority", F.lit("<|>ordered "), "o_orderstatus", F.lit("<|>9)<|COMPLETE|>"))
    return both.select("o_orderkey", F.concat(entity, relation).alias("answer"))


def _rows(t: Tables) -> DataFrame:
    return G.records(_answers(t), "o_orderkey", "answer")


_N = "SELECT upper(c_name) AS name, upper(c_mktsegment) AS type, 'status ' || o_orderstatus AS description, CAST(o_orderkey AS VARCHAR) AS source_id FROM orders JOIN customer ON o_custkey = c_custkey"
_E = "SELECT least(upper(c_name), upper(o_orderpriority)) AS src, greatest(upper(c_name), upper(o_orderpriority)) AS dst, 'ordered ' || o_orderstatus AS description, CAST(o_orderkey AS VARCHAR) AS source_id FROM orders JOIN customer ON o_custkey = c_custkey"


@query(_N)
def graph_parse_records(t: Tables) -> DataFrame:
    return G.nodes_of(_rows(t), "o_orderkey")


@query(f"WITH n AS ({_N}) SELECT name, max(type) AS type, string_agg(DISTINCT description, chr(10) ORDER BY description) AS description, count(*) AS mentions FROM n GROUP BY name")
def graph_merge_nodes(t: Tables) -> DataFrame:
    merged = G.merge_nodes(G.nodes_of(_rows(t), "o_orderkey"))
    return merged.select("name", "type", "description", F.size(F.split("source_id", "\n")).cast("long").alias("mentions"))


@query(f"WITH e AS ({_E}) SELECT src, dst, count(*) AS weight, string_agg(DISTINCT description, chr(10) ORDER BY description) AS description FROM e GROUP BY src, dst")
def graph_merge_edges(t: Tables) -> DataFrame:
    return G.merge_edges(G.edges_of(_rows(t), "o_orderkey")).select("src", "dst", "weight", "description")


@query(f"WITH e AS (SELECT DISTINCT src, dst FROM ({_E})) SELECT name, count(*) AS rank FROM (SELECT src AS name FROM e UNION ALL SELECT dst FROM e) GROUP BY name")
def graph_degree(t: Tables) -> DataFrame:
    return G.degrees(G.merge_edges(G.edges_of(_rows(t), "o_orderkey")))


@query(f"WITH e AS ({_E}), n AS ({_N}) SELECT DISTINCT name, max(type) AS type FROM (SELECT name, type FROM n UNION ALL SELECT src, NULL FROM e UNION ALL SELECT dst, NULL FROM e) GROUP BY name")
def graph_implicit_endpoints(t: Tables) -> DataFrame:
    rows = _rows(t)
    nodes = G.merge_nodes(G.nodes_of(rows, "o_orderkey")).select("name", "type")
    return G.with_endpoints(nodes, G.edges_of(rows, "o_orderkey"))


@query("""WITH a AS (SELECT CAST(n_nationkey AS VARCHAR) AS name, n_nationkey + 1 AS weight, n_name AS description FROM nation WHERE n_nationkey < 15), b AS (SELECT CAST(n_nationkey AS VARCHAR) AS name, n_nationkey + 5 AS weight, 'b ' || n_nationkey AS description FROM nation WHERE n_nationkey > 9)
 SELECT coalesce(a.name, b.name) AS name, CAST(CASE WHEN a.name IS NULL THEN b.weight WHEN b.name IS NULL THEN a.weight ELSE b.weight + 1 END AS INTEGER) AS weight,
 CASE WHEN a.name IS NULL THEN b.description WHEN b.name IS NULL THEN a.description ELSE b.description || chr(10) || a.description END AS description FROM a FULL JOIN b ON a.name = b.name""")
def graph_fold(t: Tables) -> DataFrame:
    n = t.nation
    name = F.col("n_nationkey").cast("string").alias("name")
    a = n.where("n_nationkey < 15").select(name, (F.col("n_nationkey") + 1).alias("weight"), F.col("n_name").alias("description"))
    b = n.where("n_nationkey > 9").select(name, (F.col("n_nationkey") + 5).alias("weight"), F.concat(F.lit("b "), F.col("n_nationkey").cast("string")).alias("description"))
    return G.fold(a, b, ["name"], keep_first=False)


def _geography(t: Tables) -> DataFrame:
    home = t.customer.select(F.col("c_custkey").alias("src"), (F.col("c_nationkey") + 10_000_000).cast("long").alias("dst"))
    part = t.nation.select((F.col("n_nationkey") + 10_000_000).cast("long").alias("src"), (F.col("n_regionkey") + 20_000_000).cast("long").alias("dst"))
    return home.unionByName(part)


_GEO = "WITH g AS (SELECT n_nationkey, n_regionkey, coalesce(min(c_custkey) OVER (PARTITION BY n_regionkey), min(n_nationkey + 10000000) OVER (PARTITION BY n_regionkey)) AS component, c_custkey FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey), u AS (SELECT c_custkey AS node, component FROM g WHERE c_custkey IS NOT NULL UNION SELECT n_nationkey + 10000000, component FROM g UNION SELECT n_regionkey + 20000000, component FROM g)"


@query(_GEO + " SELECT node, component FROM u")
def graph_connected_components(t: Tables) -> DataFrame:
    return G.connected(_geography(t))


@query(_GEO + " SELECT node FROM u WHERE component = (SELECT component FROM u GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)")
def largest_cc(t: Tables) -> DataFrame:
    return G.largest_component(_geography(t))


_PAIRS = "WITH n AS (SELECT DISTINCT p_type, p_name FROM part) SELECT a.p_type, a.p_name AS a, b.p_name AS b FROM n a JOIN n b ON a.p_type = b.p_type AND a.p_name < b.p_name WHERE levenshtein(a.p_name, b.p_name) <= least(length(a.p_name), length(b.p_name)) // 2"


@query(_PAIRS.replace("least(length(a.p_name), length(b.p_name)) // 2", "floor(least(length(a.p_name), length(b.p_name)) / 2)"))
def entity_resolution_pairs(t: Tables) -> DataFrame:
    return G.resolution_pairs(t.part, "p_type", "p_name")


@query("""WITH e AS (SELECT o_custkey % 30 AS a, o_orderkey % 30 AS b, count(*) AS weight FROM orders GROUP BY 1, 2), m AS (SELECT a - a % 3 AS a, b - b % 3 AS b, weight FROM e)
 SELECT least(a, b) AS src, greatest(a, b) AS dst, CAST(sum(weight) AS BIGINT) AS weight FROM m WHERE a <> b GROUP BY 1, 2""")
def entity_resolution_contract(t: Tables) -> DataFrame:
    edges = t.orders.groupBy((F.col("o_custkey") % 30).alias("src"), (F.col("o_orderkey") % 30).alias("dst")).agg(F.count("*").alias("weight"))
    groups = t.spark.range(30).select(F.col("id").alias("node"), (F.col("id") - F.col("id") % 3).alias("component"))
    return G.contract(edges, groups)


def _propagation_sql(rounds: int) -> str:
    """Synchronous label propagation, each round a few tables of its own."""
    out = ["WITH e AS (SELECT o_custkey % 200 AS src, o_orderkey % 7 + 1000 AS dst, count(*) AS weight FROM orders GROUP BY 1, 2), w AS (SELECT src AS a, dst AS b, weight FROM e UNION ALL SELECT dst, src, weight FROM e), l0 AS (SELECT DISTINCT a AS node, a AS community FROM w)"]
    for k in range(rounds):
        votes = f"SELECT a AS node, community, weight FROM w JOIN l{k} ON b = node UNION ALL SELECT node, community, 1 FROM l{k}"
        out.append(f"v{k} AS (SELECT node, community, sum(weight) AS weight FROM ({votes}) GROUP BY node, community)")
        out.append(f"l{k + 1} AS (SELECT node, community FROM v{k} QUALIFY row_number() OVER (PARTITION BY node ORDER BY weight DESC, community) = 1)")
    return ", ".join(out) + f" SELECT node, community FROM l{rounds}"


@query(_propagation_sql(5))
def graph_communities(t: Tables) -> DataFrame:
    edges = t.orders.groupBy((F.col("o_custkey") % 200).alias("src"), (F.col("o_orderkey") % 7 + 1000).alias("dst")).agg(F.count("*").alias("weight"))
    return G.communities(edges)


@query("""WITH s AS (SELECT p_type AS community, CAST(sum(p_size * 2) AS DOUBLE) AS w FROM part GROUP BY p_type) SELECT community, round(w / (SELECT max(w) FROM s), 6) AS weight FROM s""")
def community_weight(t: Tables) -> DataFrame:
    members = t.part.select(F.col("p_partkey").alias("node"), F.col("p_type").alias("community"))
    nodes = t.part.select(F.col("p_partkey").alias("name"), F.col("p_size").alias("rank"), F.lit(2).alias("weight"))
    return G.community_weights(members, nodes).select("community", F.round("weight", 6).alias("weight"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand || '(' || '零件' || ')' ELSE p_brand || '(' || p_name || ')' END AS name FROM part")
def name_normalise(t: Tables) -> DataFrame:
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(" "))
    cjk = F.concat(F.lit("零件 （ "), brand, F.lit(" ）"))
    latin = F.concat(F.col("p_brand"), F.lit(" ( "), "p_name", F.lit(" )"))
    out = G.normal_name(F.when(F.col("p_partkey") % 2 == 0, cjk).otherwise(latin))
    even = F.replace(out, F.lit("Brand "), F.lit("Brand#"))
    return t.part.select("p_partkey", even.alias("name"))


@query("SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'SMALL' WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'ECONOMY' ELSE p_type END AS type FROM part")
def type_canonicalise(t: Tables) -> DataFrame:
    return G.canonical_types(t.part.select("p_partkey", F.col("p_type").alias("type")), [["SMALL", "MEDIUM"], ["ECONOMY", "PROMO"]])


@query("SELECT p_name AS name, p_partkey, coalesce(CASE WHEN p_size % 3 > 0 THEN p_type END, p_brand) AS type FROM part WHERE p_name <> 'blue bolt' AND p_size % 5 > 0")
def dirty_clean(t: Tables) -> DataFrame:
    nodes = t.part.select(F.col("p_name").alias("name"), "p_partkey", F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("type"), F.col("p_brand").alias("label"), F.when(F.col("p_size") % 5 > 0, "s").alias("source_id"), F.lit("d").alias("description"))
    return G.clean_nodes(nodes, ["blue bolt"]).select("name", "p_partkey", "type")


@query("""SELECT p_brand, bool_or(p_type = 'SMALL' AND contains(p_name, 'ring')) AND NOT bool_or(p_type = 'ECONOMY' AND p_name = 'red widget') AS strict,
 bool_or(p_type = 'PROMO') OR bool_or(p_type = 'LARGE' AND regexp_matches(p_name, '^(red|blue) ')) AS loose FROM part GROUP BY p_brand""")
def rule_eval(t: Tables) -> DataFrame:
    nodes = t.part.select("p_brand", F.col("p_type").alias("type"), F.create_map(F.lit("name"), "p_name").alias("attributes"))
    return G.evaluate_rules(nodes, "p_brand", {"strict": "SMALL ~ 'ring' and not ECONOMY.name = 'red widget'", "loose": "PROMO or LARGE =~ '^(red|blue) '"})


@query("SELECT o_orderkey, c_name AS subject_id, o_orderpriority AS object_id, o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'")
def claims_parse(t: Tables) -> DataFrame:
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    target = F.when(F.col("o_orderstatus") == "P", "NONE").otherwise(F.col("o_orderpriority"))
    text = F.concat(F.lit("("), F.concat_ws("<|>", "c_name", target, F.lit("T"), "o_orderstatus", F.lit("2020"), F.lit("2021"), F.lit("d"), F.lit("s")), F.lit(")<|COMPLETE|>"))
    return G.claims(both.select("o_orderkey", text.alias("x")), "o_orderkey", "x").select("o_orderkey", "subject_id", "object_id", "status")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '1,3' ELSE '3' END AS yes FROM orders")
def resolution_answers(t: Tables) -> DataFrame:
    first = F.when(F.col("o_orderkey") % 2 == 0, "yes").otherwise("no")
    text = F.concat(F.lit("q<|>1<|> &&"), first, F.lit("&&##q<|>2<|>&&no&&##q<|>3<|>&&YES&&##q<|>31<|>&&yes&&"))
    return t.orders.select("o_orderkey", F.array_join(G.yes_pairs(text), ",").alias("yes"))


@query("""WITH e AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part QUALIFY rank <= 32),
 r AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier WHERE 'Brand#' || (s_suppkey % 25 + 1) IN (SELECT p_brand FROM e) QUALIFY rank <= 32),
 x AS (SELECT CAST(doc_id AS VARCHAR) AS id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 6)
 SELECT 'entity' AS bucket, rank, id FROM e UNION ALL SELECT 'community', rank, id FROM r UNION ALL SELECT 'text', rank, id FROM x""")
def kg_search_three_buckets(t: Tables) -> DataFrame:
    entities = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"), F.col("p_retailprice").alias("score"))
    reports = t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 25 + 1).cast("string")).alias("entity"), F.col("s_acctbal").alias("score"))
    return G.search(entities, reports, t.documents.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("score")), "score")
