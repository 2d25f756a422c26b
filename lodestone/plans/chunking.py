"""Chunking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.functions import text as T
from lodestone.operators import chunking as C
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)

_N = "len(regexp_extract_all({}, '[A-Za-z0-9]+|[^\\sA-Za-z0-9]'))"


def _greedy_sql(pieces: str) -> str:
    return f"""WITH RECURSIVE p AS (SELECT doc_id, unnest({pieces}) AS s, generate_subscripts({pieces}, 1) AS i FROM documents), k AS (SELECT doc_id, i, s, {_N.format('s')} AS n FROM p),
 g AS (SELECT doc_id, i, 0 AS chunk, n AS used FROM k WHERE i = 1 UNION ALL SELECT k.doc_id, k.i, CASE WHEN g.used > 128 THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.used > 128 THEN k.n ELSE g.used + k.n END
 FROM g JOIN k ON k.doc_id = g.doc_id AND k.i = g.i + 1) SELECT g.doc_id, chunk, md5(string_agg(s, '' ORDER BY g.i)) AS content FROM g JOIN k ON k.doc_id = g.doc_id AND k.i = g.i GROUP BY g.doc_id, chunk"""


@query(_greedy_sql("string_split(text, chr(10))"))
def chunk_naive_merge(t: Tables) -> DataFrame:
    chunks = C.greedy(F.split("text", "\n"))
    return t.documents.select("doc_id", F.posexplode(chunks).alias("chunk", "content")).withColumn("content", F.md5("content"))


@query(_greedy_sql("regexp_extract_all(text, '(?s).[^\\n!?;。；！？]*[\\n!?;。；！？]?')"))
def chunk_parser_txt(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(C.plain_chunks(F.col("text"))).alias("chunk", "content")).withColumn("content", F.md5("content"))


@query("SELECT doc_id, md5(text || doc_id) AS id FROM documents")
def chunk_ids_md5(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.chunk_id(F.col("text"), F.col("doc_id")).alias("id"))


@query("""WITH RECURSIVE k AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) AS n FROM conversations),
 g AS (SELECT conv_id, turn, i, 0 AS pack, 0 AS place, n AS used FROM k WHERE i = 1 UNION ALL SELECT k.conv_id, k.turn, k.i, CASE WHEN g.used + k.n >= 400 THEN g.pack + 1 ELSE g.pack END,
 CASE WHEN g.used + k.n >= 400 THEN 0 ELSE g.place + 1 END, CASE WHEN g.used + k.n >= 400 THEN k.n ELSE g.used + k.n END FROM g JOIN k ON k.conv_id = g.conv_id AND k.i = g.i + 1)
 SELECT conv_id, turn, pack, CAST(floor(place / 4) AS INTEGER) AS batch FROM g""")
def pack_sub_texts(t: Tables) -> DataFrame:
    return C.packed(t.conversations.withColumn("n", F.length("text")), "conv_id", "turn", "n", 400)


@query("SELECT p_partkey, 'p_name:' || p_name || '; p_brand:' || p_brand || '; p_size:' || p_size AS content FROM part")
def table_rows_to_chunks(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", C.row_chunks(t.part, ["p_name", "p_brand", "p_size"]).alias("content"))


@query("""SELECT p_brand, chunk, string_agg(p_name, '; ' ORDER BY p_partkey) AS content FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) / 10) AS INTEGER) AS chunk FROM part) GROUP BY p_brand, chunk""")
def table_row_groups(t: Tables) -> DataFrame:
    return C.grouped_rows(t.part, "p_partkey", "p_name", partition="p_brand")


@query("""WITH m AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS q FROM conversations)
 SELECT conv_id, max(CASE WHEN role = 'user' THEN text END) AS question, string_agg(CASE WHEN role <> 'user' THEN text END, chr(10) ORDER BY turn) AS answer FROM m WHERE q > 0 GROUP BY conv_id, q HAVING count(*) FILTER (WHERE role <> 'user') > 0""")
def qa_pairs(t: Tables) -> DataFrame:
    mine = F.col("role") == "user"
    lines = t.conversations.select("conv_id", "turn", F.when(mine, F.col("text")).alias("q"), F.when(~mine, F.col("text")).alias("a"))
    return C.question_pairs(lines, "conv_id", "turn", "q", "a")


@query("SELECT doc_id, unnest(generate_series(0, n_chars - 1, 3000)) AS from_, least(unnest(generate_series(0, n_chars - 1, 3000)) + 3000, n_chars) AS to_ FROM documents WHERE n_chars > 0")
def task_split_ranges(t: Tables) -> DataFrame:
    return C.task_ranges(t.documents.where("n_chars > 0").select("doc_id", "n_chars"), "n_chars", 3000).select("doc_id", "from_", "to_")


@query("""WITH l AS (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 END AS lvl FROM events),
 h AS (SELECT *, max(CASE WHEN lvl = 1 THEN event_id END) OVER w AS a, max(CASE WHEN lvl = 2 THEN event_id END) OVER w AS b FROM l WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
 SELECT user_id, event_id, concat_ws(chr(10), CAST(a AS VARCHAR), CASE WHEN b > coalesce(a, -1) THEN CAST(b AS VARCHAR) END, CAST(event_id AS VARCHAR)) AS content FROM h WHERE lvl IS NULL""")
def hierarchical_merge(t: Tables) -> DataFrame:
    level = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "purchase", 2)
    lines = t.events.select("user_id", "event_id", level.alias("level"), F.col("event_id").cast("string").alias("text"))
    return C.hierarchical(lines, "user_id", "event_id", "level", "text", depth=2)


@query("SELECT o_custkey, count(*) AS n_rows, 'notes of ' || o_custkey || chr(10) || 'end of ' || o_custkey AS rest FROM orders GROUP BY o_custkey")
def markdown_scan(t: Tables) -> DataFrame:
    # A page for each customer: a line, a table of the orders, a line.
    row = F.concat_ws("", F.lit("| "), F.col("o_orderkey").cast("string"), F.lit(" | "), "o_orderstatus", F.lit(" |\n"))
    pages = t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    text = F.concat(F.lit("notes of "), F.col("o_custkey"), F.lit("\n| key | status |\n|:---|---:|\n"), "rows", F.lit("end of "), F.col("o_custkey"))
    tables = C.markdown_tables(text)
    n_rows = F.aggregate(tables, F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit("\n")) - 2).cast("long")
    return pages.select("o_custkey", n_rows.alias("n_rows"), C.without_tables(text).alias("rest"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 1 AND regexp_matches(substr(text, 1, 1024), '[À-ÿ]([\\x00-\\x7f]|$)') AND NOT regexp_matches(text, '[^\\x00-ÿ]') THEN NULL ELSE 'utf-8' END AS codec FROM documents WHERE doc_id % 3 <> 2")
def codec_detection(t: Tables) -> DataFrame:
    """Texts in UTF-8, and in Latin-1 where every third has bytes beyond ASCII; which of the older codecs is found first is tested apart."""
    kind = F.col("doc_id") % 3
    blob = F.when((kind == 1) & ~F.col("text").rlike(r"[^\x00-\xff]"), F.expr("encode(text, 'ISO-8859-1')")).otherwise(F.col("text").cast("binary"))
    found = C.codec(blob)
    return t.documents.where(kind != 2).select("doc_id", F.when(found == "utf-8", found).alias("codec"))


@query("""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), e AS (SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS i, unnest(ls) AS l FROM d)
 SELECT doc_id, sum(length(l)) AS chars, count(*) AS n_lines FROM e GROUP BY doc_id""")
def json_scan(t: Tables) -> DataFrame:
    """Each document as nested JSON; its chunks hold every line once, at its place."""
    value = F.to_json(F.struct(F.lit("doc").alias("kind"), F.struct(F.split("text", "\n").alias("lines")).alias("body")))
    chunks = t.documents.select("doc_id", F.explode(C.json_chunks(value)).alias("chunk"))
    lines = F.from_json("chunk", "struct<body:struct<lines:map<string,string>>>")["body"]["lines"]
    each = chunks.select("doc_id", F.explode(lines).alias("place", "line"))
    return each.groupBy("doc_id").agg(F.sum(F.length("line")).alias("chars"), F.count("*").alias("n_lines"))


@query("""WITH b AS (SELECT l_orderkey AS page, l_linenumber AS id, l_quantity AS x0, l_quantity + 8 AS x1 FROM lineitem WHERE l_linenumber <= 3), y AS (SELECT l_orderkey AS page, l_linenumber AS id, l_discount * 500 AS x0, l_discount * 500 + 20 AS x1 FROM lineitem WHERE l_linenumber > 3),
 o AS (SELECT b.page, b.id AS box, y.id AS layout, least(b.x1, y.x1) - greatest(b.x0, y.x0) AS overlap FROM b JOIN y ON b.page = y.page AND b.x0 < y.x1 AND b.x1 > y.x0)
 SELECT page, box, layout FROM (SELECT *, row_number() OVER (PARTITION BY page, box ORDER BY round(overlap, 6) DESC, layout) AS r FROM o) WHERE r = 1""")
def range_overlap_join(t: Tables) -> DataFrame:
    from lodestone.operators.relational import first_by

    side = lambda where, x0, x1, name: t.lineitem.where(where).select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias(name), x0.alias(f"{name}0"), x1.alias(f"{name}1"))
    boxes = side("l_linenumber <= 3", F.col("l_quantity"), F.col("l_quantity") + 8, "box")
    layouts = side("l_linenumber > 3", F.col("l_discount") * 500, F.col("l_discount") * 500 + 20, "layout")
    both = boxes.join(layouts, "page").where("box0 < layout1 and box1 > layout0")  # an equi-join on the page first
    overlap = F.round(F.least("box1", "layout1") - F.greatest("box0", "layout0"), 6)
    return first_by(both.withColumn("overlap", overlap), ["page", "box"], F.desc("overlap"), F.col("layout")).select("page", "box", "layout")
