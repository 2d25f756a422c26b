"""Scalar text functions over the text tables, and the SQL surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.functions import text as T
from lodestone.operators import sql_surface as S
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


@query("SELECT doc_id, md5(text || 'ABC 123(x)') AS half FROM documents")
def str_q2b(t: Tables) -> DataFrame:
    # Each text as it would come in full width: the function has to give the text back.
    wide = F.translate("text", " " + "".join(map(chr, range(0x21, 0x7F))), "　" + "".join(map(chr, range(0xFF01, 0xFF5F))))
    return t.documents.select("doc_id", F.md5(T.half_width(F.concat(wide, F.lit("ＡＢＣ　１２３（ｘ）")))).alias("half"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)([^a-z0-9.,\\)>]) +([^ ])', '\\1\\2', 'g'), '(?i)([^ ]) +([^a-z0-9.,\\(<])', '\\1\\2', 'g') AS text FROM documents""".replace("\\\\", "\\"))
def rm_space(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.squeeze_blanks(F.col("text")).alias("text"))


@query("""SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(trim(url || ' "' || page_id || '" &amp;lt; &lt;b&gt;'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'),
 '["\\x00-\\x1f\\x7f-\\x9f]', '', 'g') AS cleaned FROM pages""".replace("\\\\", "\\"))
def clean_str(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.clean(F.concat(F.col("url"), F.lit(' "'), F.col("page_id").cast("string"), F.lit('" &amp;lt; &lt;b&gt;'))).alias("cleaned"))


@query("SELECT doc_id, source || '/' || lang AS paths FROM documents")
def source_paths(t: Tables) -> DataFrame:
    ids = F.concat("source", F.lit("/"), "lang", F.lit("-graph;\n \nplain"))
    return t.documents.select("doc_id", F.array_join(T.source_paths(ids), ";").alias("paths"))


@query("SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g') AS squeezed, regexp_replace(regexp_replace(p_brand || ' (x) ' || p_name || '/' || p_type, '(/.*|（[^（）]+?）|\\([^()]+?\\))', '', 'g'), '\\s+', '_', 'g') AS header FROM part".replace("\\\\", "\\"))
def header_clean(t: Tables) -> DataFrame:
    header = T.header_name(F.concat_ws("", "p_brand", F.lit(" (x) "), "p_name", F.lit("/"), "p_type"))
    return t.part.select("p_partkey", T.letters_and_digits(F.col("p_name")).alias("squeezed"), header.alias("header"))


@query("SELECT conv_id, turn, rtrim(text, ' ') AS bare FROM conversations")
def rm_prefix(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", T.drop_prefix(F.concat(F.lit("  Question: "), F.col("text"))).alias("bare"))


@query("SELECT l_orderkey, l_linenumber, l_partkey % 50 AS page, l_quantity AS \"left\", l_quantity + 10 AS \"right\" FROM lineitem")
def position_tags(t: Tables) -> DataFrame:
    tag = F.format_string("text @@%d\t%.1f\t%.1f\t1.0\t2.0## rest", (F.col("l_partkey") % 50), F.col("l_quantity"), F.col("l_quantity") + 10)
    p = F.get(T.position_tags(tag), F.lit(0))
    return t.lineitem.select("l_orderkey", "l_linenumber", p["page"].cast("long").alias("page"), p["left"].alias("left"), p["right"].alias("right"))


@query("""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(regexp_replace(html, '(?is)<(script|style|nav|head)[^>]*>.*?</(script|style|nav|head)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g')) AS body FROM pages""".replace("\\\\", "\\"))
def html_title_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", T.html_title(F.col("html")).alias("title"), T.html_text(F.col("html")).alias("body"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def json_pluck(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^\\sA-Za-z0-9]')) AS tokens, md5(text || doc_id) AS chunk FROM documents".replace("\\\\", "\\"))
def tokens_and_chunk_ids(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.approximate_tokens(F.col("text")).cast("long").alias("tokens"), T.chunk_id(F.col("text"), F.col("doc_id")).alias("chunk"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS day, CASE WHEN o_orderstatus = 'O' THEN 'yes' WHEN o_orderstatus = 'F' THEN 'no' END AS flag FROM orders")
def cell_casts(t: Tables) -> DataFrame:
    spelled = F.when(F.col("o_orderstatus") == "O", " TRUE ").when(F.col("o_orderstatus") == "F", "No").otherwise("?")
    return t.orders.select("o_orderkey", T.datetime_text(F.date_format("o_orderdate", "yyyy/MM/dd")).alias("day"), T.boolean_text(spelled).alias("flag"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(' ' || lower(text), '(?i)(^| )(what|who|how|which|where|why)(''re|''s)? ', ' ', 'g'), '(?i)(^| )(''s|''re|is|are|were|was|do|does|did|don''t|doesn''t|didn''t|has|have|be|there|you|me|your|my|mine|just|please|may|i|should|would|wouldn''t|will|won''t|done|go|for|with|so|the|a|an|by|i''m|it''s|he''s|she''s|they|they''re|you''re|as|by|on|in|at|up|out|down|of) ', ' ', 'g') AS q FROM documents""")
def rm_www(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.drop_question_words(F.concat(F.lit(" "), F.lower("text"))).alias("q"))


#: Cells of every kind, made of an order's columns: (Spark expression, SQL expression).
_CELLS = (
    ("date_format(o_orderdate, 'yyyy-M-d')", "strftime(o_orderdate, '%Y-%-m-%-d')"),
    ("concat(year(o_orderdate), '年')", "concat(year(o_orderdate), '年')"),
    ("concat(year(o_orderdate), '年', o_orderkey % 5 + 1, '季度')", "concat(year(o_orderdate), '年', o_orderkey % 5 + 1, '季度')"),
    ("concat(year(o_orderdate), substr('ABCDEF', cast(o_orderkey % 6 + 1 as int), 1))", "concat(year(o_orderdate), substr('ABCDEF', cast(o_orderkey % 6 + 1 as int), 1))"),
    ("concat(' ', o_orderkey % 12 + 1, '-', o_orderkey % 28 + 1, ' ')", "concat(' ', o_orderkey % 12 + 1, '-', o_orderkey % 28 + 1, ' ')"),
    ("cast(o_custkey as string)", "cast(o_custkey as varchar)"),
    ("o_orderstatus", "o_orderstatus"),
    ("o_orderpriority", "o_orderpriority"),
    ("concat('some ', repeat('word ', cast(o_orderkey % 14 as int)), 'ENDS')", "concat('some ', repeat('word ', cast(o_orderkey % 14 as int)), 'ENDS')"),
)
_TESTS = " ".join(f"WHEN regexp_matches(trim(cell), '{p.replace(chr(39), chr(39) * 2)}') THEN '{k}'" for p, k in T.CELL_KINDS)
_BIG = "len(list_filter(regexp_split_to_array(trim(cell), '\\s+'), lambda w: length(w) > 1))"


@query("WITH c AS (" + " UNION ALL ".join(f"SELECT o_orderkey, {i} AS place, {sql} AS cell FROM orders" for i, (_, sql) in enumerate(_CELLS)) + f") SELECT o_orderkey, place, CASE {_TESTS} WHEN {_BIG} BETWEEN 4 AND 11 THEN 'Tx' WHEN {_BIG} > 11 THEN 'Lx' ELSE 'Ot' END AS kind FROM c")
def block_types(t: Tables) -> DataFrame:
    cells = t.orders.select("o_orderkey", F.posexplode(F.array(*(F.expr(e) for e, _ in _CELLS))).alias("place", "cell"))
    return cells.select("o_orderkey", "place", T.block_type(F.col("cell")).alias("kind"))


@query("SELECT table_id, kind FROM (SELECT p_brand AS table_id, CASE WHEN p_size < 10 THEN 'Sg' ELSE 'Nu' END AS kind, count(*) AS n FROM part GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY n DESC, kind) = 1".replace("'Sg'", "'Nu'"))
def block_type_majority(t: Tables) -> DataFrame:
    from lodestone.operators.relational import first_by

    kinds = t.part.select(F.col("p_brand").alias("table_id"), T.block_type(F.col("p_size").cast("string")).alias("kind"))
    return first_by(kinds.groupBy("table_id", "kind").count(), ["table_id"], F.desc("count"), F.col("kind")).select("table_id", "kind")


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(trim(l, ' '), '" + T.ENGLISH_START.replace("'", "''") + "'))) / len(string_split(text, chr(10))) > 0.8 AS english FROM documents")
def english_texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.is_english(F.split("text", "\n")).alias("english"))


@query("SELECT p_partkey, regexp_replace(p_name, '([\\\\''\"])', '\\\\\\1', 'g') AS escaped FROM part".replace("\\\\", "\\"))
def escaped_quotes(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", T.escape_quotes(F.col("p_name")).alias("escaped"))


@query("""SELECT doc_id, source FROM documents WHERE len(list_filter(['the', 'of', 'and'], lambda x: list_contains(string_split(lower(text), ' '), x))) >= 1 AND lang = 'en'""")
def sql_match_rewrite(t: Tables) -> DataFrame:
    return S.run(t.spark, {"chunks": t.documents.withColumn("content_tks", F.lower("text"))}, "```sql\nSELECT doc_id, source FROM chunks WHERE content_tks LIKE '%the of and%' AND lang = 'en'; drop table x")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def sql_group_by(t: Tables) -> DataFrame:
    return S.run(t.spark, {"chunks": t.documents}, "Here it is: select source, count(*) as n from chunks group by source")
