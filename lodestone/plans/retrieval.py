"""Retrieval queries: chunks are the documents, their vectors the embeddings of the same id."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import retrieval as R
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)

QUESTION = "the attion of thanedble eriner"
_W = R.weights(QUESTION)
_TERMS = [*_W]


def _sql_list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


_TKS = "WITH t AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS tks FROM documents), s AS (SELECT count(*) AS n, avg(len(tks)) AS avgdl, " + ", ".join(f"sum(CASE WHEN list_contains(tks, '{t}') THEN 1 ELSE 0 END) AS df{i}" for i, t in enumerate(_TERMS)) + " FROM t)"
_SHARED = " + ".join(f"CASE WHEN list_contains(tks, '{t}') THEN {w!r} ELSE 0 END" for t, w in _W.items())
_TSIM = f"(1e-9 + {_SHARED}) / {sum(_W.values()) + 1e-9!r} / greatest(1.0, sqrt(log10(greatest(len(list_distinct(tks)), {len(_W)}))))"
_DOT = lambda a, b: f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
_COS = f"{_DOT('e.embedding', 'q.embedding')} / sqrt({_DOT('e.embedding', 'e.embedding')} * {_DOT('q.embedding', 'q.embedding')})"


def chunks(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), "text", R.tokens(F.col("text")).alias("tks"))


def vector_of(t: Tables, vec_id: int) -> list[float]:
    row = t.embeddings.where(F.col("vec_id") == vec_id).select("embedding").first()
    return list(row[0]) if row else []


@query(_TKS + f" SELECT id, round({_TSIM}, 6) AS sim FROM t ORDER BY sim DESC, id LIMIT 50")
def token_similarity_topk(t: Tables) -> DataFrame:
    return chunks(t).select("id", F.round(R.token_similarity(QUESTION, F.col("tks")), 6).alias("sim")).orderBy(F.desc("sim"), "id").limit(50)


@query(_TKS + " SELECT id, round(" + " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * 2.2 * len(list_filter(tks, lambda x: x = '{t}')) / (len(list_filter(tks, lambda x: x = '{t}')) + 1.2 * (0.25 + 0.75 * len(tks) / avgdl))" for i, t in enumerate(_TERMS)) + ", 5) AS score FROM t, s ORDER BY score DESC, id LIMIT 50")
def bm25_topk(t: Tables) -> DataFrame:
    c = chunks(t)
    stats = R.statistics(c, "tks", _TERMS)
    return c.select("id", F.round(R.bm25(F.col("tks"), _TERMS, stats), 5).alias("score")).orderBy(F.desc("score"), "id").limit(50)


@query(_TKS + " SELECT id, round(" + " + ".join(f"CASE WHEN list_contains(tks, '{t}') THEN ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) / ln(1 + (n - 0.5) / 1.5) ELSE 0 END" for i, t in enumerate(_TERMS)) + ", 6) AS score FROM t, s ORDER BY score DESC, id LIMIT 50")
def scripted_sim_topk(t: Tables) -> DataFrame:
    c = chunks(t)
    stats = R.statistics(c, "tks", _TERMS)
    return c.select("id", F.round(R.scripted_similarity(F.col("tks"), _TERMS, stats), 6).alias("score")).orderBy(F.desc("score"), "id").limit(50)


@query("""WITH t AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS tks, regexp_extract_all(lower(source || ' ' || lang), '[a-z0-9]+') AS title FROM documents),
 s AS (SELECT count(*) AS n, sum(CASE WHEN list_contains(tks, 'en') THEN 1 ELSE 0 END) AS a, sum(CASE WHEN list_contains(title, 'en') THEN 1 ELSE 0 END) AS b FROM t)
 SELECT id, round(greatest(2.0 * CASE WHEN list_contains(tks, 'en') THEN ln(1 + (n - a + 0.5) / (a + 0.5)) / ln(1 + (n - 0.5) / 1.5) ELSE 0 END,
 10.0 * CASE WHEN list_contains(title, 'en') THEN ln(1 + (n - b + 0.5) / (b + 0.5)) / ln(1 + (n - 0.5) / 1.5) ELSE 0 END) * 0.05, 6) AS score FROM t, s""")
def dis_max_fields(t: Tables) -> DataFrame:
    c = t.documents.select(F.col("doc_id").alias("id"), R.tokens(F.col("text")).alias("tks"), R.tokens(F.concat_ws(" ", "source", "lang")).alias("title"))
    score = lambda f: R.scripted_similarity(F.col(f), ["en"], R.statistics(c, f, ["en"]))
    return c.select("id", F.round(R.best_field({"content_ltks": score("tks"), "title_tks": score("title")}), 6).alias("score"))


@query("WITH t AS (SELECT doc_id AS id, ' ' || array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') || ' ' AS s FROM documents) SELECT id, round(" + " + ".join(f"CASE WHEN contains(s, ' {p} ') THEN {w!r} ELSE 0 END" for p, w in R.phrase_terms(QUESTION)) + ", 6) AS score FROM t")
def phrase_bigrams(t: Tables) -> DataFrame:
    joined = F.concat(F.lit(" "), F.array_join("tks", " "), F.lit(" "))
    score = sum((F.when(joined.contains(f" {p} "), w).otherwise(0.0) for p, w in R.phrase_terms(QUESTION)), F.lit(0.0))
    return chunks(t).select("id", F.round(score, 6).alias("score"))


@query("SELECT term, count(DISTINCT id) AS df, count(*) AS tf FROM (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY term")
def tokens_df_idf(t: Tables) -> DataFrame:
    # A row's tokens are sorted: each term's first one counts its document.  Both counts take one exchange, of partial sums.
    ordered = chunks(t).select(F.array_sort("tks").alias("tks"))
    marked = F.transform("tks", lambda x, i: F.struct(x.alias("term"), ((i == 0) | (F.get(F.col("tks"), i - 1) != x)).cast("long").alias("new")))
    return ordered.select(F.inline(marked)).groupBy("term").agg(F.sum("new").alias("df"), F.count("*").alias("tf"))


@query("SELECT t AS term, round(w, 6) AS weight FROM (VALUES " + ", ".join(f"('{t}', {w!r})" for t, w in _W.items()) + ") v(t, w)")
def term_weights(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([*_W.items()], "term string, weight double").select("term", F.round("weight", 6).alias("weight"))


@query(f"SELECT e.vec_id AS id, round({_COS}, 5) AS sim FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q WHERE {_COS} >= 0.1 ORDER BY {_COS} DESC, id LIMIT 25")
def knn_topk(t: Tables) -> DataFrame:
    found = R.knn(t.embeddings.withColumnRenamed("vec_id", "id"), vector_of(t, 7), "embedding", k=25)
    return found.select("id", F.round("vsim", 5).alias("sim"))


@query("SELECT doc_id AS id, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '[\\r\\n]', ' ', 'g'), '[.?!;\\n]'), lambda s: regexp_replace(regexp_replace(s, '(?i)(^|[ .?/''\"\\(\\)!,:;-])(thing)([ .?/''\"\\(\\)!,:;-])', '\\1<em>\\2</em>\\3', 'g'), '(?i)(^|[ .?/''\"\\(\\)!,:;-])(the)([ .?/''\"\\(\\)!,:;-])', '\\1<em>\\2</em>\\3', 'g')), lambda s: regexp_matches(s, '<em>[^<>]+</em>')), '...') AS marked FROM documents WHERE lang = 'en'".replace("\\\\", "\\"))
def highlight_sentences(t: Tables) -> DataFrame:
    return t.documents.where("lang = 'en'").select(F.col("doc_id").alias("id"), R.highlight(F.col("text"), ["thing", "the"]).alias("marked"))


@query("SELECT source AS kb, doc_id, used FROM (SELECT source, doc_id, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS used FROM documents) WHERE used <= 20000")
def context_pack_budget(t: Tables) -> DataFrame:
    c = t.documents.select(F.col("source").alias("kb"), "doc_id", "n_chars")
    return R.pack_context(c, "n_chars", [F.col("doc_id")], 20_000).select("kb", "doc_id", "used")


@query(f"""WITH q AS (SELECT vec_id AS q, embedding, label FROM embeddings WHERE vec_id % 100 = 0), run AS (SELECT q.q, e.vec_id AS doc, {_COS} AS score FROM q JOIN embeddings e ON e.vec_id <> q.q),
 rel AS (SELECT q.q, e.vec_id AS doc, 1 AS rel FROM q JOIN embeddings e ON e.label = q.label AND e.vec_id <> q.q),
 j AS (SELECT run.q, run.doc, coalesce(rel, 0) AS rel, row_number() OVER (PARTITION BY run.q ORDER BY score DESC, run.doc) AS r FROM run LEFT JOIN rel ON run.q = rel.q AND run.doc = rel.doc),
 h AS (SELECT *, sum(rel) OVER (PARTITION BY q ORDER BY r) AS hits FROM j), n AS (SELECT q, count(*) AS relevant FROM rel GROUP BY q),
 i AS (SELECT q, relevant, list_sum(list_transform(generate_series(1, least(relevant, 10)), lambda x: 1 / log2(x + 1))) AS idcg FROM n),
 o AS (SELECT q, sum(CASE WHEN r <= 10 THEN rel / log2(r + 1) ELSE 0 END) AS dcg, sum(CASE WHEN r <= 5 AND rel > 0 THEN hits / r ELSE 0 END) AS ap, coalesce(max(CASE WHEN rel > 0 THEN 1 / r END), 0) AS mrr FROM h GROUP BY q)
 SELECT o.q, round(dcg / idcg, 5) AS ndcg, round(ap / least(relevant, 5), 5) AS "map", round(mrr, 5) AS mrr FROM o JOIN i ON o.q = i.q""")
def ndcg_map_mrr(t: Tables) -> DataFrame:
    # The query set is every vector whose id is divisible by 100, against all vectors.
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vec"))
    m = R.vector_metrics(rows, rows.where("id % 100 = 0"))
    return m.select("q", *(F.round(c, 5).alias(c) for c in ("ndcg", "map", "mrr")))


@query("""SELECT a.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: 0.1 * z[1]::DOUBLE + 0.9 * z[2]::DOUBLE)), 4) AS total
 FROM embeddings a JOIN embeddings b ON a.vec_id = b.vec_id + 1""")
def embedding_blend(t: Tables) -> DataFrame:
    b = t.embeddings.select((F.col("vec_id") + 1).alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("content"))
    both = t.embeddings.join(b, "vec_id")
    out = R.blend(F.transform("embedding", lambda x: x.cast("double")), F.col("content"))
    return both.select("vec_id", F.round(F.aggregate(out, F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(f"""WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS tks, embedding FROM documents JOIN embeddings ON doc_id = vec_id),
 s AS (SELECT p.doc_id AS piece, c.doc_id AS chunk, 0.1 * ((len(list_intersect(p.tks, c.tks)) + 1e-9) / (len(p.tks) + 1e-9) / greatest(1.0, sqrt(log10(greatest(len(p.tks), len(c.tks)))))) + 0.9 * ({_COS.replace('e.', 'p.').replace('q.', 'c.')}) AS sim
 FROM d p JOIN d c ON p.doc_id % 100 = 0 AND c.doc_id <> p.doc_id), r AS (SELECT *, max(sim) OVER (PARTITION BY piece) AS best, row_number() OVER (PARTITION BY piece ORDER BY sim DESC, chunk) AS rank FROM s),
 k AS (SELECT * FROM r WHERE sim > 0.99 * best AND rank <= 4), m AS (SELECT max(0.99 * best) AS top FROM k),
 u AS (SELECT max(x) AS least FROM (SELECT unnest([0.63, 0.504, 0.4032, 0.32256, 0.258048]) AS x), m WHERE top >= x - 1e-12)
 SELECT min(piece) AS piece, chunk FROM k, u WHERE 0.99 * best >= least GROUP BY chunk""")
def citations_assign(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", R.tokens(F.col("text")).alias("tks")).join(t.embeddings, F.col("doc_id") == F.col("vec_id"))
    pieces = d.where("doc_id % 100 = 0").select(F.col("doc_id").alias("piece"), F.array_distinct("tks").alias("ptks"), F.col("embedding").alias("pvec"))
    found = d.select(F.col("doc_id").alias("chunk"), F.array_distinct("tks").alias("ctks"), F.col("embedding").alias("cvec"))
    return R.citations(pieces, found, others=True).select("piece", "chunk")


assert math.isclose(sum(_W.values()), 1.0)
