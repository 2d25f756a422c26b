"""Queries of token analysis, short and Chinese questions, and whole retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators import analysis as A
from lodestone.operators import retrieval as R
from lodestone.plans.catalogue import Tables, lists
from lodestone.plans.retrieval import _COS, QUESTION, vector_of

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)

#: Rows of Chinese text (the tables have none), and questions over them.
ROWS = [
    (1, "犬瘟热的症状是什么？发烧、咳嗽 3.5 天"),
    (2, "猫瘟热 FPV-2 的治疗,用药2次"),
    (3, "狗的发烧 与 咳嗽--治疗方法"),
    (4, "plain english text about dogs"),
    (5, "ＡＢＣ１２３ 犬瘟"),
]
TOKENS = [
    "犬 瘟 热 的 症 状 是 什 么 ? 发 烧 、 咳 嗽 3.5 天",
    "猫 瘟 热 fpv- 2 的 治 疗 , 用 药 2 次",
    "狗 的 发 烧 与 咳 嗽 -- 治 疗 方 法",
    "plain english text about dogs",
    "abc 123 犬 瘟",
]
QUESTION_ZH = "犬瘟热 怎么治疗 fever"


def _rows(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(ROWS, "id long, text string")


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{x}')" for (i, _), x in zip(ROWS, TOKENS)) + ") v(id, tks)")
def cjk_tokens(t: Tables) -> DataFrame:
    return _rows(t).select("id", F.array_join(A.tokens(F.col("text")), " ").alias("tks"))


#: What the question's rules leave: two segments, `犬瘟热` and `治疗 fever`, each character a token; four-character runs are glued.
@query("""WITH r AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, ' {x} ')" for (i, _), x in zip(ROWS, TOKENS)) + """) v(id, s))
 SELECT id, hits FROM (SELECT id, CASE WHEN contains(s, ' 犬 瘟 热 ') THEN 1 ELSE 0 END + CASE WHEN contains(s, ' 治 疗 ') THEN 1 ELSE 0 END + CASE WHEN contains(s, ' fever ') THEN 1 ELSE 0 END AS hits FROM r) WHERE hits > 0""")
def cjk_question(t: Tables) -> DataFrame:
    clauses, _ = A.short_question(QUESTION_ZH)
    scored = _rows(t).withColumn("tks", A.tokens(F.col("text")))
    hits = sum((A.match_clauses(F.col("tks"), [c], 0).isNotNull() & (A.match_clauses(F.col("tks"), [c], 0) > 0)).cast("int") for c in clauses)
    return scored.where(A.match_clauses(F.col("tks"), clauses).isNotNull()).select("id", hits.alias("hits"))


@query("""WITH t AS (SELECT doc_id AS id, ' ' || array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' ') || ' ' AS s FROM documents)
 SELECT id, CASE WHEN contains(s, ' thing the ') THEN 1 ELSE 0 END AS phrase FROM t WHERE contains(s, ' thing ') OR contains(s, ' the ') OR contains(s, ' of ')""")
def short_question(t: Tables) -> DataFrame:
    """A question of three words goes the short way: any of its words matches; Latin neighbours make one phrase."""
    clauses = [A.Clause(w, [(w, 1.0)]) for w in ("thing", "the", "of")]
    phrase = [A.Clause("thing the", [("thing the", 1.0)])]

    def scored(tks):
        found = F.coalesce(A.match_clauses(tks, phrase), F.lit(0.0)) > 0
        return F.struct(A.match_clauses(tks, clauses, 0.34).alias("score"), found.cast("int").alias("phrase"))

    # Out of a generator: a condition on a column would be pushed below it, and cut the text again for each of its terms.
    each = F.transform(F.array(A.tokens(F.col("text"))), scored)
    found = t.documents.select(F.col("doc_id").alias("id"), F.explode(F.filter(each, lambda x: x["score"] > 0)).alias("x"))
    return found.select("id", "x.phrase")


@query("SELECT event_id, event_type || CASE WHEN user_id > 9 THEN ' ' || user_id ELSE '' END AS kept FROM events")
def pretoken_rules(t: Tables) -> DataFrame:
    """Marks, stop words and single digits go; the rules run as a function of each distinct line."""
    lines = t.events.select("event_type", "user_id").distinct()
    rule = F.pandas_udf(lambda s: s.map(lambda x: " ".join(A.pretoken(x, stop_words=frozenset({"the"})))), "string")
    done = lines.withColumn("kept", rule(F.concat_ws("; the ", "event_type", F.col("user_id").cast("string"))))
    return t.events.join(done, ["event_type", "user_id"]).select("event_id", "kept")


@query("""WITH d AS (SELECT DISTINCT lower(n_name) AS word, n_nationkey + 1.0 AS freq FROM nation), t AS (SELECT c_custkey, lower(n_name) AS token FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT c_custkey, 'nowhere' FROM customer)
 SELECT c_custkey, token, coalesce(freq, 0) AS freq, CASE WHEN freq IS NULL THEN '' ELSE 'ns' END AS tag FROM t LEFT JOIN d ON token = word""")
def dictionary_tags(t: Tables) -> DataFrame:
    lines = t.nation.select(F.concat_ws("\t", "n_name", (F.col("n_nationkey") + 1).cast("string"), F.lit("ns")).alias("value"))
    names = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.lower("n_name").alias("token"))
    return A.tagged(names.unionByName(t.customer.select("c_custkey", F.lit("nowhere").alias("token"))), "token", A.dictionary_of(lines)).select("c_custkey", "token", "freq", "tag")


@query("SELECT page_id, len(regexp_extract_all(lower(url), '[a-z0-9]+')) AS n FROM pages")
def fine_grained(t: Tables) -> DataFrame:
    # Without Chinese, tokens are split at slashes.
    tks = F.array(F.array_join(R.tokens(F.col("url")), "/"))
    return t.pages.select("page_id", F.size(A.fine_tokens(tks)).cast("long").alias("n"))


_W = R.weights(QUESTION)
_TKS = "t AS (SELECT d.doc_id AS id, d.source AS doc, regexp_extract_all(lower(d.text), '[a-z0-9]+') AS tks, e.embedding FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id), s AS (SELECT count(*) AS n, avg(len(tks)) AS avgdl, " + ", ".join(f"sum(CASE WHEN list_contains(tks, '{x}') THEN 1 ELSE 0 END) AS df{i}" for i, x in enumerate(_W)) + " FROM t)"
_TF = lambda x: f"len(list_filter(tks, lambda z: z = '{x}'))"
_TEXT = " + ".join(f"{w!r} * ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * 2.2 * {_TF(x)} / ({_TF(x)} + 1.2 * (0.25 + 0.75 * len(tks) / avgdl))" for i, (x, w) in enumerate(_W.items()))
_ENGINE = f"""WITH {_TKS}, m AS (SELECT id, doc, tks, {_TEXT} AS tscore, {_COS.replace('e.embedding', 't.embedding')} AS vsim FROM t, s, (SELECT embedding FROM embeddings WHERE vec_id = 7) q WHERE {' OR '.join(f"list_contains(tks, '{x}')" for x in _W)}),
 k AS (SELECT id FROM m WHERE vsim >= 0.2 ORDER BY vsim DESC, id LIMIT 1024), g AS (SELECT m.*, 0.05 * tscore + CASE WHEN k.id IS NULL THEN 0 ELSE vsim END AS score FROM m LEFT JOIN k ON m.id = k.id)"""
_SHARED = " + ".join(f"CASE WHEN list_contains(tks, '{x}') THEN {w!r} ELSE 0 END" for x, w in _W.items())
_TSIM = f"(1e-9 + {_SHARED}) / {sum(_W.values()) + 1e-9!r} / greatest(1.0, sqrt(log10(greatest(len(list_distinct(tks)), {len(_W)}))))"


def _chunks(t: Tables) -> DataFrame:
    joined = t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id"))
    return joined.select(F.col("doc_id").alias("id"), F.col("source").alias("doc"), R.tokens(F.col("text")).alias("tks"), "embedding")


@query(_ENGINE + " SELECT id, round(score, 5) AS score FROM g")
def engine_score(t: Tables) -> DataFrame:
    found = A.engine_score(_chunks(t), QUESTION, vector_of(t, 7), "embedding", least=0.2)
    return found.select("id", F.round("score", 5).alias("score"))


_RERANKED = _ENGINE + f", c AS (SELECT * FROM g ORDER BY score DESC, id LIMIT 90), r AS (SELECT id, doc, {_TSIM} AS tsim, vsim FROM c), f AS (SELECT *, tsim * 0.7 + vsim * 0.3 AS sim FROM r), p AS (SELECT *, row_number() OVER (ORDER BY sim DESC, id) AS rank FROM f), o AS (SELECT * FROM p WHERE rank <= 30 AND sim >= 0.2)"


@query(_RERANKED + " SELECT id, rank, round(sim, 5) AS sim, round(tsim, 5) AS tsim, round(vsim, 5) AS vsim FROM o")
def hybrid_retrieval(t: Tables) -> DataFrame:
    found, _, _ = A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding")
    return found.select("id", "rank", *(F.round(c, 5).alias(c) for c in ("sim", "tsim", "vsim")))


@query(_RERANKED.replace("rank <= 30 AND sim >= 0.2", "rank > 30 AND rank <= 60 AND sim >= 0.2") + " SELECT id, rank, round(sim, 5) AS sim FROM o")
def rerank_page2(t: Tables) -> DataFrame:
    return A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding", page=2)[0].select("id", "rank", F.round("sim", 5).alias("sim"))


@query(_RERANKED + " SELECT doc, count(*) AS count FROM o GROUP BY doc")
def retrieval_facets(t: Tables) -> DataFrame:
    return A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding")[1]


@query(_ENGINE + ", p AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM g) SELECT id, rank, 1.0 AS sim FROM p WHERE rank > 120 AND rank <= 150")
def retrieval_page5(t: Tables) -> DataFrame:
    """Beyond three pages the engine's order stands."""
    return A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding", page=5)[0].select("id", "rank", "sim")


@query(_ENGINE + " SELECT count(*) AS total FROM g")
def retrieval_total(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding")[2],)], "total long")


@query(_ENGINE + f", c AS (SELECT * FROM g ORDER BY score DESC, id LIMIT 90), r AS (SELECT id, {_TSIM} AS tsim, 1.0 / (1 + len(tks)) AS vsim FROM c), f AS (SELECT *, tsim * 0.7 + vsim * 0.3 AS sim FROM r), p AS (SELECT *, row_number() OVER (ORDER BY sim DESC, id) AS rank FROM f) SELECT id, rank, round(sim, 5) AS sim FROM p WHERE rank <= 30 AND sim >= 0.2")
def rerank_by_model(t: Tables) -> DataFrame:
    """The model's seam with a toy model: shorter texts are better."""
    toy = lambda question, text: 1 / (1 + F.size(F.split(text, " ")))
    return A.retrieve(_chunks(t), QUESTION, vector_of(t, 7), "embedding", model=toy)[0].select("id", "rank", F.round("sim", 5).alias("sim"))
