"""Queries on rows that the small tables lack but larger ones have, against their SQL."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestone import registry
from tests.test_queries import rows


def against_sql(spark, folder, name, **tables):
    """A query's rows on hand-made tables, held against its SQL's; gives them."""
    con = duckdb.connect()
    for table, frame in tables.items():
        frame.to_parquet(f"{folder}/{table}.parquet", index=False)
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    got = rows(registry.queries()[name](spark, str(folder)).toPandas())
    assert got == rows(con.execute(registry.oracle_sql()[name]).df())
    return got[1]


def test_boxes_and_layouts_with_part_keys_beyond_a_million(spark, tmp_path):
    lines = [(1, 3, 1_000_004, 10.0), (1, 2, 7, 12.0), (1, 4, 9, 14.0), (1, 1, 2_500_000, 11.0), (2, 3, 1_199_999, 3.0), (2, 1, 5, 4.0)]
    frame = pd.DataFrame(lines, columns=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]).astype({"l_linenumber": "int32"})
    assert len(against_sql(spark, tmp_path, "box_layout_join", lineitem=frame.assign(l_discount=0.05, l_tax=0.01))) == 3


def test_chunks_of_empty_texts_and_vertical_tabs(spark, tmp_path):
    tabs = "a\x0b" * 65 + ".b.c"
    frame = pd.DataFrame([(1, ""), (2, "one. two"), (3, None), (4, tabs), (5, "\n")], columns=["doc_id", "text"])
    for name in ("chunk_parser_txt", "chunk_naive_merge"):
        against_sql(spark, tmp_path, name, documents=frame)


def test_records_of_answers(spark):
    from lodestone.operators import graph as G

    text = '("entity"<|>a<|>b<|>c)## ##("entity"<|>x<|>x<|>d)##("relationship"<|>b<|>a<|>r<|>2)<|COMPLETE|>'
    rows = G.records(spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string"), "k", "t")
    assert [tuple(r) for r in G.nodes_of(rows, "k").collect()] == [("A", "B", "c", "1")]
    assert [tuple(r) for r in G.edges_of(rows, "k").collect()] == [("A", "B", "r", "1")]
    # One split of records and one of fields, however many fields are asked for.
    plan = G.nodes_of(rows, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2


def test_question_words_of_a_trie(spark):
    from lodestone.functions import text as T

    texts = ["who's the so-called THE  the a", " is are", "是不是什么样的 x", "what is it's for", "'s a", "", None, "doesn't don't wouldn't well", "theme they're they'd"]
    frame = spark.createDataFrame([(x,) for x in texts], "t string")
    plain = F.col("t")
    for pattern, by in ((T.INTERROGATIVES, ""), (T.QUESTION_WORDS, " "), (T.FILLERS, " ")):
        plain = F.regexp_replace(plain, "(?i)" + pattern, by)
    got = frame.select(T.drop_question_words(F.col("t")).alias("a"), plain.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    # No alternation of whole words, which is tried from its start at every blank.
    assert "|doesn't|" not in frame.select(T.drop_question_words(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_short_question_cuts_a_text_once(spark, tmp_path):
    frame = pd.DataFrame([(1, "The thing, the end"), (2, "nothing"), (3, None), (4, "of"), (5, "")], columns=["doc_id", "text"])
    assert against_sql(spark, tmp_path, "short_question", documents=frame) == [("1", "1"), ("4", "0")]
    plan = registry.queries()["short_question"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # Chinese or Latin


def test_engine_score_cuts_a_text_once_a_pass(spark):
    from lodestone.operators import analysis as A
    from lodestone.operators import retrieval as R

    texts = spark.createDataFrame([(1, "d", "red fox", [1.0, 0.0]), (2, "d", "dog", [1.0, 0.0]), (3, "e", "a fox", [0.0, 1.0])], "id long, doc string, text string, v array<double>")
    chunks = texts.select("id", "doc", R.tokens(F.col("text")).alias("tks"), "v")
    found, _, total = A.retrieve(chunks, "red fox", [1.0, 0.0], "v")
    assert total == 2 and [r.id for r in found.orderBy("rank").collect()] == [1, 3]
    assert A.retrieve(chunks, "cat", [1.0, 0.0], "v")[2] == 0
    plan = A.engine_score(chunks, "red fox", [1.0, 0.0], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # the nearest ones, and the scores


def test_vector_metrics_are_those_of_all_pairs(spark, monkeypatch):
    import numpy as np

    from lodestone.operators import retrieval as R

    monkeypatch.setattr(R.Nearest, "TILE", 16)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 4)).round(1).repeat(2, axis=0)  # each twice: ties go by id
    labels = [99 if i == 0 else None if i == 10 else i % 40 for i in range(120)]  # few relevant ones, far down
    rows = spark.createDataFrame([(i, labels[i], [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, label int, vec array<float>")
    queries = rows.where("id % 10 = 0")
    q = queries.select(F.col("id").alias("q"), F.col("vec").alias("qv"), F.col("label").alias("ql"))
    run = rows.crossJoin(q).where("id <> q").select("q", F.col("id").alias("doc"), R.cosine(F.col("vec"), F.col("qv")).alias("score"))
    rel = rows.crossJoin(q).where("id <> q and label = ql").select("q", F.col("id").alias("doc"), F.lit(1).alias("rel"))
    want, got = R.ranking_metrics(rel, run).orderBy("q").toPandas(), R.vector_metrics(rows, queries).orderBy("q").toPandas()
    assert len(want) == 10 and (want.mrr < 0.1).any() and (got.round(9).to_numpy() == want.round(9).to_numpy()).all()


def test_citations_are_those_of_all_pairs(spark, tmp_path, monkeypatch):
    import numpy as np

    from lodestone.operators import retrieval as R

    monkeypatch.setattr(R.Nearest, "TILE", 32)
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(30)])
    texts = ["", *(" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(199))]
    vectors = (rng.normal(size=(100, 8)).repeat(2, axis=0) + 2).astype("float32")  # each twice
    documents = pd.DataFrame({"doc_id": range(0, 2000, 10), "text": texts})
    embeddings = pd.DataFrame({"vec_id": range(0, 2000, 10), "embedding": [*vectors], "label": 1})
    assert against_sql(spark, tmp_path, "citations_assign", documents=documents, embeddings=embeddings)
    # No row a pair is left in the plan.
    assert "NestedLoop" not in registry.queries()["citations_assign"](spark, str(tmp_path))._jdf.queryExecution().toString()
