"""The pipeline's stages, one after another, against brute force on the smallest documents."""

import re

import corpus_pipeline
import pytest

from lodestone.llm import language_id, line_templates, packing, secret_scan
from lodestone.llm.registry import split_pattern, vocabulary

from .test_operators import classes_by_hand, templates_by_hand


@pytest.fixture(scope="module")
def results(spark, sf):
    """Each stage's input and output as pandas frames."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    junk = spark.createDataFrame([(10_000, "1234 !!", "en", "src0", 7), (10_001, None, None, None, 0)], docs.schema)
    docs = docs.unionByName(junk)
    for name, stage in corpus_pipeline.STAGES:
        given = docs.toPandas()
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas(), stage(spark, docs.limit(0), sf).schema)
        out[name] = given, docs.toPandas()
    return out


def texts(frame):
    return dict(zip(frame.doc_id, frame.text))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "secret_scan", "packing"]


def test_language_stage(results):
    given, kept = results["language_id"]
    gone = set(given.doc_id) - set(kept.doc_id)
    assert {10_000, 10_001} <= gone and len(gone) < 0.02 * len(given) + 2
    assert texts(kept).items() <= texts(given).items()


def test_line_stage(results):
    given, kept = results["line_dedup"]
    drop = templates_by_hand(list(texts(given).items()), line_templates.MIN_DOCS)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop.get(i, ())) for i, t in texts(given).items()}
    want = {i: t for i, t in want.items() if t.strip(" ") or i not in drop}
    assert texts(kept) == want and (kept.n_chars == kept.text.str.len()).all()


def test_near_stage(results):
    given, kept = results["near_dedup"]
    classes = classes_by_hand(texts(given).items(), 5, 80)
    assert set(kept.doc_id) == {i for i, (_, c) in classes.items() if i == c}
    assert texts(kept).items() <= texts(given).items()


def test_secret_stage(results):
    given, kept = results["secret_scan"]
    scan = secret_scan.scanner(open(vocabulary("byte_bpe_50k.tiktoken")).read(), split_pattern())
    for i, text in texts(given).items():
        out, at = "", 0
        for a, _, b in scan(text):
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        assert texts(kept)[i] == out + text[at:]
    assert set(kept.doc_id) == set(given.doc_id)


def test_packing_stage(results):
    given, pieces = results["packing"]
    source = dict(zip(given.doc_id, given.source))
    tokens = {i: re.findall(r"[^ \t\n\x0b\f\r]+", t) for i, t in texts(given).items()}
    for i, mine in pieces.sort_values("piece").groupby("doc_id"):
        assert [w for t in mine.text for w in re.findall(r"[^ \t\n\x0b\f\r]+", t)] == tokens[i]
    assert set(pieces.doc_id) == {i for i, w in tokens.items() if w}
    for _, b in pieces.groupby(["shard", "bin"]):
        assert b.n_tokens.sum() <= packing.CAPACITY and b.doc_id.map(source).is_unique


def test_run(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert found.count() > 0 and {"doc_id", "bin", "text"} <= set(found.columns)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_python_workers(spark, sf):
    """A task of the packing stage holds one Python worker before its shuffle, and the language model's bounds none."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert plan(packing.pack(docs, with_text=True)).count("ArrowEvalPython") == 1
    text = docs.text
    both = docs.select("doc_id", packing.counted_and_named(text).alias("b")).select("doc_id", "b.*")
    want = docs.select("doc_id", packing.token_count(text).alias("n"), packing.text_cluster(text).alias("cluster"))
    assert sorted(both.collect(), key=str) == sorted(want.collect(), key=str)
    counts = spark.createDataFrame([("en", 3, f"w{i}", i) for i in range(1, 60)] + [(None, 3, "x", 5)], "lang string, size int, gram string, n long").coalesce(1)
    kept = language_id._frequent(counts, ["lang", "size"], 20)
    assert plan(kept).count("ExistingRDD") == plan(counts).count("ExistingRDD") and {r.n for r in kept.collect()} == set(range(42, 60))
