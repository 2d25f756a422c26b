"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lodestone.llm import language_id, license_scan, line_templates, media_columns, minhash_join, packing, quality_rules, secret_scan, winnowing, word_bpe
from lodestone.llm.registry import split_pattern, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "spans string, score double, language string, dropped int, keys int, node int, block int, part int, word string, run int, fp int, n int"
LONG = "The quick brown fox jumps over it. " * 8_000
ROWS = [
    (1, "Hello there, this is a plain text of some words.", "en", "a", 48),
    (1, "Hello there, this is a plain text of some words.", "en", "a", 48),
    (2, "Hello there, this is a plain text of some words.", None, None, None),
    (None, "a row without an id", "en", "a", 19),
    (None, None, None, None, None),
    (3, None, "en", "b", 0),
    (4, "", "en", "b", 0),
    (5, " \n\t\n ", "de", "b", 5),
    (6, LONG, "en", "c", len(LONG)),
    (7, "1234 5678", "de", None, 9),
    (8, "naïve café 日本語 😀 \x00 end", "fr", "c", 24),
]
ORIGINAL = SCHEMA.replace(" ", ":").replace(",:", ",").split(",")


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return plain.selectExpr("*", *(f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in CLASH.split(", ")))


def operators(spark, docs):
    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), split_pattern()
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    return {
        "quality": lambda: quality_rules.score(docs, quality_rules.fit(docs, labels), into="q"),
        "lines": lambda: line_templates.dedup_lines(docs, into="gone"),
        "packing": lambda: packing.pack(docs),
        "winnowing": lambda: winnowing.edited(docs),
        "secrets": lambda: secret_scan.secret_spans(docs, ranks, pattern, into="found"),
        "licences": lambda: license_scan.labels(docs),
        "language": lambda: language_id.identify(docs, language_id.fit(docs), into="l"),
        "minhash": lambda: minhash_join.near_duplicates(docs),
        "bpe": lambda: word_bpe.word_bpe(docs, vocabulary("word_bpe_49k.json")),
        "media": lambda: media_columns.round_trip(docs),
    }


NAMES = ["quality", "lines", "packing", "winnowing", "secrets", "licences", "language", "minhash", "bpe", "media"]


def documented(name, rows):
    """What each operator's docstring says of null, empty, tied and repeated rows."""
    of = lambda i: [r for r in rows if r.doc_id == i]
    empty, same = [*of(3), *of(4)], [*of(1), *of(2)]
    if name == "quality":
        assert {round(r.q, 6) for r in rows} == {0.999}  # one class only
    elif name == "lines":
        assert {(r.doc_id, r.text) for r in rows} == {(i, t) for i, t, *_ in ROWS} and all(r.gone is None for r in rows)
    elif name == "packing":
        n = {}
        for r in rows:
            n[r.doc_id] = n.get(r.doc_id, 0) + r.n_tokens
        assert n == {1: 20, 2: 10, None: 5, 6: 56_000, 7: 2, 8: 6}
        bins = [(r.shard, r.bin) for r in same]
        assert len(set(bins)) == 3  # one source, or one cluster
    elif name == "winnowing":
        assert {(r.n_chars, r.fingerprint) for r in empty} == {(0, empty[0].fingerprint)} and len({r.fingerprint for r in same}) == 1
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
        assert of(3)[0].near_next == 1.0 and of(3)[0].near_edited == 1.0  # two empty texts
        assert sorted(r.near_next for r in of(1))[-1] == 1.0
    elif name == "secrets":
        assert all(r.found == [] for r in rows)
    elif name == "licences":
        assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (0, 0, None, None, "", "", 0.0) for r in [*empty, *of(5)])
        assert {r.n_words for r in same} == {10} and of(6)[0].n_words == 56_000
    elif name == "language":
        assert all((r.l.lang_pred, r.l.score) == ("und", 0.0) for r in [*empty, *of(5), *of(7)])
        assert len({(r.l.lang_pred, r.l.score) for r in same}) == 1 and all(r.l.lang_pred in ("de", "en", "fr") and 0 < r.l.score <= 1 for r in same)
    elif name == "minhash":
        got = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows], key=str)
        want = [(1, 6, 1, True), (1, 6, 1, True), (2, 6, 1, False), (None, 1, None, True), (None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 7, 6, True), (7, 1, 7, True), (8, 2, 8, True)]
        assert got == sorted(want, key=str)
    elif name == "bpe":
        assert all((bytes(r.ids), r.decoded) == (b"", "") for r in [*empty, *of(5)]) and len({bytes(r.ids) for r in same}) == 1
    else:
        assert {(r.n_bytes, r.payload_bytes, r.payload_sha256) for r in empty} == {(0, 64, hashlib.sha256(bytes(64)).hexdigest())}
        assert len({(r.media_sha256, r.feature) for r in same}) == 1 and of(6)[0].n_bytes == len(LONG)


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(spark, docs, name):
    rows = operators(spark, docs)[name]().collect()
    assert name == "packing" or len(rows) == len(ROWS)
    documented(name, rows)


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, docs, name):
    assert operators(spark, docs.limit(0))[name]().collect() == []


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, docs, k, sf):
    name, stage = corpus_pipeline.STAGES[k]
    found = stage(spark, docs, sf)
    last = k == len(corpus_pipeline.STAGES) - 1
    assert last or found.columns == docs.columns
    rows = found.collect()
    ids = {r.doc_id for r in rows}
    assert {1, 6, 8} <= ids
    if name == "near_dedup":
        assert 2 not in ids and sum(r.doc_id == 1 for r in rows) == 1
    if name == "language_id":
        assert not ids & {3, 4, 5, 7}
    assert stage(spark, docs.limit(0), sf).collect() == []
