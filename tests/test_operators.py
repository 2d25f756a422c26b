"""Operators and functions on small rows with known results."""

import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as T, udfs
from lodestone.operators import chat, chunking as C, dml, flow, graph as G, relational as R, retrieval, sql_surface as S
from lodestone.sources import readers


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "f, text, want",
    [
        (T.half_width, "ＡＢ　１（", "AB 1("),
        (T.squeeze_blanks, "你 abc def 你", "你abc def你"),
        (T.escape_query, 'a:b (c)* "', 'a\\:b \\(c\\)\\* \\"'),
        (T.is_cjk_query, "one two", True),
        (T.is_cjk_query, "these are plain latin words", False),
        (T.letters_and_digits, "a-1 é b", "a1b"),
        (T.source_paths, "a/b-graph;c-1\n\nplain", ["a/b", "c"]),
        (T.approximate_tokens, "ab, c1 你好", 5),
        (T.remove_blocked, "xtaiwany台湾", "xy"),
        (T.header_name, "size/length (a,b) x", "size"),
        (T.drop_prefix, "Q: what", "what"),
        (T.heading_level, "### x", 3),
        (T.is_no_bullet, "0.5", True),
        (T.remove_position_tags, "a@@1\t2.0\t3.0\t4.0\t5.0##b", "ab"),
        (T.floats, "1\t2.5", [1.0, 2.5]),
        (T.datetime_text, "2020/01/02", "2020-01-02 00:00:00"),
        (T.boolean_text, " Yes", "yes"),
        (T.outer_json, "say {\"a\":\n\"it\\'s\"} ok", '{"a": "it\'s"}'),
        (T.edge_grams, "abcd", ["ab", "abc", "abcd"]),
        (T.block_type, "2020-01-02", "Dt"),
        (T.block_type, "3.5%", "Nu"),
        (T.html_text, "<head>x</head><p>a &amp;amp; b</p><script>y</script>", "a & b"),
    ],
)
def test_text(spark, f, text, want):
    assert one(spark, text, f) == want


@pytest.mark.parametrize("op, a, b, want", [("contains", "ABC", "b", True), ("=", "a", "A", False), (">", "10", "9", True), (">", "b", "a", True), ("≤", "2", "10", True), ("not empty", "", "", False), ("end with", "xY", "y", True)])
def test_switch_predicates(spark, op, a, b, want):
    assert one(spark, a, lambda c: T.compare(c, op, F.lit(b))) is want


def test_numerals():
    assert [udfs.index_number(x) for x in ("7", "Eleven", "十二", "二十", "IV", "x", None)] == [7, 11, 12, 20, 4, -1, -1]


def test_greedy_chunks_overshoot_by_one_section(spark):
    sections = ["a b c ", "d e f ", "g ", "h i "]
    got = spark.createDataFrame([(sections,)], "s array<string>").select(C.greedy(F.col("s"), 4)).first()[0]
    assert got == ["a b c d e f ", "g h i "]


def test_upsert_keeps_and_adds(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, s string, t int")
    new = spark.createDataFrame([(2, "x", 9), (3, "y", 9), (1, None, 9)], "id int, s string, t int")
    assert {tuple(r) for r in dml.upsert(old, new, "id", keep=("t",)).collect()} == {(1, "a", 1), (2, "x", 2), (3, "y", 9)}


def test_delete_where_null_stays(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, f boolean")
    assert {r.id for r in dml.delete_where(df, F.col("f")).collect()} == {1, 3}


def test_deep_merge():
    assert R.deep_merge({"a": {"b": [1], "c": 1}, "d": 2}, {"a": {"b": [1, 2], "c": 3}}) == {"a": {"b": [1, 2], "c": 3}, "d": 2}


def test_rules(spark):
    nodes = spark.createDataFrame([(1, "disease", {"name": "flu"}), (1, "drug", {"name": "zinc", "dose": "5mg"}), (2, "drug", {"name": "iron"})], "g int, type string, attributes map<string,string>")
    got = {r.g: (r.a, r.b, r.c) for r in G.evaluate_rules(nodes, "g", {"a": "disease and drug.dose =~ '^[0-9]+mg$'", "b": "not (disease = flu, cold) or drug ~ zin", "c": "disease"}).collect()}
    assert got == {1: (True, True, True), 2: (False, True, False)}
    with pytest.raises(ValueError):
        G.Rule("disease =")


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(99, 98)], "src long, dst long")
    got = {r.node: r.component for r in G.connected(edges).collect()}
    assert got == {i: 0 for i in range(51)} | {98: 98, 99: 98}


def test_sql_cleanup():
    assert S.clean_sql("Sure: ```sql\nSELECT a\nFROM t; drop\n```") == "SELECT a FROM t"
    assert "array_contains(split(x_tks, ' '), 'b')" in S.rewrite("select 1 from t where x_tks like '%a b%'")
    with pytest.raises(ValueError):
        S.clean_sql("drop table t")


def test_messages():
    ms = [{"role": "system", "content": "s " * 10}, {"role": "user", "content": "u " * 50}, {"role": "user", "content": "last " * 5}]
    assert chat.fit_messages(ms, 100)[1] == ms
    assert [m["role"] for m in chat.fit_messages(ms, 40)[1]] == ["system", "user"]
    assert chat.count_tokens(chat.fit_messages([{"role": "system", "content": "s " * 90}, ms[-1]], 20)[1][0]["content"]) == 15


def test_term_weights_sum_to_one():
    w = retrieval.weights("the year 2020 of ab longword")
    assert abs(sum(w.values()) - 1) < 1e-9 and w["2020"] > w["longword"] > w["ab"]


def _part(name, down, up, **params):
    return {"obj": {"component_name": name, "params": params}, "downstream": down, "upstream": up}


def test_flow_switches_and_retrieves(spark):
    dsl = {
        "components": {
            "begin": _part("Begin", ["answer:0"], []),
            "answer:0": _part("Answer", ["retrieve"], ["begin"]),
            "retrieve": _part("Retrieval", ["switch"], ["answer:0"], table="t", similarity_threshold=0.3, empty_response="nothing"),
            "switch": _part("Switch", ["generate", "message"], ["retrieve"], conditions=[{"logical_operator": "and", "items": [{"cpn_id": "retrieve", "operator": "contains", "value": "FOX"}], "to": "generate"}], end_cpn_id="message"),
            "generate": _part("Generate", ["answer:1"], ["switch"], prompt="Say {input}", message_history_window_size=0),
            "message": _part("Message", ["answer:1"], ["switch"], messages=["sorry"]),
            "answer:1": _part("Answer", [], ["generate", "message"]),
        }
    }
    tables = {"t": spark.createDataFrame([("the quick fox",), ("a lazy dog",)], "content string")}
    answer = lambda q: flow.Flow(spark, json.dumps(dsl), tables=tables).run(q).first()[0]
    assert answer("quick fox") == "Say the quick fox"
    assert answer("zebra") == "sorry"


def test_flow_needs_begin_and_answer(spark):
    with pytest.raises(ValueError):
        flow.Flow(spark, {"components": {"begin": _part("Begin", [], [])}})


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one. two!\nthree")
    (tmp_path / "b.html").write_text("<html><title>T</title><body><p>x &lt; y</p></body></html>")
    (tmp_path / "c.tsv").write_text("h1\th2\n1\t2\n3\t4\n")
    (tmp_path / "d.eml").write_text("Subject: hi\nFrom: a@b.c\n\nbody text\n")
    (tmp_path / "e.json").write_text(json.dumps({"a": list(range(20)), "b": "x" * 50}))
    assert readers.plain_files(spark, f"{tmp_path}/a.txt").first().content == "one. two!\nthree"
    assert tuple(readers.html_files(spark, f"{tmp_path}/b.html").first())[1:] == ("T", "T x < y")
    assert [tuple(r) for r in readers.delimited(spark, f"{tmp_path}/c.tsv", rows=(1, 2)).collect()] == [("3", "4")]
    parts = {r.kind: r.text for r in readers.mail_files(spark, f"{tmp_path}/d.eml").collect()}
    assert "Subject: hi" in parts["header"] and parts["plain"].strip() == "body text"
    chunks = [json.loads(r.content) for r in readers.json_files(spark, f"{tmp_path}/e.json", 60).collect()]
    assert len(chunks) > 1 and any("b" in c for c in chunks)


def test_codecs(spark):
    rows = spark.createDataFrame([(1, "héllo".encode()), (2, "中文".encode("gbk")), (3, None)], "id int, b binary")
    got = {r.id: r.c for r in rows.select("id", C.codec(F.col("b")).alias("c")).collect()}
    assert got[1] == "utf-8" and got[2] in ("gb2312", "gbk")


def test_web_source(spark):
    spark.dataSource.register(readers.WebSearch)
    got = spark.read.format("lodestone_web").option("terms", "a|b").load().collect()
    assert {r.term for r in got} == {"a", "b"}


def test_summary_tree_ends_in_one_root(spark):
    rows = [(1, f"text {i}. more", [float(i % 3), float(i)]) for i in range(9)] + [(2, "alone", [1.0, 1.0])]
    got = chat.summary_tree(spark.createDataFrame(rows, "d int, content string, vector array<double>"), "d").toPandas()
    assert set(got.d) == {1} and (got[got.layer == got.layer.max()].shape[0]) == 1


def test_citations_compare_all_chunks(spark):
    pieces = spark.createDataFrame([(1, ["a", "b"], [1.0, 0.0])], "piece long, ptks array<string>, pvec array<double>")
    rows = [(i, ["c"], [0.2, 1.0]) for i in range(3000)] + [(3000, ["a", "b"], [1.0, 0.0])]
    chunks = spark.createDataFrame(rows, "chunk long, ctks array<string>, cvec array<double>")
    assert [(r.piece, r.chunk) for r in retrieval.citations(pieces, chunks).collect()] == [(1, 3000)]
