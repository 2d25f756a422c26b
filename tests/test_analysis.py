"""Token analysis, JSON cuts, codecs, detections, scrolls and the file store against hand-made or brute-force results."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import analysis as A
from lodestone.operators import chunking as C
from lodestone.operators import flow, index, parsers


def test_tokens_of_a_question():
    assert A.tokenise("犬瘟ＡＢ 3.5，fpv-2--x") == ["犬", "瘟", "ab", "3.5,", "fpv-", "2--", "x"]
    assert A.pretoken("The cat, 5 of 12!", stop_words=frozenset({"the"})) == ["cat", "of", "12"]
    assert A.merged(["a", "工位", "b", "c", "long", "d", "e", "f", "g", "h"]) == ["a 工位", "b c", "long", "d e", "f g h"]
    assert A.merged([]) == [] and A.merged(["x"]) == ["x"]
    assert A.segments("big data 分析 of x") == ["big data", "分析", "of x"]
    assert A.segments("data of x", frozenset({"of"})) == ["data", "of", "x"]
    assert sum(w for _, w in A.weigh(["犬瘟热治疗"])) == pytest.approx(1.0)


def test_question_clauses(spark):
    clauses, keywords = A.short_question("犬瘟热怎么治疗？", synonyms={"犬瘟热治疗": ["distemper"]})
    assert [c.segment for c in clauses] == ["犬瘟热治疗"] and "distemper" in keywords and clauses[0].synonyms == ["distemper"]
    rows = spark.createDataFrame([(1, "犬瘟热 治疗"), (2, "distemper"), (3, "猫")], "id int, text string").withColumn("tks", A.tokens(F.col("text")))
    got = {r.id: r.s for r in rows.select("id", A.match_clauses(F.col("tks"), clauses).alias("s")).collect()}
    assert got[1] > got[2] > 0 and not got[3]


def test_kinds_of_first_characters(spark):
    rows = spark.createDataFrame([("中a",), ("1",), ("Zx",), ("",)], "t string")
    assert [tuple(r) for r in rows.select(A.is_chinese(rows.t), A.is_number(rows.t), A.is_alphabet(rows.t)).collect()] == [(True, False, False), (False, True, False), (False, False, True), (False, False, False)]


def leaves(x, path=()):
    if isinstance(x, (dict, list)) and x:
        for k, v in x.items() if isinstance(x, dict) else enumerate(x):
            yield from leaves(v, (*path, str(k)))
    else:
        yield path, x if not isinstance(x, list) else {}


def test_json_chunks(spark):
    value = {"a": {"b": ["x" * 40, {"c": "y" * 90}, 3], "d": "z" * 30}, "e": [], "f": list(range(60)), "g": None, "h": "w" * 300}
    rows = [(json.dumps(value),), ("[1, 2]",), ("7",), ("no json",), (None,), ("{}",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(C.json_chunks(F.col("t"), 120, 60)).collect()]
    parts = [json.loads(x) for x in got[0]]
    found = [leaf for p in parts for leaf in leaves(p)]
    assert sorted(map(str, found)) == sorted(map(str, leaves(value))) and len(parts) > 3
    assert all(len(x) <= 120 + 40 or len(list(leaves(json.loads(x)))) == 1 or "w" * 300 in x for x in got[0])
    assert [json.loads(x) for x in got[1]] == [{"0": 1, "1": 2}] and got[2] == ["7"] and got[3] == [] and not got[4] and not got[5]


def test_codecs(spark):
    blobs = ["中文 text".encode(c) for c in ("utf-8", "gb2312", "big5", "utf_16", "shift_jis")] + [b"\xff\xfe\xfd", b"", bytes(range(128, 256)), b"a" * 2000 + b"\xe4b", None]

    def one(b):
        for c in C.CODECS if b is not None else ():
            for part in (b[:1024], b):
                try:
                    part.decode(c)
                    return c
                except Exception:
                    continue
        return None if b is None else "utf-8"

    rows = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i int, b binary")
    assert {r.i: r.c for r in rows.select("i", C.codec(F.col("b")).alias("c")).collect()} == {i: one(b) for i, b in enumerate(blobs)}


def test_detections(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        x, y, w, h = (float(v) for v in rng.integers(1, 60, 4))
        rows.append((i, int(rng.integers(0, 4)), "ab"[i % 2], x, y, x + w, y + h, float(rng.integers(50, 100)) / 100))
    boxes = spark.createDataFrame(rows, "id int, page int, kind string, x0 double, top double, x1 double, bottom double, score double")
    got = {r.id for r in parsers.kept_detections(boxes, "page", "kind").collect()}
    want = []
    for r in sorted((r for r in rows if r[7] >= 0.7), key=lambda r: (-r[7], r[0])):
        def iou(s):
            inner = max(0, min(r[5], s[5]) - max(r[3], s[3])) * max(0, min(r[6], s[6]) - max(r[4], s[4]))
            return inner / ((r[5] - r[3]) * (r[6] - r[4]) + (s[5] - s[3]) * (s[6] - s[4]) - inner)

        if all(s[1:3] != r[1:3] or iou(s) < 0.2 for s in want):
            want.append(r)
    assert got == {r[0] for r in want}


def test_scroll_and_store(spark, tmp_path):
    rows = spark.range(250).toDF("id")
    assert [p.count() for p in index.scrolled(rows, "id")] == [100, 100, 50]
    store = parsers.Store(spark, f"file://{tmp_path}")
    assert not store.exists("b", "x")
    store.put("b", "x", b"\x00\xff data")
    assert store.exists("b", "x") and store.get("b", "x") == b"\x00\xff data"
    store.remove("b", "x")
    assert not store.exists("b", "x")


def test_prompts_are_not_cut(spark):
    with pytest.raises(OverflowError):
        flow.few(spark.range(1001).selectExpr("string(id) as content"))
    assert len(flow.few(spark.range(1000).selectExpr("string(id) as content"))) == 1000


def test_sql_is_asked_for_twice(spark):
    asked = []
    with pytest.raises(ValueError):
        parsers.ask_sql(spark, lambda p: asked.append(p) or "select no_such from t_rows group by 1", "t_rows", spark.range(3).toDF("id"), {"id": "number"}, "?")
    assert len(asked) == 2 and "Its error" in asked[1]


def test_rows_without_a_key(spark):
    got = C.grouped_rows(spark.range(25).select("id", F.col("id").cast("string").alias("t")), "id", "t", 10).collect()
    assert sorted(r.content.count(";") + 1 for r in got) == [5, 10, 10]
