"""Agent flows, summary trees and SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.functions import udfs
from lodestone.operators import chat, flow
from lodestone.plans.catalogue import Tables, lists

QUERIES, ORACLES = {}, {}
query = lists(QUERIES, ORACLES)


def _component(name: str, down: list[str], up: list[str], **params) -> dict:
    return {"obj": {"component_name": name, "params": params}, "downstream": down, "upstream": up}


FLOW = {
    "components": {
        "begin": _component("Begin", ["answer:0"], [], prologue="Hi"),
        "answer:0": _component("Answer", ["categorize:0"], ["begin"]),
        "categorize:0": _component("Categorize", [], ["answer:0"], category_description={"numbers": {"to": "sql:0"}, "other": {"to": "message:0"}}),
        "sql:0": _component("ExeSQL", ["answer:1"], ["answer:0"], top_n=5),
        "message:0": _component("Message", ["answer:1"], ["categorize:0"], messages=["none"]),
        "answer:1": _component("Answer", [], ["sql:0", "message:0"]),
    }
}


@query("SELECT 'Total: 5' || chr(10) || '|r_regionkey|r_name|' || chr(10) || '|---|---|' || chr(10) || string_agg('|' || r_regionkey || '|' || r_name || '|', chr(10) ORDER BY r_regionkey) AS content FROM region")
def agent_flow(t: Tables) -> DataFrame:
    run = flow.Flow(t.spark, FLOW, model=lambda prompt: "numbers" if "select" in prompt else "other", tables={"region": t.region})
    return run.run("select r_regionkey, r_name from region").select("content")


@query()
def raptor_layer(t: Tables) -> DataFrame:
    chunks = t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id")).select("source", F.col("text").alias("content"), F.col("embedding").alias("vector"))
    return chat.summary_tree(chunks, "source")


@query("SELECT doc_id, CAST(floor((i - 1) / 1000) AS INTEGER) AS chunk, md5(substr(text, i, 1000)) AS content FROM (SELECT doc_id, text, unnest(generate_series(1, length(text), 1000)) AS i FROM documents)")
def udtf_chunk_text(t: Tables) -> DataFrame:
    udfs.register(t.spark)
    t.documents.createOrReplaceTempView("udtf_documents")
    return t.spark.sql("SELECT doc_id, c.chunk, md5(c.content) AS content FROM udtf_documents, LATERAL chunk_text(text, 1000) c")


@query("SELECT o_orderkey, o_orderkey AS n FROM orders")
def udf_index_number(t: Tables) -> DataFrame:
    udfs.register(t.spark)
    return t.orders.select("o_orderkey", F.call_function("index_number", F.col("o_orderkey").cast("string")).cast("long").alias("n"))
