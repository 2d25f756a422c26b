"""Graphs as chunks of an index: rendering, loading, upkeep by source document, report inputs, claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestone.operators.analysis import tokens
from lodestone.operators.index import csv_lines

# Separators of a multi-source attribute, and kinds of graph chunks.
SOURCES = "\n"
ENTITY, GRAPH = "entity", "graph"


def entity_chunks(nodes: DataFrame) -> DataFrame:
    """A chunk for each node (name, type, description, source_id, weight, rank) that has an edge."""
    content = F.to_json(F.struct("name", "type", "description", "source_id", "weight", "rank"))
    return nodes.where("rank > 0").select(
        F.col("name").alias("name_kwd"), F.array("name").alias("important_kwd"), F.array_join(tokens(F.col("name")), " ").alias("title_tks"),
        content.alias("content_with_weight"), F.array_join(tokens(F.col("description")), " ").alias("content_ltks"),
        F.lit(ENTITY).alias("knowledge_graph_kwd"), F.col("rank").alias("rank_int"), F.col("weight").alias("weight_int"),
    )


def graph_chunks(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """One chunk for each document's graph, node-link JSON: nodes (key, name) and edges (key, src, dst, weight)."""
    n = nodes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("name").alias("id")))).alias("nodes"))
    e = edges.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), "weight"))).alias("links"))
    links = F.coalesce("links", F.array().cast("array<struct<source:string,target:string,weight:bigint>>"))
    value = F.struct(F.lit(False).alias("directed"), F.lit(False).alias("multigraph"), "nodes", links.alias("links"))
    return n.join(e, key, "left").select(key, F.to_json(value).alias("content_with_weight"), F.lit(GRAPH).alias("knowledge_graph_kwd"))


def load(chunks: DataFrame, doc_id: object | None = None, names: list[str] | None = None) -> DataFrame:
    """Graph rows of a document, or of any of the names, or both."""
    test = F.lit(False)
    if doc_id is not None:
        test = test | (F.col("doc_id") == F.lit(doc_id))
    if names:
        test = test | F.col("name").isin(*names)
    return chunks.where(test)


def _left(sources: Column, gone: Column) -> Column:
    return F.array_except(F.split(sources, SOURCES), F.array(gone))


def without_source(rows: DataFrame, doc_id: Column) -> DataFrame:
    """Nodes or edges less one document's part: others' keep their remaining sources, its own go."""
    left = rows.withColumn("__left", _left(F.col("source_id"), doc_id))
    return left.where(F.size("__left") > 0).withColumn("source_id", F.array_join("__left", SOURCES)).drop("__left")


def with_source(rows: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows united with a document's own: sources and descriptions are joined, weights add up."""
    old = rows.select(*key, F.col("description").alias("__d"), F.col("source_id").alias("__s"), F.col("weight").alias("__w"))
    both = new.join(old, key, "full_outer")
    union = lambda a, b: F.array_join(F.array_sort(F.array_distinct(F.concat(F.split(F.coalesce(a, F.lit("")), SOURCES), F.split(F.coalesce(b, F.lit("")), SOURCES)))), SOURCES)
    text = lambda a, b: F.regexp_replace(union(F.col(a), F.col(b)), r"^\n", "")
    return both.select(*key, (F.coalesce("weight", F.lit(0)) + F.coalesce("__w", F.lit(0))).alias("weight"), text("description", "__d").alias("description"), text("source_id", "__s").alias("source_id"))


def report_inputs(members: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Of each community the CSV of its entities and of the relations with an end in it; members is (node, community)."""
    def table(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        lines = rows.select("community", F.struct(*columns).alias("o"), csv_lines(rows, columns).alias("line")).groupBy("community").agg(F.array_sort(F.collect_set(F.struct("o", "line"))).alias("x"))
        numbered = F.transform("x", lambda x, i: F.concat(i.cast("string"), F.lit(","), x["line"]))
        head = ",".join(["id", *columns])
        return lines.select("community", F.array_join(F.concat(F.array(F.lit(head)), numbered), "\n").alias(name))

    entities = members.join(nodes, members["node"] == nodes["name"]).select("community", F.col("name").alias("entity"), "type", "description")
    ends = [edges.join(members, edges[side] == members["node"]).select("community", F.col("src").alias("source"), F.col("dst").alias("target"), "weight", "description") for side in ("src", "dst")]
    relations = ends[0].unionByName(ends[1]).distinct()
    return table(entities, ["entity", "type", "description"], "entities").join(table(relations, ["source", "target", "weight", "description"], "relations"), "community", "left")


def resolved_claims(claims: DataFrame, names: DataFrame) -> DataFrame:
    """Claims with subject_id and object_id replaced by the entity they resolve to; names is (name, entity)."""
    out = claims
    for side in ("subject_id", "object_id"):
        out = out.join(names.select(F.col("name").alias(side), F.col("entity").alias("__to")), side, "left").withColumn(side, F.coalesce("__to", side)).drop("__to")
    return out


def projected(sql: str, fields: list[str], hidden: tuple[str, ...] = (), most: int = 12) -> str:
    """A select over chunks that also returns the document: `*` becomes at most `most` fields; groupings stay."""
    import re

    if re.search(r"((sum|avg|max|min)\(|group by )", sql.lower()):
        return sql
    body = sql[len("select ") :].lstrip()
    if body.startswith("*"):
        body = ",".join([f for f in fields if f not in hidden][:most]) + body[1:]
    return "select doc_id,docnm_kwd," + body


def colon_titles(sections: Column) -> Column:
    """Sections with a title put before those that end in a colon: what follows the last sentence end, if that leaves 32 characters or more."""
    def one(s: Column) -> Column:
        bare = F.trim(F.regexp_extract(s, r"^[^@]*", 0))
        title = F.regexp_extract(bare, r"(?s)(?:[。？！!?;；]|\. )([^。？！!?;；]*[:：])$", 1)
        return F.when(bare.rlike("[:：]$") & (F.length(title) >= 32), F.array(F.trim(title), s)).otherwise(F.array(s))

    return F.flatten(F.transform(sections, one))
