"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node each node of edges (u, v) reaches.

    Both steps aggregate a node's neighbours to their minimum before anything is joined, so a hub
    with very many neighbours adds no pairs.  Rounds grow with the logarithm of the nodes; each
    ends in a table of the shared folder.  Self-loops and null ends are ignored.
    """
    edges = edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut(edges, "edges")
    state = _state(edges)
    while state[0]:
        # Large star: neighbours above u go to the least of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its neighbours below go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        below = large.join(least, "u")
        small = below.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
