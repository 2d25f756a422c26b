"""Every query of the reference's own operators, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _plans():
    from lodestone.plans import agents, analysis, chunking, dml, graph, index, knowledge, parsers, relational, retrieval, streams, structure, texts

    return relational, dml, texts, analysis, retrieval, chunking, structure, parsers, index, graph, knowledge, agents, streams


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for plan in _plans() for name, f in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for plan in _plans() for name, sql in plan.ORACLES.items()}
