"""Filters, joins, ranks and set operations of the catalogue side."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def available(flag: Column, wanted: int = 1) -> Column:
    """1: not switched off (null passes); 0: switched off."""
    return F.coalesce(flag, F.lit(1)) >= 1 if wanted else flag < 1


def dynamic_filter(df: DataFrame, **by) -> DataFrame:
    """Equality; IN for a list; BETWEEN for a (low, high) tuple, either end open with None."""

    def one(name: str, value) -> Column:
        c = F.col(name)
        if isinstance(value, tuple):
            low, high = value
            ends = [c >= low] * (low is not None) + [c <= high] * (high is not None)
            return reduce(and_, ends, F.lit(True))
        return c.isin(*value) if isinstance(value, list) else c == value

    return df.where(reduce(and_, (one(k, v) for k, v in by.items()), F.lit(True)))


#: Operators of a filter dictionary.
EXPRESSIONS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<<": lambda c, v: c.isin(*v),
    ">>": lambda c, v: c.isNull() if v is None else c.eqNullSafe(v),
    "%": lambda c, v: c.like(v),
    "**": lambda c, v: c.ilike(v),
    "^": lambda c, v: c.startswith(v),
    "~": lambda c, v: c.rlike(v),
}


def expression_filter(df: DataFrame, tests: list[tuple[str, str, object]]) -> DataFrame:
    return df.where(reduce(and_, (EXPRESSIONS[op](F.col(name), value) for name, op, value in tests), F.lit(True)))


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first in order."""
    name = "__rank"
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) == 1).drop(name)


def last_n_by(df: DataFrame, keys: list[str], order: Column, n: int) -> DataFrame:
    name = "__rank"
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(order))).where(F.col(name) <= n).drop(name)


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """Page `number`, from 1, in a total order; Spark keeps only offset + size rows of each partition."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def content_union(*frames: DataFrame, content: str = "content") -> DataFrame:
    """Upstream outputs one after another, the first of each content kept."""
    named = [f.withColumn("__from", F.lit(i)) for i, f in enumerate(frames)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    rest = [c for c in whole.columns if c not in (content, "__from")]
    return first_by(whole, [content], F.col("__from"), *map(F.col, rest)).drop("__from")


def deep_merge(base: dict, new: dict) -> dict:
    """Settings overlay: maps merge, lists become unions, all else is replaced."""
    out = dict(base)
    for k, v in new.items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = deep_merge(out[k], v)
        elif isinstance(v, list) and isinstance(out.get(k), list):
            out[k] = out[k] + [x for x in v if x not in out[k]]
        else:
            out[k] = v
    return out
