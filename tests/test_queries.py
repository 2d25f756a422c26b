"""Every query of the reference's operators against its SQL on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from lodestone import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def connection(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(int(v)) if v == int(v) else repr(v)
    return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(map(cell, r)) for r in frame[names].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, connection, name):
    got = registry.queries()[name](spark, sf).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) and len(got)
    else:
        assert rows(got) == rows(connection.execute(sql).df())
