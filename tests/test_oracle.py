"""Every registered query against its DuckDB SQL on the smallest tables.

The same comparison the driver makes at sf0.01: equal column names, equal
row counts and equal multisets of values.
"""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from ohlcflow.oracle import oracle_sql
from ohlcflow.queries import queries

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["time", "high", "low", "open", "close", "volumefrom", "volumeto", "symbol", "batch_unit"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_duckdb(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    rel = duck.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    want = sorted(tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want
