"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from tidegauge.plans.catalogue import load

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def table(columns, rows):
    order = sorted(columns)
    return sorted([tuple(plain(r[columns.index(c)]) for c in order) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(load()))
def test_query(spark, duck, name):
    q = load()[name]
    df = q.run(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if q.sql is None:
        assert rows
        return
    found = duck.execute(q.sql)
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, rows) == table(columns, found.fetchall())
