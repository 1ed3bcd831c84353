"""Comparison by digests gives the verdict of the full comparison."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.compare import compare, compare_by_digests, leaf_digests

KIND = "k bigint, g string, x double, t string, i int"
NAMES = ["only_first", "only_second", "cells_off", "rows", "equal"]


def rows(seed, n=300):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), -0.0, 0.0, 1e300, 1e-300, -5.5]
    return [(i, rng.choice(["a", None]), rng.choice([*odd, rng.uniform(-1e6, 1e6)]), rng.choice(["", "x", None]), rng.choice([None, i])) for i in range(n)]


def changed(given, seed, share, by):
    rng = random.Random(seed)
    out = []
    for k, g, x, t, i in given:
        r = rng.random()
        if r < share / 4:
            continue
        if r < share and x is not None:
            x = by(x)
        elif r > 1 - share / 4:
            t, i = i and str(i), None
        out.append((k, g, x, t, i))
    return out + [(10_000 + j, "new", 1.0, None, 0) for j in range(int(share * 10))]


@pytest.mark.parametrize("share, by", [(0.0, None), (0.1, lambda x: x + 1.0), (0.5, lambda x: x * (1 + 1e-12)), (0.5, lambda x: x * (1 + 2e-9)), (0.2, lambda x: -x)])
@pytest.mark.parametrize("limits", [{}, {"leaf_rows": 4}])
def test_verdict_is_that_of_the_full_comparison(spark, share, by, limits):
    first = spark.createDataFrame(rows(1), KIND)
    second = spark.createDataFrame(changed(rows(1), 2, share, by), KIND).orderBy(F.rand(3))
    for tolerance in ({}, {"rtol": 0.0, "atol": 0.0}, {"rtol": 0.0, "atol": 0.5}, {"rtol": 1e-3, "atol": 0.0}):
        want = compare(first, second, ["k", "g"], ["x", "t", "i"], **tolerance).first()
        got = compare_by_digests(first, second, ["k", "g"], ["x", "t", "i"], **tolerance, **limits).first()
        assert [got[c] for c in NAMES] == [want[c] for c in NAMES]
        assert got.joined_rows == 0 if share == 0.0 else got.joined_rows <= got.rows


def test_one_change_opens_one_leaf(spark):
    first = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") / 7).alias("x"))
    second = first.withColumn("x", F.when(F.col("k") == 4321, F.col("x") + 1).otherwise(F.col("x")))
    got = compare_by_digests(first, second, ["k"], ["x"], leaf_rows=50).first()
    assert (got.cells_off, got.rows, got.equal) == (1, 5000, False) and 0 < got.joined_rows < 200
    none = compare_by_digests(first.limit(0), first.limit(0), ["k"], ["x"]).first()
    assert (none.rows, none.equal, none.joined_rows) == (0, True, 0)
    assert compare_by_digests(first, first.limit(0), ["k"], ["x"]).first().only_first == 5000


def test_nulls_do_not_change_places(spark):
    a = spark.createDataFrame([(1, None, "a")], "k int, s string, t string")
    b = spark.createDataFrame([(1, "a", None)], "k int, s string, t string")
    d = [leaf_digests(x, ["k"], ["s", "t"], 1).first().d1 for x in (a, b)]
    assert d[0] != d[1] and not compare_by_digests(a, b, ["k"], ["s", "t"]).first().equal
