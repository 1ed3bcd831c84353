"""The large-table paths give what the one-task paths give, and what brute force gives."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators.model import auc
from tidegauge.operators.quantiles import quantiles
from tidegauge.operators.scale import carry_forward, lookup, numbered_rows, running_totals, salted_lookup, stage

SMALL = {"one_task_rows": 10, "slice_rows": 40}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, some keys null."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"]), i, round(rng.gauss(50, 20), 2)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "k string, i bigint, v double")


def test_running_totals_sliced(skewed):
    rows, df = skewed
    got = {(r.k, r.i): (r.v_before, r.v_total) for r in running_totals(df, ["k"], ["i"], ["v"], **SMALL).collect()}
    for key in {r[0] for r in rows}:
        before, mine = 0.0, sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        total = sum(r[2] for r in mine)
        for r in mine:
            assert got[key, r[1]] == (pytest.approx(before, abs=1e-6), pytest.approx(total))
            before += r[2]


def test_records_are_dealt_over_tasks_before_they_are_judged(spark, monkeypatch):
    """150 customers in one row group: a task per 20 of them, for records, products and events alike."""
    from tidegauge.operators import scale
    from tidegauge.plans import intake_queries, record_queries

    monkeypatch.setattr(scale, "RECORD_ROWS", 20)
    folder = "/root/testdata/sf0.001"
    customers = spark.read.parquet(f"{folder}/customer.parquet").count()
    for rows in (record_queries.user_records(spark, folder), intake_queries.events(spark, folder)):
        assert rows.rdd.getNumPartitions() >= customers // 20
    assert record_queries.product_records(spark, folder).rdd.getNumPartitions() >= 5
    assert record_queries.user_records(spark, folder).select("row").distinct().count() == customers


def test_numbering_sliced(skewed):
    _, df = skewed
    numbers = sorted(r.n for r in numbered_rows(df, ["i"], "n", **SMALL).collect())
    assert numbers == list(range(1, 601))


@pytest.mark.parametrize("method,numpy_method", [("linear", "linear"), ("nearest", "inverted_cdf")])
@pytest.mark.parametrize("limits", [{}, SMALL])
def test_quantiles(skewed, method, numpy_method, limits):
    rows, df = skewed
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.95, 1]
    for r in quantiles(df, "v", probs, ["k"], method=method, **limits).collect():
        values = [x[2] for x in rows if x[0] == r.k]
        assert r.n == len(values)
        assert r.q == pytest.approx(list(np.quantile(values, probs, method=numpy_method)))


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert quantiles(empty, "v", [0.5]).first().n == 0
    with pytest.raises(ValueError):
        quantiles(empty, "v", [0.5], method="other").collect()


def test_sketch_option(skewed):
    _, df = skewed
    assert quantiles(df, "v", [0.5], accuracy=1000).first().q[0] == pytest.approx(50, abs=5)


def test_carry_forward_sliced(spark):
    rng = random.Random(3)
    rows = [(i, str(i) if rng.random() < 0.05 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "i bigint, s string")
    got = {r.i: r.out for r in carry_forward(df, ["i"], "s", "out", **SMALL).collect()}
    last = None
    for i, s in rows:
        last = s or last
        assert got[i] == last


@pytest.mark.parametrize("weight", [None, "n"])
def test_salted_lookup_keeps_every_row(skewed, spark, weight):
    rows, df = skewed
    big = df.unionByName(spark.range(5000).select(F.lit("hot").alias("k"), (F.col("id") + 1000).alias("i"), F.lit(1.0).alias("v")))
    big = stage(big.repartition(4))
    table = stage(big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")))
    salted = salted_lookup(big, table, ["k"], weight=weight)
    plain = lookup(big, table, ["k"], table_rows=5)
    assert salted.count() == big.count()
    assert salted.select("k", "i", "top").exceptAll(plain.select("k", "i", "top")).isEmpty()
    assert salted.filter(F.col("top").isNull()).isEmpty()


def test_auc_sliced(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 1), rng.randint(0, 60) / 60) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    wins = sum((a > b) + 0.5 * (a == b) for y, a in rows if y for z, b in rows if not z)
    expected = wins / (sum(y for y, _ in rows) * sum(1 - y for y, _ in rows))
    for limits in ({}, SMALL):
        assert auc(df, "y", "s", **limits).first().roc_auc == pytest.approx(expected)
