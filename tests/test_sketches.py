"""Radix descent, one-pass resampling and mergeable sketches."""

from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import sample as S
from tidegauge.operators import sketches as K


def order(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


@pytest.mark.parametrize("limits", [{}, {"rank_rows": 3, "step": 1}, {"rank_rows": 40, "step": 2}])
def test_descent_finds_the_same_cut(spark, limits):
    rng = random.Random(1)
    rows = [(k, rng.choice(["big", "big", "big", "small", None])) for k in range(400)] + [(1000, "lone")]
    df = spark.createDataFrame(rows, "k bigint, s string")
    for fraction in (0.0, 0.37):
        got = {r.k for r in S.stratified_split(df, ["s"], "k", fraction, 5, **limits).filter("chosen").collect()}
        want = set()
        for s in {s for _, s in rows}:
            keys = sorted((k for k, x in rows if x == s), key=lambda k: order(5, k))
            want |= set(keys[: round(len(keys) * fraction)])
        assert got == want
        some = {r.k for r in S.exact_subset(df, "k", fraction, 6, **limits).filter("chosen").collect()}
        assert some == set(sorted((k for k, _ in rows), key=lambda k: order(6, k))[: math.floor(len(rows) * fraction)])


def test_descent_with_a_key_that_is_a_third_of_all_rows(spark):
    rows = [(7,)] * 100 + [(k,) for k in range(100, 300)]
    df = spark.createDataFrame(rows, "k bigint")
    places = sorted((k for k, in rows), key=lambda k: order(3, k))
    for fraction in (0.2, 0.9):
        wanted = math.floor(len(rows) * fraction)
        got = sorted((r.k for r in S.exact_subset(df, "k", fraction, 3, rank_rows=10, step=1).filter("chosen").collect()), key=lambda k: order(3, k))
        whole = len(places) - places[::-1].index(places[wanted - 1])  # the repetitions of the last key come along
        assert got == places[:whole]
    assert S.exact_subset(df.limit(0), "k", 0.5, 3).count() == 0
    assert S.stratified_split(spark.createDataFrame([(None,), (1,)], "k bigint"), [], "k", 0.5, 3).count() == 2


def test_poisson_draws_follow_their_distribution(spark):
    n = 20_000
    drawn = spark.range(n).select("id", *[S.poisson_draws(F.lit(m), 9, F.col("id")).alias(f"d{i}") for i, m in enumerate((0.1, 1.0, 8.0))])
    for i, mean in enumerate((0.1, 1.0, 8.0)):
        counts = {r[0]: r[1] for r in drawn.groupBy(f"d{i}").count().collect()}
        for k in range(4):
            p = math.exp(-mean) * mean**k / math.factorial(k)
            assert abs(counts.get(k, 0) - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 1


def test_poisson_resample(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") == 0, 1500.0).when(F.col("id") < 1000, 0.0).otherwise(1.0).alias("w"), F.lit("x").alias("_row"))
    got = S.poisson_resample(df, "id", F.col("w"), 4, chunk_draws=100)
    rows = got.collect()
    assert sorted(rows) == sorted(S.poisson_resample(df.repartition(7), "id", F.col("w"), 4, chunk_draws=100_000).collect())  # the same wherever it runs
    assert got.columns == ["id", "w", "_row", "copy"] and len({(r.id, r.copy) for r in rows}) == len(rows)
    expected = 3000 * 1500 / 3500  # the heavy row has 3/7 of the weight
    assert abs(sum(r.id == 0 for r in rows) - expected) < 5 * math.sqrt(expected)
    assert not any(0 < r.id < 1000 for r in rows) and abs(len(rows) - 3000) < 5 * math.sqrt(3000)
    odd = spark.createDataFrame([(1, None), (2, -1.0), (3, 0.0)], "id bigint, w double")
    assert S.poisson_resample(odd, "id", F.col("w"), 4).count() == 0
    assert S.poisson_resample(odd.limit(0), "id", F.col("w"), 4).columns == ["id", "w", "copy"]


def skewed(spark):
    return spark.range(60_000).select(
        (F.col("id") % 30).cast("int").alias("day"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        F.when(F.col("id") % 11 > 0, (F.xxhash64("id") % 4000)).alias("user"), F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 50).alias("v"),
    )


def test_merged_sketches_are_within_their_errors(spark, tmp_path):
    rows = skewed(spark)
    K.store(K.summaries(rows, F.col("day"), ["k"], distinct="user", value="v"), f"{tmp_path}/s")
    K.store(K.summaries(rows.filter("day = 3"), F.col("day"), ["k"], distinct="user", value="v"), f"{tmp_path}/s")  # once more
    stored = spark.read.parquet(f"{tmp_path}/s")
    for low, high, keys in ((0, 30, ["k"]), (5, 9, []), (3, 4, ["k"])):
        span = rows.filter(F.col("day").between(low, high - 1))
        asked = (0.0, 0.1, 0.5, 0.99, 1.0)
        got = {tuple(r[c] for c in keys): r for r in K.estimates(K.merged(stored.filter(F.col("period").between(low, high - 1)), keys), asked).collect()}
        exact = span.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("user").alias("d"), F.sort_array(F.collect_list("v")).alias("v"))
        for e in exact.collect():
            r = got[tuple(e[c] for c in keys)]
            assert r.n == e.n and abs(r.n_distinct - e.d) <= 4 * K.distinct_error() * e.d + 1
            for p, q in zip(asked, r.q, strict=True):
                below, upto = sum(x < q for x in e.v) / len(e.v), sum(x <= q for x in e.v) / len(e.v)
                assert below - K.rank_error() - 1e-3 <= p <= upto + K.rank_error() + 1e-3


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(1, None, None), (1, None, float("nan"))], "day int, user bigint, v double")
    out = K.estimates(K.merged(K.summaries(rows, F.col("day"), [], distinct="user", value="v"), []), [0.5]).first()
    assert (out.n, out.n_distinct, out.q) == (2, 0, None)
    assert K.summaries(rows.limit(0), F.col("day"), ["day"], value="v").count() == 0
    assert K.rank_error(400) < K.rank_error() < 0.02 and K.distinct_error(14) < K.distinct_error()
