"""Summaries merged from partial states equal the full ones after every batch; exact two-sample p-values."""

from __future__ import annotations

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from test_keyed import EVENT, feed
from tidegauge.functions.tails import two_sample_p
from tidegauge.operators import attempts as A
from tidegauge.operators import incremental as N
from tidegauge.operators import ingest as I
from tidegauge.operators.stats import ks_by_group

LOG = "sequence bigint, run_id string, phase string, event_type string, elapsed_ms double, item_id bigint, attempt int, detail string"


def log_rows(n=240, seed=3):
    rng = random.Random(seed)
    tried, rows = {}, []
    for i in range(n):
        run, item = rng.choice("abc"), rng.choice([*range(12), None])
        tried[run, item] = tried.get((run, item), 0) + 1
        phase = rng.choice(N.PHASES) if item is not None else "control"
        kind = rng.choice(["request_failed", "request_succeeded", "validation_failed"]) if item is not None else "batch_started"
        rows.append((i, run, phase, kind, float(i * 10 + rng.random()), item, tried[run, item], "{}"))
    return rows


def sorted_rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_run_summaries_after_every_batch(spark, tmp_path):
    rows = log_rows()
    rng = random.Random(4)
    dealt = [(r, rng.randrange(3)) for r in rows]
    for step, batch in enumerate((1, 2, 0)):
        part = spark.createDataFrame([r for r, b in dealt if b == batch], LOG)
        N.add_attempts(part, f"{tmp_path}/s", batch)
        if step == 1:
            N.add_attempts(part, f"{tmp_path}/s", batch)  # the batch runs again
        so_far = spark.createDataFrame([r for r, b in dealt if b in (1, 2, 0)[: step + 1]], LOG)
        merged, full = N.run_summaries(spark, f"{tmp_path}/s"), A.run_summary(so_far)
        assert set(merged.columns) == set(full.columns) and sorted_rows(merged) == sorted_rows(full)
    one = N.run_summaries(spark, f"{tmp_path}/s", ["b"])
    assert sorted_rows(one) == [r for r in sorted_rows(full) if "b" in r]
    assert sorted(N.touched_runs(spark, f"{tmp_path}/s", 0)) == sorted({r[1] for r, b in dealt if b == 0})


def test_intake_summary_with_replay(spark, tmp_path):
    _, texts = feed(spark, 60)
    routed = I.route(spark.createDataFrame(texts, EVENT))
    for batch in (2, 0, 2, 1):
        N.add_routed(I.without_replay(routed.filter(F.col("seq") % 3 == batch)), f"{tmp_path}/i", batch)
    before, plain = N.intake_summary(spark, f"{tmp_path}/i").first(), I.ingest_summary(I.without_replay(routed)).first()
    assert before.asDict() == plain.asDict()
    for _ in range(2):
        N.add_replayed(routed.filter("outcome = 'dlq'"), f"{tmp_path}/i", 1)
    assert N.intake_summary(spark, f"{tmp_path}/i").first().asDict() == I.ingest_summary(routed).first().asDict()


def brute(n, m, gap):
    """Share of all orders of n and m values with a gap of at least `gap` / (n m)."""
    hits = 0
    for firsts in combinations(range(n + m), n):
        chosen, i, j, most = set(firsts), 0, 0, 0
        for at in range(n + m):
            i, j = i + (at in chosen), j + (at not in chosen)
            most = max(most, abs(i * m - j * n))
        hits += most >= gap
    return hits / math.comb(n + m, n)


def test_exact_p_against_all_orders(spark):
    cases = [(n, m, g) for n in (1, 2, 3, 5, 8) for m in (1, 4, 7, 8) for g in {1, n * m // 3, n * m // 2, n * m} if g > 0]
    rows = spark.createDataFrame([(float(n), float(m), g, g / (n * m)) for n, m, g in cases], "n double, m double, g int, d double")
    for r in rows.withColumn("p", two_sample_p(F.col("d"), F.col("n"), F.col("m"))).collect():
        assert r.p == pytest.approx(brute(int(r.n), int(r.m), r.g), abs=1e-12)


def test_exact_and_limit_form_meet(spark):
    rows = spark.createDataFrame([(200.0, 200.0, 0.1), (200.0, 201.0, 0.1), (150.0, 260.0, 0.15), (0.0, 5.0, None), (3.0, 3.0, 0.0)], "n double, m double, d double")
    got = [r.p for r in rows.withColumn("p", two_sample_p(F.col("d"), F.col("n"), F.col("m"))).collect()]
    assert abs(got[0] - got[1]) < 0.05 and 0 < got[2] < 0.1 and got[3] is None and got[4] == 1.0


@pytest.mark.parametrize("limits", [{}, {"one_task_rows": 10, "slice_rows": 20}])
def test_ks_by_group(spark, limits):
    rng = random.Random(6)
    rows = [(g, rng.choice([True, False, False]), rng.choice([None, float("nan"), *map(float, range(9))])) for g in "hhhhhxy" for _ in range(30)]
    rows += [("one side", True, 1.0), (None, True, 1.0), (None, False, 2.0)]
    df = spark.createDataFrame(rows, "g string, f boolean, x double")
    got = {r.g: r for r in ks_by_group(df, ["g"], "x", F.col("f"), ~F.col("f"), **limits).collect()}
    assert got["one side"].statistic is None and got["one side"].pvalue is None and (got[None].statistic, got[None].pvalue) == (1.0, 1.0)
    for g in "hxy":
        first, second = ([x for k, f, x in rows if k == g and f is side and x is not None and x == x] for side in (True, False))
        gap = max(abs(sum(x <= v for x in first) / len(first) - sum(x <= v for x in second) / len(second)) for v in range(9))
        assert (got[g].n_first, got[g].n_second) == (len(first), len(second)) and got[g].statistic == pytest.approx(gap)
