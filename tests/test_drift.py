from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.config import MonitorConfig
from tidegauge.functions.tails import chi_square_upper, student_two_sided
from tidegauge.operators import attribution as A
from tidegauge.operators import drift as D
from tidegauge.operators import stats as T

SMALL = {"one_task_rows": 20, "slice_rows": 60}


def psi_of(spark, reference, current, **limits):
    rows = [("reference", v) for v in reference] + [("current", v) for v in current]
    both = spark.createDataFrame([(p, None if v is None else float(v)) for p, v in rows], "period string, v double")
    ordered = D.ordered_values(D.period_value_counts(both, ["v"]), **limits)
    return D.psi(D.psi_bins(ordered, D.numeric_summary(ordered))).first().psi


def brute_psi(reference, current):
    q = np.unique(np.quantile(reference, np.linspace(0, 1, 11)))
    if len(q) == 1:
        edges = q
    elif len(q) < 3:
        edges = [np.median(reference)]
    else:
        edges = q[1:-1]
    share = lambda x: np.bincount(np.searchsorted(edges, x, side="left"), minlength=len(edges) + 1) / len(x)
    r, c = share(np.array(reference)) + 1e-6, share(np.array(current)) + 1e-6
    return float(((c - r) * np.log(c / r)).sum())


def test_same_values(spark):
    assert psi_of(spark, range(1, 501), range(1, 501)) < 1e-8


def test_shifted_values(spark):
    line = np.linspace(10, 100, 1000)
    assert psi_of(spark, line, line * 1.7) >= 0.25


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_psi_against_numpy(spark, limits):
    rng = np.random.default_rng(1)
    r, c = rng.normal(50, 10, 700).round(1), rng.normal(55, 12, 500).round(1)
    assert psi_of(spark, r, c, **limits) == pytest.approx(brute_psi(r, c), abs=1e-12)


@pytest.mark.parametrize("reference,current", [([3, 3, 3], [3, 4, 2]), ([0, 0, 0, 1], [0, 1, 1]), ([0, 1, 5, 5], [5, 1, 2, 9])])
def test_psi_with_few_values(spark, reference, current):
    assert psi_of(spark, reference, current) == pytest.approx(brute_psi(np.array(reference, float), np.array(current, float)), abs=1e-12)


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_ks_against_brute_force(spark, limits):
    rng = random.Random(2)
    r, c = [rng.randint(0, 80) for _ in range(300)], [rng.randint(10, 99) for _ in range(200)]
    both = spark.createDataFrame([("reference", float(v)) for v in r] + [("current", float(v)) for v in c], "period string, v double")
    got = D.numeric_summary(D.ordered_values(D.period_value_counts(both, ["v"]), **limits)).first()
    gap = max(abs(sum(x <= v for x in r) / 300 - sum(x <= v for x in c) / 200) for v in r + c)
    assert got.ks_statistic == pytest.approx(gap)
    assert (got.ref_mean, got.cur_median) == (pytest.approx(np.mean(r)), pytest.approx(np.median(c)))
    assert 0 <= got.ks_pvalue < 1e-3


def test_new_category(spark):
    both = spark.createDataFrame(
        [("reference", x) for x in ["card", "bank"] * 100] + [("current", x) for x in ["card", "wallet"] * 100], "period string, c string"
    )
    cats = D.js_categories(D.period_value_counts(both, ["c"], text=True))
    assert D.js(cats).first().js > 0
    assert [r.value for r in cats.filter("is_new").collect()] == ["wallet"]
    side = lambda p: both.filter(F.col("period") == p)
    assert [r.c for r in D.new_categories(side("reference"), side("current"), "c").collect()] == ["wallet"]


def test_top_value_ties_go_to_the_first_seen(spark):
    both = spark.createDataFrame([("reference", "b", 1), ("reference", "a", 2), ("current", "a", 3)], "period string, c string, pos int")
    assert D.top_values(D.period_value_counts(both, ["c"], text=True, position="pos")).first().ref_top == "b"
    assert D.top_values(D.period_value_counts(both, ["c"], text=True)).first().ref_top == "a"


def sample(spark, rows=400):
    rng = np.random.default_rng(7)
    data = [
        (f"C-{i}", "Female" if i % 2 == 0 else "Male", int(rng.integers(0, 2)), int(rng.integers(1, 73)), float(rng.normal(70, 12)), float(rng.normal(2500, 600)),
         "Month-to-month" if i % 2 == 0 else "Two year", "Electronic check" if i % 3 == 0 else "Credit card", int(rng.integers(1, 9)))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "customer_id string, gender string, senior int, tenure_months int, monthly_charges double, total_charges double, contract string, payment_method string, num_services int")


CONFIG = MonitorConfig(min_group_size=20)


def test_missing_spike_escalates(spark):
    ref = sample(spark)
    missing = spark.createDataFrame([("total_charges", 0.0, 0.08)], "feature string, ref_missing double, cur_missing double")
    rows = {r.feature: r for r in D.detect_drift(ref, ref, CONFIG, missing).collect()}
    assert len(rows) == 8 and rows["total_charges"].status == "danger"
    assert rows["total_charges"].missing_change_pp == pytest.approx(8.0)
    assert rows["gender"].status == "stable" and rows["gender"].score == pytest.approx(0)


def test_order_and_health(spark):
    ref = sample(spark)
    cur = ref.withColumn("monthly_charges", F.col("monthly_charges") * 2).withColumn("gender", F.lit("Female"))
    table = D.detect_drift(ref, cur, CONFIG)
    rows = table.collect()
    assert [r.status for r in rows[:2]] == ["danger", "danger"] and rows[0].score >= rows[1].score
    h = D.health(table, 1).first()
    assert (h.danger, h.health_score, h.overall) == (2, 100 - 36 - 12 - 7 * h.warning, "danger")
    assert D.health(D.detect_drift(ref, ref, CONFIG)).first().overall == "stable"


def both(reference, current):
    return D.two_periods(reference, current)


def test_changed_group_is_found(spark):
    ref = sample(spark, 800)
    cur = ref.withColumn("monthly_charges", F.col("monthly_charges") + F.when(F.col("contract") == "Month-to-month", 45).otherwise(0))
    top = A.explain_shift(both(ref, cur), "monthly_charges", CONFIG, ["contract"]).first()
    assert (top.segment_feature, top.segment, top.direction) == ("contract", "Month-to-month", "increase") and top.within_effect > 0
    causes = A.explain_shift(both(ref, cur), "monthly_charges", CONFIG).collect()
    assert len(causes) == 6 and 0 < sum(c.contribution for c in causes) <= 1
    report = A.root_cause_report(both(ref, cur), D.detect_drift(ref, cur, CONFIG), CONFIG)
    assert report.first().target == "monthly_charges"


def test_tiny_groups_are_left_out(spark):
    ref = sample(spark, 200).withColumn("payment_method", F.when(F.col("customer_id").isin("C-0", "C-1", "C-2", "C-3", "C-4"), "Rare").otherwise(F.col("payment_method")))
    causes = A.explain_shift(both(ref, ref), "monthly_charges", CONFIG, ["payment_method"]).collect()
    assert causes and all(c.segment != "Rare" for c in causes) and causes[0].direction == "stable"


def test_constant_segment_is_one_open_bin(spark):
    ref = sample(spark).withColumn("num_services", F.lit(3))
    causes = A.explain_shift(both(ref, ref), "monthly_charges", CONFIG, ["num_services"]).collect()
    assert [(c.segment, c.reference_count) for c in causes] == [("(-inf, inf]", 400)]


def test_tail_probabilities():
    assert student_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert student_two_sided(1.0, 1) == pytest.approx(0.5)
    assert student_two_sided(0.0, 5) == 1.0
    for x in (0.5, 3.0, 20.0):
        assert chi_square_upper(x, 2) == pytest.approx(math.exp(-x / 2))
    assert chi_square_upper(3.841458821, 1) == pytest.approx(0.05, abs=1e-9)


def test_welch_leaves_out_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, None), (0, 2.0), (0, float("nan")), (0, 6.0), (0, 9.0)], "y int, x double")
    r = T.welch_t(df, "x", F.col("y") == 1, F.col("y") == 0).first()
    a, b = np.array([1, 2, 4.0]), np.array([2, 6, 9.0])
    se = a.var(ddof=1) / 3 + b.var(ddof=1) / 3
    assert r.statistic == pytest.approx((a.mean() - b.mean()) / math.sqrt(se))
    assert (r.n_first, r.n_second) == (3, 3) and 0 < r.pvalue < 1


def test_chi_square_forms(spark):
    long = lambda cells: spark.createDataFrame([(str(i), str(j), n) for i, row in enumerate(cells) for j, n in enumerate(row) if n], "a string, b string, n bigint")

    def brute(cells):
        o = np.array(cells, float)
        e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
        gap = np.abs(o - e)
        if o.shape == (2, 2):
            gap = gap - np.minimum(0.5, gap)
        return (gap**2 / e).sum()

    for cells in ([[10, 20], [30, 5]], [[10, 0], [3, 5]], [[10, 20, 3], [0, 5, 9]], [[4, 4], [4, 4]]):
        r = T.chi_square(long(cells), "a", "b").first()
        assert r.statistic == pytest.approx(brute(cells)) and r.dof == (len(cells) - 1) * (len(cells[0]) - 1)
    assert T.chi_square(long([[3, 4]]), "a", "b").first().pvalue == 1.0
