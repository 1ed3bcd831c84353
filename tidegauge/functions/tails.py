"""Tail probabilities of small result tables (STA-01..03).

Spark has no incomplete beta or gamma function. These run on result rows (one per test), never on data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from .shipping import ship_by_value

ship_by_value(__name__)


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if math.isinf(t):
        return 0.0
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def chi_square_upper(x: float, dof: float) -> float:
    """P(X >= x) for chi-square."""
    a, x = dof / 2.0, x / 2.0
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1000):
        top = -i * (i - a)
        b += 2
        d = top * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + top / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _series(fn):
    @F.pandas_udf("double")
    def run(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if pd.isna(a) or pd.isna(b) or b <= 0 else fn(float(a), float(b))
                for a, b in zip(first, second)
            ],
            dtype="float64",
        )

    return run


def student_p(t, df):
    return _series(student_two_sided)(t, df)


def chi_square_p(x, dof):
    return _series(chi_square_upper)(x, dof)


def kolmogorov_p(statistic, n_first, n_second, terms: int = 100):
    """Limit form of the two-sample p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 d^2 nm/(n+m))."""
    lam = statistic * statistic * n_first * n_second / (n_first + n_second)
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam),
    )
    # the alternating series does not settle near zero, where the limit is 1
    return F.when(lam < 0.02, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


# Sample sizes whose product is at most this get the exact two-sample p-value.
EXACT_CELLS = 40_000


def kolmogorov_exact_p(statistic, n_first, n_second):
    """Share of all orders of the two samples whose greatest gap is at least `statistic`, without ties.

    An order is a lattice path from (0, 0) to (n, m); the paths that keep every gap below the statistic are counted along the
    diagonals, each of which needs the one before alone.
    """
    n, m = n_first.cast("bigint"), n_second.cast("bigint")
    limit = F.round(statistic * n * m).cast("bigint")
    none = F.lit(0.0)

    def inside(i, j):
        return j.between(F.lit(0), m) & (F.abs(i * m - j * n) < limit)

    def step(row, s):
        reach = lambda i: F.coalesce(F.get(row, (i - 1).cast("int")), none) + F.get(row, i.cast("int"))
        return F.transform(F.sequence(F.lit(0).cast("bigint"), n), lambda i: F.when(inside(i, s - i), reach(i)).otherwise(none))

    start = F.transform(F.sequence(F.lit(0).cast("bigint"), n), lambda i: F.when((i == 0) & (limit > 0), 1.0).otherwise(none))
    kept = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n + m), start, step, lambda row: F.get(row, n.cast("int")))
    every = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n), F.lit(1.0), lambda acc, k: acc * (m + k) / k)
    return F.greatest(none, F.least(F.lit(1.0), 1.0 - kept / every))


def two_sample_p(statistic, n_first, n_second):
    """Exact for small samples, the limit form beyond; null where a sample is empty."""
    small = (n_first > 0) & (n_second > 0) & (n_first * n_second <= EXACT_CELLS)
    large = (n_first > 0) & (n_second > 0)
    exact = kolmogorov_exact_p(statistic, n_first, n_second)
    return F.when(small, exact).when(large, kolmogorov_p(statistic, n_first, n_second))
