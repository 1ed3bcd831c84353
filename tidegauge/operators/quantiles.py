"""Exact quantiles of any size (AGG-19, AGG-20, AGG-37) and value counts they are read from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import running_totals


def value_counts(
    df: DataFrame, value: str | Column, keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """(keys, value, n) with map-side partial counts; missing values are left out."""
    column = F.col(value) if isinstance(value, str) else value
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.select(*keys, column.cast("double").alias("value"), *([weight] if weight else []))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys, "value")
        .agg(n.cast("bigint").alias("n"))
    )


def stacked_values(df: DataFrame, columns: dict[str, Column], keys: Sequence[Column] = ()) -> DataFrame:
    """Long form (keys, feature, value) of several columns in one scan; an Expand in front of the partial counts."""
    wide = df.select(*keys, *[c.cast("double").alias(name) for name, c in columns.items()])
    ids = wide.columns[: len(keys)]
    return wide.unpivot(ids, list(columns), "feature", "value")


def quantiles_of_counts(
    counts: DataFrame,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    *,
    method: str = "linear",
    rows: int | None = None,
    **limits,
) -> DataFrame:
    """Quantiles per key from (keys, value, n): columns keys, `q` (array in the order of probs), `n`.

    `linear` interpolates between neighbours; `nearest` takes the value of rank ceil(p * n). Both are exact. The
    work is ordered by `running_totals`, so neither the number of distinct values nor one huge key is a limit.
    """
    placed = running_totals(counts, keys, ["value"], ["n"], rows=rows, **limits)
    picks, q = quantile_picks(probs, "n", method=method)
    found = placed.groupBy(*keys).agg(*picks)
    return found.select(*keys, q.alias("q"), F.coalesce(F.col("_n_size"), F.lit(0)).cast("bigint").alias("n"))


def quantile_picks(probs: Sequence[float], n: str, *, method: str = "linear") -> tuple[list[Column], Column]:
    """Quantiles of a table ordered by `running_totals`, weighted by its column `n`.

    Returns the aggregates that pick the values at the wanted ranks, and the array of quantiles over their results. No
    further ordering is needed, so one ordered table serves any number of quantiles and weights.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"unknown quantile method: {method}")
    first, total = F.col(f"{n}_before"), F.col(f"{n}_total")
    after = first + F.col(n)
    size = F.col(f"_{n}_size")

    def value_at(rank: Column, name: str) -> Column:
        return F.max(F.when((first <= rank) & (rank < after), F.col("value"))).alias(f"_{n}_{name}")

    picks, values = [F.max(f"{n}_total").alias(f"_{n}_size")], []
    for i, p in enumerate(probs):
        if method == "nearest":
            picks.append(value_at(F.greatest(F.ceil(total * F.lit(float(p))) - 1, F.lit(0)), f"at{i}"))
            values.append(F.col(f"_{n}_at{i}"))
            continue
        spot = (total - 1) * F.lit(float(p))
        picks += [value_at(F.floor(spot), f"lo{i}"), value_at(F.ceil(spot), f"hi{i}")]
        low, high, where = F.col(f"_{n}_lo{i}"), F.col(f"_{n}_hi{i}"), (size - 1) * F.lit(float(p))
        values.append(low + (high - low) * (where - F.floor(where)))
    return picks, F.array(*values)


def quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    *,
    method: str = "linear",
    accuracy: int | None = None,
    **limits,
) -> DataFrame:
    """Quantiles of a column per key. Exact by default; `accuracy` asks for Spark's bounded-size sketch instead."""
    if accuracy is not None:
        column = F.col(value) if isinstance(value, str) else value
        sketch = F.percentile_approx(column.cast("double"), [float(p) for p in probs], accuracy)
        return df.groupBy(*keys).agg(sketch.alias("q"), F.count(column).alias("n"))
    return quantiles_of_counts(value_counts(df, value, keys), probs, keys, method=method, **limits)
