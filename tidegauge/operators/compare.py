"""Equality of two result frames within a tolerance (SET-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import BROADCAST_ROWS, stage_counted

# Rows that share a digest; a difference costs an exact comparison of that many.
LEAF_ROWS = 256


def compare(
    first: DataFrame, second: DataFrame, keys: Sequence[str], values: Sequence[str], *, rtol: float = 1e-9, atol: float = 1e-9
) -> DataFrame:
    """One row: rows on one side only, cells beyond atol + rtol * |second|, and the verdict. Keys must be unique.

    One full outer join on the keys, order-free; nothing is collected.
    """
    a = first.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*[F.col(v).alias(v) for v in values]).alias("_a"))
    b = second.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*[F.col(v).alias(v) for v in values]).alias("_b"))
    on = None
    for k in keys:
        c = a[f"_a_{k}"].eqNullSafe(b[f"_b_{k}"])
        on = c if on is None else on & c
    both = a.join(b, on, "full_outer")
    off = F.lit(0)
    for v in values:
        x, y = F.col(f"_a.{v}"), F.col(f"_b.{v}")
        if dict(first.dtypes)[v] in ("double", "float"):
            same = x.eqNullSafe(y) | (F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))
        else:
            same = x.eqNullSafe(y)
        off = off + F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)
    matched = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    sums = both.agg(
        F.count_if(F.col("_b").isNull()).alias("only_first"),
        F.count_if(F.col("_a").isNull()).alias("only_second"),
        F.coalesce(F.sum(F.when(matched, off)), F.lit(0)).alias("cells_off"),
        F.count(F.lit(1)).alias("rows"),
    )
    good = (F.col("only_first") == 0) & (F.col("only_second") == 0) & (F.col("cells_off") == 0)
    return sums.withColumn("equal", good)


def _cell(c: Column, floating: bool, rtol: float, atol: float) -> Column:
    """A number as a cell at most half as wide as its tolerance: equal cells mean equal within the tolerance."""
    if not floating or not (rtol or atol):
        return c
    x = c.cast("double") + F.lit(0.0)  # one zero
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.lit(float(atol)) + F.lit(float(rtol)) * F.abs(x))) - 1)
    place = x / step
    # where cells are narrower than the numbers' own spacing, the number is its cell
    cell = F.when(F.abs(place) < float(1 << 52), F.floor(place).cast("double")).otherwise(x)
    whole = F.when((step > 0) & (F.abs(x) < float("inf")), F.concat_ws(":", step.cast("string"), cell.cast("string")))
    return F.when(c.isNotNull(), F.coalesce(whole, x.cast("string")))


def leaf_digests(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], leaves: int, *, rtol: float = 1e-9, atol: float = 1e-9
) -> DataFrame:
    """(leaf, n, d1, d2, d3, d4): rows are dealt to leaves by a hash of their keys; a leaf has sums of row digests, in any order.

    Sums are of 32-bit halves, so they don't overflow. Partial sums meet in the shuffle: one row per leaf and task.
    """
    kinds = dict(df.dtypes)
    cells = [_cell(F.col(v), kinds[v] in ("double", "float"), rtol, atol) for v in values]
    marks = F.concat(*[c.isNull().cast("int").cast("string") for c in (*[F.col(k) for k in keys], *cells)])  # hashes skip nulls
    digests = [F.xxhash64(*keys, *cells, marks, F.lit(seed)) for seed in (1, 2)]
    halves = [part for d in digests for part in (F.shiftrightunsigned(d, 32), d.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return df.select(F.pmod(F.xxhash64(*keys), F.lit(leaves)).alias("leaf"), *[h.alias(f"h{i}") for i, h in enumerate(halves, 1)]).groupBy(
        "leaf"
    ).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"h{i}").alias(f"d{i}") for i in range(1, 5)])


def compare_by_digests(
    first: DataFrame, second: DataFrame, keys: Sequence[str], values: Sequence[str], *, rtol: float = 1e-9, atol: float = 1e-9,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The row of `compare`, with `joined_rows`: tables that agree are found equal from digests, without a join of their rows.

    Only the leaves whose digests differ are compared row by row; that decides about numbers that lie within the tolerance but in
    different cells. Two different leaves share both digests with a chance of 2^-128.
    """
    leaves = max(1, first.count() // leaf_rows)
    a, b = (leaf_digests(df, keys, values, leaves, rtol=rtol, atol=atol) for df in (first, second))
    parts = ["n", "d1", "d2", "d3", "d4"]
    both = a.select("leaf", F.struct(*parts).alias("a")).join(b.select("leaf", F.struct(*parts).alias("b")), "leaf", "full_outer")
    leaf, _ = stage_counted(both, "leaf-digests")
    same = F.col("a").eqNullSafe(F.col("b"))
    agreed = leaf.agg(F.coalesce(F.sum(F.when(same, F.col("a.n"))), F.lit(0)).alias("agreed"))
    open_leaves, n = stage_counted(leaf.filter(~same).select("leaf"), "open-leaves")
    if not n:
        zero = F.lit(0).cast("bigint")
        names = ("only_first", "only_second", "cells_off")
        return agreed.select(*[zero.alias(c) for c in names], F.col("agreed").alias("rows"), F.lit(True).alias("equal"), zero.alias("joined_rows"))
    listed = F.broadcast(open_leaves) if n <= BROADCAST_ROWS else open_leaves
    of = lambda df: df.withColumn("_leaf", F.pmod(F.xxhash64(*keys), F.lit(leaves))).join(
        listed.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi"
    )
    found = compare(of(first), of(second), keys, values, rtol=rtol, atol=atol)
    return found.crossJoin(F.broadcast(agreed)).select(  # one row each
        "only_first", "only_second", "cells_off", (F.col("rows") + F.col("agreed")).alias("rows"), "equal", F.col("rows").alias("joined_rows")
    )


def predictions_equal(first: DataFrame, second: DataFrame, key: str, column: str = "prediction") -> DataFrame:
    """Check of a reloaded model: 0 differing predictions (SNK-05)."""
    return compare(first, second, [key], [column])
