"""Stored, mergeable summaries per period: distinct values (AGG-09) and quantiles (AGG-19) of any span without the rows.

A period's rows are read once; what is kept of them is one row per key and period, some kilobytes whatever the period held. Any span
of periods, and any coarser grouping, is answered by merging rows. Results are estimates with stated errors, for tables that grow
beside the exact operators, which they don't replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers as a power of two, and the size parameter of the quantile sketch.
HLL_BITS = 12
KLL_SIZE = 200


def distinct_error(bits: int = HLL_BITS) -> float:
    """Relative standard error of a distinct count with 2**bits registers."""
    return 1.04 / 2 ** (bits / 2)


def rank_error(size: int = KLL_SIZE) -> float:
    """Bound of the error of a rank, as a share of all rows, that holds with 99 % confidence for one quantile."""
    return 2.296 / size**0.9723


def summaries(
    df: DataFrame, period: Column, keys: Sequence[str], *, distinct: str | None = None, value: str | None = None,
    bits: int = HLL_BITS, size: int = KLL_SIZE,
) -> DataFrame:
    """(period, keys, n[, distinct_sketch][, value_sketch]): one row per period and key; nulls are in `n` alone.

    Spark merges partial sketches before the shuffle, so a key with a third of all rows is a few kilobytes per task.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    if distinct is not None:
        parts.append(F.hll_sketch_agg(F.col(distinct), F.lit(bits)).alias("distinct_sketch"))
    if value is not None:
        number = F.col(value).cast("double")
        parts.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(size)).alias("value_sketch"))
    return df.groupBy(period.alias("period"), *keys).agg(*parts)


def merged(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries of all given rows by coarser keys (none: one row)."""
    parts = [F.sum("n").alias("n")]
    if "distinct_sketch" in stored.columns:
        parts.append(F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))
    if "value_sketch" in stored.columns:
        parts.append(F.kll_merge_agg_double("value_sketch").alias("value_sketch"))
    return stored.groupBy(*keys).agg(*parts)


def estimates(summed: DataFrame, quantiles: Sequence[float] = ()) -> DataFrame:
    """Add `n_distinct` and `q`, the quantiles in the order asked for, to summaries; q is null where there is no value."""
    out = summed
    if "distinct_sketch" in out.columns:
        out = out.withColumn("n_distinct", F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).cast("bigint"))
    if "value_sketch" in out.columns and quantiles:
        held = F.kll_sketch_get_n_double("value_sketch") > 0
        at = [F.kll_sketch_get_quantile_double("value_sketch", F.lit(float(q))) for q in quantiles]
        out = out.withColumn("q", F.when(held, F.array(*at)))
    return out.drop("distinct_sketch", "value_sketch")


def store(df: DataFrame, folder: str) -> None:
    """Write the summaries of some periods; a period that is written again is replaced, so a repeated run counts nothing twice."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(folder)
