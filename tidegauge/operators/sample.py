"""Seeded sampling (SMP-01..03, PRJ-09).

Rows are ordered by a hash of seed and key, so the same rows are chosen in every run and after any lost task. The cut is
found by radix descent: counts per hash prefix name the stretch that holds it, counts of longer prefixes within that stretch
name a smaller one, until it is short enough to be ranked. Each step reads two columns; no row is shuffled but those of the
last stretch, so what one task ranks is bounded however large the table is.

Rows that repeat a key have one place in the order: they are chosen or left together, so a sample may be larger than
asked for by the repetitions of its last key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_even, hash_text, unit_value
from ..functions.text import numbered
from .scale import carry_forward, lookup, running_totals, stage_counted

PREFIX_DIGITS = 4  # 65,536 prefixes at each step
HASH_DIGITS = 32
# Rows of a stretch that one task may rank.
RANK_ROWS = 100_000
# Draws of a row that one task may make in the one-pass resample.
CHUNK_DRAWS = 100_000
# A Poisson draw of a larger mean is a sum of draws of at most this mean; no draw of it has a chance of reaching POISSON_TOP.
POISSON_MEAN = 8.0
POISSON_TOP = 64


def _stretches(hashed: DataFrame, strata: list[str], digits: int, held: DataFrame | None, step: int, n_held: int) -> DataFrame:
    """Counts of the next `step` digits: of all rows at first, then of those in the stretches `held` (strata, _prefix, _rest)."""
    longer = F.substring("_h", 1, digits).alias("_prefix")
    if held is None:
        return hashed.groupBy(*strata, longer).agg(F.count(F.lit(1)).alias("_n"))
    inside = lookup(
        hashed.withColumn("_prefix", F.substring("_h", 1, digits - step)), held, [*strata, "_prefix"], table_rows=n_held
    ).filter(F.col("_rest").isNotNull())
    return inside.groupBy(*strata, longer, "_rest").agg(F.count(F.lit(1)).alias("_n"))


def _thresholds(
    df: DataFrame, strata: Sequence[str], key: str, seed: int, size: Column, *, rank_rows: int = RANK_ROWS, step: int = PREFIX_DIGITS
) -> tuple[DataFrame, int]:
    """(strata, _cut): the last (hash, key) that belongs to the sample; null where the sample is empty.

    `size` is the wanted number of rows, an expression over the stratum's row count `n`.
    """
    strata = list(strata)
    hashed = df.select(*strata, hash_text(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    cuts, n_cuts, digits = None, 0, 0
    while True:
        digits += step
        # at most 65,536 rows per stratum, ordered exactly; beyond one task's rows they are cut by range
        placed = running_totals(_stretches(hashed, strata, digits, cuts, step, n_cuts), strata, ["_prefix"], ["_n"])
        wanted = F.col("_rest") if cuts is not None else size.cast("bigint")
        placed = placed.withColumn("n", F.col("_n_total")).withColumn("_size", wanted)
        inside = (F.col("_n_before") < F.col("_size")) & (F.col("_size") <= F.col("_n_before") + F.col("_n"))
        rest = (F.col("_size") - F.col("_n_before")).alias("_rest")
        cuts, n_cuts = stage_counted(placed.filter(inside).select(*strata, "_prefix", rest, "_n"), "cuts")
        longest = cuts.agg(F.max("_n")).first()[0]
        if longest is None or longest <= rank_rows or digits + step > HASH_DIGITS:
            break
        cuts = cuts.drop("_n")
    rows = lookup(
        hashed.withColumn("_prefix", F.substring("_h", 1, digits)), cuts, [*strata, "_prefix"], table_rows=n_cuts
    ).filter(F.col("_rest").isNotNull())
    by = [*strata, "_prefix"]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h", "_k"))
    last = rows.filter(F.col("_n") <= rank_rows).withColumn("_rank", rank).filter(F.col("_rank") == F.col("_rest"))
    ends = last.select(*strata, F.struct("_h", "_k").alias("_cut"))
    if longest is not None and longest > rank_rows:
        # a stretch that is still too long is one key, repeated
        whole = rows.filter(F.col("_n") > rank_rows).groupBy(*by).agg(F.max(F.struct("_h", "_k")).alias("_cut"))
        ends = ends.unionByName(whole.select(*strata, "_cut"))
    return stage_counted(ends, "thresholds")


def _chosen(df: DataFrame, strata: Sequence[str], key: str, seed: int, size: Column, out: str, **limits) -> DataFrame:
    cuts, n = _thresholds(df, strata, key, seed, size, **limits)
    place = F.struct(hash_text(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"))
    if strata:
        joined = lookup(df, cuts, list(strata), table_rows=n)
        return joined.withColumn(out, F.coalesce(place <= F.col("_cut"), F.lit(False))).drop("_cut")
    cut = cuts.select("_cut").scalar()
    return df.withColumn(out, F.coalesce(place <= cut, F.lit(False)))


def stratified_split(
    df: DataFrame, strata: Sequence[str], key: str, fraction: float, seed: int, out: str = "chosen", **limits
) -> DataFrame:
    """Mark round(fraction * n) rows of every stratum (SMP-01). No row is shuffled for it."""
    return _chosen(df, strata, key, seed, half_even(F.col("n") * F.lit(float(fraction))), out, **limits)


def exact_subset(df: DataFrame, key: str, fraction: float, seed: int, out: str = "chosen", at_least: int = 0, **limits) -> DataFrame:
    """Mark exactly max(at_least, floor(fraction * n)) rows (SMP-03)."""
    size = F.least(F.greatest(F.floor(F.col("n") * F.lit(float(fraction))), F.lit(at_least)), F.col("n"))
    return _chosen(df, [], key, seed, size, out, **limits)


def set_on_subset(df: DataFrame, key: str, fraction: float, seed: int, column: str, value: Column, at_least: int = 0) -> DataFrame:
    """Overwrite a column on an exact-size random subset."""
    marked = exact_subset(df, key, fraction, seed, "_chosen", at_least)
    return marked.withColumn(column, F.when(F.col("_chosen"), value).otherwise(F.col(column))).drop("_chosen")


def weighted_resample(df: DataFrame, key: str, weight: Column, seed: int, *, new_id: str | None = None, template: str = "CUR-%05d", **limits) -> DataFrame:
    """As many rows as the input, drawn with replacement in proportion to weight (SMP-02).

    Rows lie one after another on an axis as long as the total weight; draws are uniform points on it. Points and rows are
    put in one order and every point takes the row it falls on, so a row with a third of the weight is one entry, not a
    hot join key. Adds `draw` (0-based).
    """
    spark = df.sparkSession
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(key).alias("_key"), weight.cast("double").alias("_w"))
    weighted, n_weighted = stage_counted(rows, "weighted")
    axis = running_totals(weighted.filter(F.col("_w") > 0), [], ["_key"], ["_w"], rows=n_weighted, **limits)
    total = weighted.agg(F.sum(F.when(F.col("_w") > 0, F.col("_w")))).first()[0]
    none = F.lit(None)
    starts = axis.select(
        F.col("_w_before").cast("double").alias("_pos"), F.lit(0).alias("_side"), F.lit(-1).cast("bigint").alias("draw"), "_row"
    )
    draws = spark.range(n_weighted).select(
        (unit_value(seed, F.col("id")) * F.lit(total)).alias("_pos"),
        F.lit(1).alias("_side"),
        F.col("id").alias("draw"),
        none.cast(starts.schema["_row"].dataType).alias("_row"),
    )
    met = carry_forward(starts.unionByName(draws), ["_pos", "_side", "draw"], "_row", "_hit", rows=2 * n_weighted, **limits)
    out = met.filter(F.col("_side") == 1).select("draw", "_hit.*")
    return out.withColumn(new_id, numbered(template, F.col("draw"))) if new_id else out


def poisson_draws(mean: Column, seed: int, *keys: Column) -> Column:
    """A Poisson number of a mean of at most POISSON_MEAN, by inverting its distribution at a repeatable uniform value."""
    u = unit_value(seed, *keys)
    # (probability of k, of at most k, how many k lie below u)
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("upto"), F.lit(0).cast("bigint").alias("n"))

    def add(at: Column, k: Column) -> Column:
        p = at["p"] * mean / k
        return F.struct(p.alias("p"), (at["upto"] + p).alias("upto"), (at["n"] + (u >= at["upto"]).cast("bigint")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(POISSON_TOP)), start, add, lambda at: at["n"])


def poisson_counts(mean: Column, key: Column, seed: int, times: int) -> Column:
    """`times` independent Poisson numbers of any mean per row, the same for the same seed and (long) key in every run."""

    @F.pandas_udf("array<bigint>")
    def draw(means: pd.Series, keys: pd.Series) -> pd.Series:
        streams = (np.random.default_rng([seed % 2**64, int(k) % 2**64]) for k in keys)
        return pd.Series([r.poisson(m, times) for r, m in zip(streams, means)], dtype=object)

    return draw(mean, key)


def poisson_resample(
    df: DataFrame, key: str, weight: Column, seed: int, *, copy: str = "copy", chunk_draws: int = CHUNK_DRAWS
) -> DataFrame:
    """Each row a Poisson number of times, with n · weight / total weight expected: the one-pass form of SMP-02.

    The result has as many rows as the input on average, not exactly; rows are drawn independently, so nothing is ordered,
    joined or shuffled, and a lost task draws the same rows again. Adds `copy` (0-based within the row). Rows without a
    positive weight are not drawn. A row of very large weight is spread over tasks, `chunk_draws` expected draws each. The key
    should be unique: rows that repeat it are drawn equally often.
    """
    given = F.coalesce(weight.cast("double"), F.lit(0.0))
    positive = F.when(given > 0, given).otherwise(F.lit(0.0))
    total = df.agg(F.sum(positive).alias("w"), F.count(F.lit(1)).alias("n")).first()
    if not total.w:
        return df.limit(0).withColumn(copy, F.lit(0).cast("bigint"))
    names = df.columns
    rows = df.select(F.struct(*names).alias("_row"), F.col(key).alias("_key"), (positive * F.lit(total.n / total.w)).alias("_mean"))
    rows = rows.filter(F.col("_mean") > 0).withColumn("_parts", F.greatest(F.ceil(F.col("_mean") / POISSON_MEAN), F.lit(1)).cast("bigint"))
    per_chunk = max(1, int(chunk_draws / POISSON_MEAN))
    first = lambda c: F.col(c) * F.lit(per_chunk)
    chunked = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_parts") - 1) / per_chunk))))
    light = chunked.filter(F.col("_parts") <= per_chunk)
    heavy = chunked.filter(F.col("_parts") > per_chunk).repartition("_key", "_chunk")
    parts = light.unionByName(heavy).withColumn(
        "_part", F.explode(F.sequence(first("_chunk"), F.least(first("_chunk") + per_chunk, F.col("_parts")) - 1))
    )
    drawn = parts.withColumn("_times", poisson_draws(F.col("_mean") / F.col("_parts"), seed, F.col("_key"), F.col("_part")))
    each = drawn.filter(F.col("_times") > 0).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1)))
    return each.select(*[F.col("_row")[n].alias(n) for n in names], (F.col("_part") * POISSON_TOP + F.col("_i")).alias(copy))
