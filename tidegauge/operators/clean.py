"""Cleaning recipes (CLN-01..05, WIN-01, JN-05).

All statistics of a recipe come from one scan: a staged table of value counts (feature, grp, value, n). Medians over
already filled columns and the quartiles behind the fences are read from the same counts, without touching the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import from_micros, micros, mixed_timestamp
from ..functions.numeric import clip, fill, positive_or_null, text_to_number, to_number
from ..functions.text import strip
from ..sources.gates import require_columns
from .profile import missing_cells
from .quantiles import quantiles_of_counts, stacked_values
from .scale import lookup, stage_counted

# The columns the two sales recipes need.
SALES_COLUMNS = ("order_id", "order_date", "region", "category", "quantity", "unit_price", "discount")
REPORT_COLUMNS = ("order_id", "category", "region", "unit_price", "quantity", "discount")
UNKNOWN = "Unknown"


class FillStatistics:
    """Value counts of some columns, with missing values counted under a null value; fails on an empty input."""

    def __init__(self, df: DataFrame, columns: dict[str, Column], group: Column, grouped: Sequence[str], **limits):
        long = stacked_values(df.withColumn("_grp", group), columns, [F.col("_grp").alias("grp")])
        # only the group-filled columns need the group, the counts of the others stay shorter without it
        own_group = F.when(F.col("feature").isin(*grouped), F.col("grp"))
        counts = long.groupBy("feature", own_group.alias("grp"), "value").agg(F.count(F.lit(1)).alias("n"))
        self.counts, self.rows = stage_counted(counts, "fill-counts")
        # every row gives counts, null values too; asking the input itself would run its joins once more
        if not self.rows:
            raise ValueError("there is no data to work on")
        self.limits = limits

    def _quantiles(self, counts: DataFrame, probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
        merged = counts.filter(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.sum("n").alias("n"))
        return quantiles_of_counts(merged, probs, keys, rows=self.rows, **self.limits)

    def group_medians(self, features: Sequence[str]) -> tuple[DataFrame, int]:
        """(feature, grp, median) and a bound of its row count."""
        medians = self._quantiles(self.counts.filter(F.col("feature").isin(*features)), [0.5], ["feature", "grp"])
        staged, n = stage_counted(medians.select("feature", "grp", F.col("q")[0].alias("median")), "medians")
        return staged, n

    def fill_groups(self, medians: DataFrame, n_medians: int) -> DataFrame:
        """The counts as they stand once missing values took their group's median."""
        filled = lookup(self.counts, medians, ["feature", "grp"], table_rows=n_medians)
        return filled.withColumn("value", F.coalesce("value", "median")).drop("median")

    def quantile_values(self, counts: DataFrame, probs: Sequence[float]) -> dict[str, list[float]]:
        """Per feature; a handful of numbers, read to the driver."""
        rows = self._quantiles(counts, probs, ["feature"]).collect()
        return {r["feature"]: list(r["q"]) for r in rows}

    @staticmethod
    def with_constant(counts: DataFrame, values: dict[str, float]) -> DataFrame:
        """The counts once what is still missing took a constant per feature."""
        constant = F.lit(None).cast("double")
        for name, v in values.items():
            constant = F.when(F.col("feature") == name, F.lit(v)).otherwise(constant)
        return counts.withColumn("value", F.coalesce("value", constant))


def group_fill(
    df: DataFrame, columns: Sequence[str], group: str, medians: DataFrame, n_medians: int
) -> DataFrame:
    """Fill missing values with the median of their group (WIN-01).

    The group table is small next to the rows; it is broadcast after its size was read, or joined with salted hot keys.
    """
    wide = medians.groupBy("grp").agg(
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_median_{c}") for c in columns]
    )
    joined = lookup(df, wide.withColumnRenamed("grp", group), [group], table_rows=n_medians)
    for c in columns:
        joined = joined.withColumn(c, F.coalesce(c, f"_median_{c}"))
    return joined.drop(*[f"_median_{c}" for c in columns])


def fences(q1: float, q3: float, factor: float = 1.5, minimum: float | None = None) -> tuple[float, float]:
    """IQR fences; the lower one never below `minimum`."""
    spread = q3 - q1
    low, high = q1 - factor * spread, q3 + factor * spread
    return (low if minimum is None else max(low, minimum)), high


def winsorize_bounds(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, minimum: float | None = None, **limits
) -> DataFrame:
    """(feature, q1, q3, lower, upper) of several columns from one scan (CLN-01)."""
    long = stacked_values(df, {c: F.col(c) for c in columns})
    counts = (
        long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    q = quantiles_of_counts(counts, [0.25, 0.75], ["feature"], **limits)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    low = q1 - F.lit(factor) * (q3 - q1)
    return q.select(
        "feature",
        q1.alias("q1"),
        q3.alias("q3"),
        (F.greatest(low, F.lit(float(minimum))) if minimum is not None else low).alias("lower"),
        (q3 + F.lit(factor) * (q3 - q1)).alias("upper"),
    )


def winsorize(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, minimum: float | None = None, **limits
) -> DataFrame:
    """Clip columns to their IQR fences."""
    bounds = winsorize_bounds(df, columns, factor, minimum, **limits).collect()  # one row per column
    by_name = {r["feature"]: r for r in bounds}
    return df.select(
        *[
            clip(F.col(c), by_name[c]["lower"], by_name[c]["upper"]).alias(c) if c in by_name else F.col(c)
            for c in df.columns
        ]
    )


def with_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("quantity") * F.col("unit_price") * (1 - F.col("discount")))


def _number(df: DataFrame, name: str) -> Column:
    """Number or null of a column, by the cheaper way if it is text."""
    is_text = df.schema[name].dataType == T.StringType()  # not another collation, whose order differs
    return text_to_number(F.col(name)) if is_text else to_number(F.col(name))


def typed_sales(raw: DataFrame) -> DataFrame:
    """Coerced sales columns; nothing filled yet except discount."""
    return raw.select(
        *[
            {
                "order_date": mixed_timestamp(F.col("order_date")).alias("order_date"),
                "quantity": _number(raw, "quantity").alias("quantity"),
                "unit_price": _number(raw, "unit_price").alias("unit_price"),
                "discount": clip(fill(_number(raw, "discount"), 0.0), 0.0, 1.0).alias("discount"),
                "category": fill(F.col("category"), UNKNOWN).alias("category"),
                "region": fill(F.col("region"), UNKNOWN).alias("region"),
            }.get(c, F.col(c))
            for c in raw.columns
        ]
    )


def clean_sales(raw: DataFrame, **limits) -> tuple[DataFrame, dict]:
    """Recipe A: keep every row, fill, winsorize, add amount. Returns the rows and the fences used."""
    require_columns(raw, SALES_COLUMNS)
    typed = typed_sales(raw).withColumn("unit_price", positive_or_null(F.col("unit_price")))
    stats = FillStatistics(
        typed,
        {"unit_price": F.col("unit_price"), "quantity": F.col("quantity"), "order_date": micros(F.col("order_date"))},
        F.col("category"),
        ["unit_price"],
        **limits,
    )
    medians, n_medians = stats.group_medians(["unit_price"])
    grouped = stats.fill_groups(medians, n_medians)
    fallback = {k: q[0] for k, q in stats.quantile_values(grouped, [0.5]).items()}
    if "order_date" not in fallback:
        raise ValueError("there is no valid order date")
    if "unit_price" not in fallback or "quantity" not in fallback:
        raise ValueError("there is no usable price or quantity to fill with")
    filled = stats.with_constant(grouped, fallback).filter(F.col("feature") != "order_date")
    quartiles = stats.quantile_values(filled, [0.25, 0.75])
    price = fences(*quartiles["unit_price"], minimum=0.0)
    quantity = fences(*quartiles["quantity"], minimum=0.0)

    rows = group_fill(typed, ["unit_price"], "category", medians, n_medians)
    clean = rows.select(
        *[
            {
                "order_date": fill(F.col("order_date"), from_micros(F.lit(fallback["order_date"]))).alias(c),
                "unit_price": clip(fill(F.col("unit_price"), fallback["unit_price"]), *price).alias(c),
                "quantity": clip(fill(F.col("quantity"), fallback["quantity"]), *quantity).alias(c),
            }.get(c, F.col(c))
            for c in raw.columns
        ]
    )
    return with_amount(clean), {"price_bounds": price, "quantity_bounds": quantity}


def sales_metrics(raw: DataFrame, clean: DataFrame, bounds: dict) -> DataFrame:
    """Before/after row of recipe A (CLN-05)."""
    before = raw.agg(
        F.struct(
            missing_cells(raw, list(SALES_COLUMNS)).alias("missing"),
            F.max(_number(raw, "unit_price")).alias("price"),
            F.max(_number(raw, "quantity")).alias("quantity"),
        ).alias("b")
    ).scalar()
    after = clean.agg(
        F.count(F.lit(1)).alias("rows"),
        missing_cells(clean).alias("missing_after"),
        F.max("unit_price").alias("max_price_after"),
        F.max("quantity").alias("max_quantity_after"),
        F.sum("amount").alias("total_sales"),
    )
    return after.select(
        "rows",
        before["missing"].alias("missing_before"),
        "missing_after",
        before["price"].alias("max_price_before"),
        "max_price_after",
        before["quantity"].alias("max_quantity_before"),
        "max_quantity_after",
        F.lit(bounds["price_bounds"][0]).alias("price_lower"),
        F.lit(bounds["price_bounds"][1]).alias("price_upper"),
        F.lit(bounds["quantity_bounds"][0]).alias("quantity_lower"),
        F.lit(bounds["quantity_bounds"][1]).alias("quantity_upper"),
        "total_sales",
    )


def report_sales(raw: DataFrame, **limits) -> DataFrame:
    """Recipe B: fill from medians that include negative prices, then drop rows without positive price and quantity."""
    require_columns(raw, REPORT_COLUMNS)
    typed = typed_sales(raw.select(*REPORT_COLUMNS))
    stats = FillStatistics(
        typed, {"unit_price": F.col("unit_price"), "quantity": F.col("quantity")}, F.col("category"), ["unit_price"], **limits
    )
    medians, n_medians = stats.group_medians(["unit_price"])
    fallback = {k: q[0] for k, q in stats.quantile_values(stats.fill_groups(medians, n_medians), [0.5]).items()}
    rows = group_fill(typed, ["unit_price"], "category", medians, n_medians)
    for c in ("unit_price", "quantity"):
        rows = rows.withColumn(c, fill(F.col(c), F.lit(fallback.get(c)).cast("double")))
    kept = rows.filter((F.col("unit_price") > 0) & (F.col("quantity") > 0))
    return with_amount(kept)


def clean_customers(
    raw: DataFrame,
    *,
    required: Sequence[str],
    numeric: Sequence[str],
    texts: Sequence[str],
    target: str,
    grouped: str,
    group: str,
    **limits,
) -> DataFrame:
    """Recipe C: coerce, trim, fill with the group median (one column) and the overall medians; hides no drift.

    Nothing is clipped or dropped; the target is coerced and left unfilled. Pair it with `quality_snapshot(raw)`.
    """
    require_columns(raw, required)
    typed = raw.select(
        *[
            to_number(F.col(c)).alias(c)
            if c in numeric or c == target
            else fill(strip(F.col(c).cast("string")), UNKNOWN).alias(c)
            if c in texts
            else F.col(c)
            for c in raw.columns
        ]
    )
    stats = FillStatistics(typed, {c: F.col(c) for c in numeric}, F.col(group), [grouped], **limits)
    medians, n_medians = stats.group_medians([grouped])
    fallback = {k: q[0] for k, q in stats.quantile_values(stats.fill_groups(medians, n_medians), [0.5]).items()}
    rows = group_fill(typed, [grouped], group, medians, n_medians)
    for c in numeric:
        rows = rows.withColumn(c, fill(F.col(c), F.lit(fallback.get(c)).cast("double")))
    return rows.select(*raw.columns)


def join_dimension(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Left join to a small dimension that is unique on its key; Catalyst broadcasts it by its known size (JN-01)."""
    return df.join(dim, key, "left").select(*df.columns, value)


def join_check(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Rows before and after the join and rows without a match, in one row.

    Works on counts per key, so the check shuffles no rows.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    matched = sizes.join(dim.groupBy(key).agg(F.count(F.lit(1)).alias("m"), F.count(value).alias("v")), key, "left")
    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n") * F.greatest(F.coalesce("m", F.lit(0)), F.lit(1))), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum(F.when(F.coalesce("v", F.lit(0)) == 0, F.col("n")).otherwise(0)), F.lit(0)).alias("unmatched"),
    )
