"""Quality of a frame in one pass over it (AGG-13..18, AGG-23, CLN-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_number


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Aggregate column: missing cells over all columns, one scan for all of them."""
    total = F.lit(0).cast("bigint")
    for c in columns or df.columns:
        total = total + F.count_if(is_missing(df, c))
    return total


def null_rates(df: DataFrame) -> DataFrame:
    """(column, missing_rate) from a single aggregate (AGG-14)."""
    rates = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing_rate")) for c in df.columns])
    return rates.select(F.inline(pairs))


def casualties(column: str) -> Column:
    """Aggregate column: values lost to a numeric cast (AGG-17)."""
    c = F.col(column)
    return F.count_if(c.isNotNull() & to_number(c).isNull())


def quality_snapshot(df: DataFrame, key: str, numeric: Sequence[str]) -> DataFrame:
    """Rows, duplicate ids, missing cells, missing rate, lost values (AGG-18).

    Grouped by id first with partial counts, so neither the distinct count nor a repeated id gathers in one task.
    """
    lost = F.lit(0).cast("bigint")
    for c in numeric:
        lost = lost + casualties(c)
    per_id = df.groupBy(F.col(key).alias("_id")).agg(
        F.count(F.lit(1)).alias("rows"), missing_cells(df).alias("missing"), lost.alias("lost")
    )
    cells = F.greatest(F.col("rows") * len(df.columns), F.lit(1))
    return per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_ids"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum("lost"), F.lit(0)).alias("numeric_coercions"),
    ).select("rows", "duplicate_ids", "missing_cells", (F.col("missing_cells") / cells).alias("missing_rate"), "numeric_coercions")
