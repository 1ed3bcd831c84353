"""Gates at the front of every job (SRC-02, SRC-03, VAL-13)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail at plan time with the sorted names of absent columns."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Fail on an empty input; reads at most one row."""
    if df.isEmpty():
        raise ValueError("there is no data to work on")
    return df


def surplus_ids(df: DataFrame, key: str) -> DataFrame:
    """Number of rows whose id was seen before (AGG-15); nulls count as one id.

    Counted per id first, so the shuffle carries one partial count per id and task.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids")
    )


def domain_check(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Null and foreign value counts, and whether exactly the allowed values occur (AGG-16)."""
    c = F.col(column)
    seen = [F.max((c == v).cast("int")) for v in allowed]
    present = seen[0]
    for s in seen[1:]:
        present = F.least(present, s)
    foreign = F.count_if(c.isNotNull() & ~c.isin(*allowed))
    nulls = F.count_if(c.isNull())
    return df.agg(nulls.alias("nulls"), foreign.alias("foreign_values"), present.alias("_all")).select(
        "nulls",
        "foreign_values",
        ((F.col("nulls") == 0) & (F.col("foreign_values") == 0) & (F.coalesce("_all", F.lit(0)) == 1)).alias(
            "exact_domain"
        ),
    )


def require_binary_target(df: DataFrame, key: str, target: str) -> DataFrame:
    """Data-set gate: unique ids, no null target, exactly the classes 0 and 1 (VAL-13)."""
    if surplus_ids(df, key).first()[0]:
        raise ValueError(f"{key} holds duplicate values")
    seen = domain_check(df, target, (0, 1)).first()
    if seen["nulls"]:
        raise ValueError(f"{target} must not be null")
    if not seen["exact_domain"]:
        raise ValueError(f"{target} needs the two classes 0 and 1")
    return df
