"""Roll-ups, summaries, pivots, KPI tables and top-k (AGG, ORD, REP)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions.text import is_server_error
from .scale import stage


def keyed_counts(df: DataFrame, dimensions: Sequence[str], order: str | None = None) -> DataFrame:
    """Counts by each dimension and the total in one pass (AGG-01): dimension, key, n[, first_pos].

    One scan with grouping sets; partial counts are taken before the shuffle, so a key that holds a third of all
    rows arrives as one number per map task.
    """
    sets = [[]] + [[d] for d in dimensions]
    measures = [F.count(F.lit(1)).alias("n")] + ([F.min(order).alias("first_pos")] if order else [])
    grouped = df.groupingSets(sets, *dimensions).agg(F.grouping_id(*dimensions).alias("_set"), *measures)
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    last = len(dimensions) - 1
    all_bits = (1 << len(dimensions)) - 1
    for i, d in enumerate(dimensions):
        bits = all_bits ^ (1 << (last - i))
        name = F.when(F.col("_set") == bits, F.lit(d)).otherwise(name)
        key = F.when(F.col("_set") == bits, F.col(d).cast("string")).otherwise(key)
    name = F.when(F.col("_set") == all_bits, F.lit("total")).otherwise(name)
    return grouped.select(name.alias("dimension"), key.alias("key"), "n", *(["first_pos"] if order else []))


def error_rate(df: DataFrame, status: str) -> DataFrame:
    """Total, 5xx count and percentage (AGG-02)."""
    failed = F.count_if(is_server_error(F.col(status)))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), failed.alias("errors"), (F.try_divide(failed, total) * 100).alias("error_pct")
    )


def summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, non-null values, mean and sum of a column by key (AGG-03, AGG-04)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.avg(value).alias("mean_value"),
        F.sum(value).alias("sum_value"),
    )


def category_summary(df: DataFrame) -> DataFrame:
    """Orders, mean price, quantity and sales by category, best first (AGG-05)."""
    return (
        df.groupBy("category")
        .agg(
            F.count("order_id").alias("orders"),
            half_even(F.avg("unit_price"), 2).alias("avg_price"),
            half_even(F.sum("quantity"), 2).alias("total_quantity"),
            half_even(F.sum("amount"), 2).alias("total_sales"),
        )
        .orderBy(F.desc("total_sales"), "category")
    )


def pivot_sum(df: DataFrame, index: str, column: str, value: str, values: Sequence[str], digits: int = 0) -> DataFrame:
    """Sum by index x column with absent cells 0 (AGG-06). The column values are given, so no extra job finds them."""
    wide = df.groupBy(index).pivot(column, list(values)).agg(F.sum(value)).na.fill(0.0)
    return wide.select(index, *[half_even(F.col(f"`{v}`"), digits).alias(v) for v in values])


def cross_tab(df: DataFrame, index: str, column: str) -> DataFrame:
    """Long contingency table (AGG-07)."""
    return df.groupBy(index, column).agg(F.count(F.lit(1)).alias("n"))


def rate_by(df: DataFrame, segment: str, flag: Column | str, out: str = "rate") -> DataFrame:
    """Mean of a 0/1 column by segment, lowest first (AGG-11)."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return df.groupBy(segment).agg(F.avg(c.cast("double")).alias(out)).orderBy(out, segment)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order (ORD-02, ORD-03): planned as TakeOrderedAndProject, k rows per task."""
    if k <= 0:
        raise ValueError("k must be at least 1")
    return df.orderBy(*order).limit(k)


def most_frequent(counts: DataFrame, keys: Sequence[str], value: str, n: str, first_pos: str | None = None) -> DataFrame:
    """Mode per key from counts (AGG-22); ties go to the first seen, or to the lowest value without positions."""
    tie = F.col(first_pos) if first_pos else F.col(value)
    if first_pos:
        rank = F.struct(F.col(n), -tie)
        return counts.groupBy(*keys).agg(F.max_by(value, rank).alias("top"))
    best = counts.groupBy(*keys).agg(F.max(F.struct(F.col(n).alias("n"))).alias("b"))
    return counts.groupBy(*keys, n).agg(F.min(value).alias("v")).join(
        best.select(*keys, F.col("b.n").alias(n)), [*keys, n]
    ).select(*keys, F.col("v").alias("top"))


def kpi(df: DataFrame) -> DataFrame:
    """Orders, net sales, mean order value and number of regions (AGG-08, AGG-09) in one row.

    Rows without an order id count in the sales, not as an order.
    """
    orders = df.groupBy("order_id").agg(F.sum("amount").alias("amount"))
    per_order = orders.agg(
        F.count("order_id").alias("orders"),
        F.sum("amount").alias("net_sales"),
        F.avg(F.when(F.col("order_id").isNotNull(), F.col("amount"))).alias("mean_order_value"),
    )
    regions = df.agg(F.count_distinct("region").alias("n")).scalar()
    return per_order.select(
        "orders",
        half_even(F.col("net_sales")).alias("net_sales"),
        half_even(F.col("mean_order_value")).alias("mean_order_value"),
        regions.alias("regions"),
    )


def sales_report(df: DataFrame, top_n: int = 5) -> DataFrame:
    """KPI, best categories and all regions as (section, label, value, rank) (REP-01).

    `rank` carries the order inside a section: the figures as listed, categories and regions by falling amount.

    The sums by order, category and region come from one pass with grouping sets, staged for the four readings of it.
    """
    if top_n <= 0:
        raise ValueError("top_n must be at least 1")
    sets = [["order_id"], ["category"], ["region"]]
    keys = ["order_id", "category", "region"]
    sums = df.groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("_set"), F.sum("amount").alias("amount"))
    sums = stage(sums, "report-sums")
    orders, categories, regions = (sums.filter(F.col("_set") == bits) for bits in (0b011, 0b101, 0b110))
    n_regions = regions.agg(F.count("region")).scalar()
    figures = orders.agg(
        F.count("order_id").alias("n"), F.sum("amount").alias("total"),
        F.avg(F.when(F.col("order_id").isNotNull(), F.col("amount"))).alias("mean"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("kpi").alias("section"), F.lit(label).alias("label"), value.cast("double").alias("value"),
                        F.lit(rank).alias("rank"),
                    )
                    for rank, (label, value) in enumerate(
                        (
                            ("orders", F.col("n")),
                            ("net_sales", half_even(F.col("total"))),
                            ("mean_order_value", half_even(F.col("mean"))),
                            ("regions", n_regions),
                        ),
                        1,
                    )
                ]
            )
        )
    )
    falling = Window.partitionBy("section").orderBy(F.desc("value"), F.asc("label"))  # one row per category or region
    shown = lambda rows, key: rows.select(
        F.lit(key).alias("section"), F.col(key).alias("label"), F.col("amount").alias("value")
    ).withColumn("rank", F.row_number().over(falling))
    best = shown(categories, "category").filter(F.col("rank") <= top_n)
    return figures.unionByName(best).unionByName(shown(regions, "region"))


def ratio_to_best(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each row's value over the smallest, and whether it is the fastest (AGG-24, AGG-25)."""
    best = df.agg(F.struct(F.min(value).alias("low"), F.min_by(key, F.struct(value, key)).alias("who")).alias("b")).scalar()
    return df.select(
        "*", (F.col(value) / best["low"]).alias("ratio"), (F.col(key) == best["who"]).alias("fastest")
    )


def scaled_to_max(df: DataFrame, value: str, out: str, floor: float = 0.001) -> DataFrame:
    """value / max(value, floor) over the shown rows (AGG-32)."""
    top = df.agg(F.greatest(F.max(value), F.lit(floor)).alias("m")).scalar()
    return df.withColumn(out, F.col(value) / top)


def five_numbers(df: DataFrame, keys: Sequence[str], value: str, **limits) -> DataFrame:
    """Box-plot data: min, quartiles, max by group (REP-04)."""
    from .quantiles import quantiles

    q = quantiles(df, value, (0, 0.25, 0.5, 0.75, 1), keys, **limits)
    names = ("low", "q1", "median", "q3", "high")
    return q.select(*keys, "n", *[F.col("q")[i].alias(nm) for i, nm in enumerate(names)])
