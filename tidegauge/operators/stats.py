"""Two-sample and independence tests (STA-01, STA-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import chi_square_p, student_p, two_sample_p
from .scale import running_totals


def welch_t(df: DataFrame, value: str, first: Column, second: Column, *, pvalue: bool = True) -> DataFrame:
    """Welch's t between the rows of two conditions, missing values left out; one row, one scan."""
    x = F.col(value).cast("double")
    x = F.when(~F.isnan(x), x)
    side = lambda c, s: [
        F.count(F.when(c, x)).alias(f"n_{s}"), F.avg(F.when(c, x)).alias(f"mean_{s}"), F.var_samp(F.when(c, x)).alias(f"var_{s}")
    ]
    one = df.agg(*side(first, "first"), *side(second, "second"))
    a = F.try_divide(F.col("var_first"), F.col("n_first"))
    b = F.try_divide(F.col("var_second"), F.col("n_second"))
    t = F.try_divide(F.col("mean_first") - F.col("mean_second"), F.sqrt(a + b))
    dof = F.try_divide(
        (a + b) * (a + b), F.try_divide(a * a, F.col("n_first") - 1) + F.try_divide(b * b, F.col("n_second") - 1)
    )
    out = one.select("n_first", "n_second", "mean_first", "mean_second", t.alias("statistic"), dof.alias("df"))
    return out.withColumn("pvalue", student_p(F.col("statistic"), F.col("df"))) if pvalue else out


def chi_square(counts: DataFrame, row: str, column: str, n: str = "n", *, pvalue: bool = True) -> DataFrame:
    """Independence of two categoricals from their contingency counts; Yates' correction where dof is 1.

    Expected counts need absent cells as well: the table is completed from the margins in closed form, so cells with no
    rows add their expected value without being listed.
    """
    counts = counts.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    rows = counts.groupBy(row).agg(F.sum(n).alias("_r"))
    columns = counts.groupBy(column).agg(F.sum(n).alias("_c"))
    margin = lambda table, m: table.agg(
        F.struct(
            F.sum(m).cast("double").alias("total"), F.count(F.lit(1)).alias("k"), F.sum(1 / F.col(m)).alias("inverse")
        ).alias("s")
    ).scalar()
    by_row, by_column = margin(rows, "_r"), margin(columns, "_c")
    expected = F.col("_r") * F.col("_c") / F.col("_total")
    cells = counts.join(rows, row).join(columns, column).withColumn("_total", by_row["total"])
    sums = cells.agg(
        F.sum(F.pow(F.col(n) - expected, 2) / expected).alias("seen"),
        F.sum(expected).alias("seen_expected"),
        F.max(F.abs(F.col(n) - expected)).alias("gap"),
        F.max("_total").alias("total"),
        F.count(F.lit(1)).alias("cells"),
    ).select(
        "*",
        ((by_row["k"] - 1) * (by_column["k"] - 1)).alias("dof"),
        (by_row["k"] * by_column["k"]).alias("all_cells"),
        (by_row["inverse"] * by_column["inverse"]).alias("inverse"),
    )
    # an absent cell adds its expected count; in a 2 x 2 table all four gaps are equal
    plain = F.col("seen") + F.when(F.col("cells") < F.col("all_cells"), F.col("total") - F.col("seen_expected")).otherwise(0.0)
    corrected = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * F.col("total") * F.col("inverse")
    statistic = F.when(F.col("dof") == 0, 0.0).when(F.col("dof") == 1, corrected).otherwise(plain)
    out = sums.select(statistic.alias("statistic"), F.col("dof").cast("bigint").alias("dof"))
    if not pvalue:
        return out
    p = F.when(F.col("dof") == 0, 1.0).otherwise(chi_square_p(F.col("statistic"), F.col("dof").cast("double")))
    return out.withColumn("pvalue", p)


def ks_by_group(df: DataFrame, keys: Sequence[str], value: str, first: Column, second: Column, **limits) -> DataFrame:
    """Kolmogorov-Smirnov of the rows of two conditions within each group: sizes, statistic and p-value (STA-03).

    Values are counted before the shuffle and put in order by `running_totals`, so a group may hold any share of the rows.
    Missing values are left out; groups that lack one side have no statistic.
    """
    keys = list(keys)
    x = F.col(value).cast("double")
    present = df.filter(x.isNotNull() & ~F.isnan(x))
    counts = present.groupBy(*keys, x.alias("_x")).agg(F.count_if(first).alias("n_first"), F.count_if(second).alias("n_second"))
    ordered = running_totals(counts, keys, ["_x"], ["n_first", "n_second"], **limits)
    share = lambda w: F.try_divide((F.col(f"{w}_before") + F.col(w)).cast("double"), F.col(f"{w}_total"))
    found = ordered.groupBy(*keys).agg(
        F.max("n_first_total").alias("n_first"), F.max("n_second_total").alias("n_second"),
        F.max(F.abs(share("n_first") - share("n_second"))).alias("statistic"),
    )
    return found.withColumn("pvalue", two_sample_p(F.col("statistic"), F.col("n_first").cast("double"), F.col("n_second").cast("double")))
