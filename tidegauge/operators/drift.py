"""Distribution drift between two periods (STA-03..09, AGG-21, JN-02, JN-03, JN-07).

Numeric drift starts from one staged table of value counts, (feature, value, n_ref, n_cur): bins, PSI, KS, means and
medians are all read from it. Categorical drift starts from (feature, value, n_ref, n_cur) as well. Rows are scanned
once per kind, and what is shuffled is already counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MonitorConfig
from ..functions.numeric import half_even
from ..functions.tails import two_sample_p
from .quantiles import quantile_picks
from .scale import running_totals, stage, stage_counted

EPSILON = 1e-6
REFERENCE, CURRENT = "reference", "current"
UNKNOWN = "Unknown"
BINS = 10


def two_periods(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Both frames under one `period` column (SET-01)."""
    return reference.withColumn("period", F.lit(REFERENCE)).unionByName(current.withColumn("period", F.lit(CURRENT)))


def period_value_counts(
    df: DataFrame, features: Sequence[str], *, text: bool = False, position: str | None = None
) -> DataFrame:
    """(feature, value, n_ref, n_cur) of several columns in one scan of a frame with a `period` column.

    The long form exists only in front of the map-side counts. A missing number stays as a null value, a missing text is
    "Unknown". `position` adds the first position of each value per period.
    """
    kind = "string" if text else "double"
    extra = [F.col(position).alias("_pos")] if position else []
    wide = df.select("period", *extra, *[F.col(f).cast(kind).alias(f) for f in features])
    long = wide.unpivot(["period", *(["_pos"] if position else [])], list(features), "feature", "value")
    if text:
        long = long.withColumn("value", F.coalesce("value", F.lit(UNKNOWN)))
    else:
        long = long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    is_ref, is_cur = F.col("period") == REFERENCE, F.col("period") == CURRENT
    measures = [F.count_if(is_ref).alias("n_ref"), F.count_if(is_cur).alias("n_cur")]
    if position:
        measures += [
            F.min(F.when(is_ref, F.col("_pos"))).alias("pos_ref"),
            F.min(F.when(is_cur, F.col("_pos"))).alias("pos_cur"),
        ]
    return long.groupBy("feature", "value").agg(*measures)


# --- numeric ---------------------------------------------------------------------------------------------------------


def ordered_values(counts: DataFrame, *, rows: int | None = None, **limits) -> DataFrame:
    """The present values in order, with running counts of both periods. Edges, medians and KS are all read from it."""
    present = counts.filter(F.col("value").isNotNull())
    return stage(running_totals(present, ["feature"], ["value"], ["n_ref", "n_cur"], rows=rows, **limits), "ordered-values")


def numeric_summary(ordered: DataFrame, bins: int = BINS) -> DataFrame:
    """One row per feature from one aggregate: edges, KS, means and medians (STA-03, STA-04).

    Edges are the inner reference deciles, outer bins are open. One distinct value gives that value as the only edge;
    fewer than three distinct deciles fall back to the median. The KS p-value is exact for small samples.
    """
    ref_picks, ref_q = quantile_picks([i / bins for i in range(bins + 1)], "n_ref")
    cur_picks, cur_q = quantile_picks([0.5], "n_cur")
    share = lambda w: F.try_divide(
        (F.col(f"{w}_before") + F.col(w)).cast("double"), F.col(f"{w}_total")
    )
    mean = lambda w: F.try_divide(F.sum(F.col("value") * F.col(w)), F.sum(w))
    found = ordered.groupBy("feature").agg(
        *ref_picks,
        *cur_picks,
        F.max(F.abs(share("n_ref") - share("n_cur"))).alias("ks_statistic"),
        mean("n_ref").alias("ref_mean"),
        mean("n_cur").alias("cur_mean"),
    )
    found = found.withColumn("_q", ref_q).withColumn("_d", F.array_distinct("_q"))
    inner = F.slice("_d", 2, F.greatest(F.size("_d") - 2, F.lit(0)))
    edges = F.when(F.size("_d") == 1, F.col("_d")).when(F.size("_d") < 3, F.array(F.col("_q")[bins // 2])).otherwise(inner)
    sizes = [F.col(f"_{w}_size").cast("double") for w in ("n_ref", "n_cur")]
    return found.select(
        "feature",
        edges.alias("edges"),
        "ks_statistic",
        two_sample_p(F.col("ks_statistic"), *sizes).alias("ks_pvalue"),
        "ref_mean",
        "cur_mean",
        F.col("_q")[bins // 2].alias("ref_median"),
        cur_q[0].alias("cur_median"),
    )


def bin_of(value: Column, edges: Column) -> Column:
    """Index of the right-closed bin: how many inner edges lie below the value (JN-07)."""
    return F.size(F.filter(edges, lambda e: value > e))


def bin_among(value: Column, edges: Sequence[float]) -> Column:
    """The same for edges known to the driver: a sum of comparisons, compiled with the rest of the row."""
    index = F.lit(0)
    for e in edges:
        index = index + F.when(value > F.lit(float(e)), 1).otherwise(0)
    return F.when(value.isNotNull(), index)


def bin_label(index: Column, edges: Column) -> Column:
    low = F.coalesce(F.try_element_at(edges, F.when(index > 0, index)).cast("string"), F.lit("-inf"))
    high = F.coalesce(F.try_element_at(edges, index + 1).cast("string"), F.lit("inf"))
    return F.concat(F.lit("("), low, F.lit(", "), high, F.lit("]"))


def psi_bins(counts: DataFrame, summary: DataFrame) -> DataFrame:
    """(feature, bin, label, n_ref, n_cur, ref_share, cur_share, contribution), empty bins included (STA-05)."""
    edges = summary.select("feature", "edges")
    table = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.size("edges"))))
    filled = (
        counts.filter(F.col("value").isNotNull())
        .join(F.broadcast(edges), "feature")  # one row per feature
        .groupBy("feature", bin_of(F.col("value"), F.col("edges")).alias("bin"))
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    return _with_shares(
        table.join(filled, ["feature", "bin"], "left").select(
            "feature",
            "bin",
            bin_label(F.col("bin"), F.col("edges")).alias("label"),
            F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
            F.coalesce("n_cur", F.lit(0)).alias("n_cur"),
        )
    ).withColumn("contribution", _psi_term(F.col("ref_share"), F.col("cur_share")))


def _with_shares(table: DataFrame) -> DataFrame:
    """Shares of the feature's total in each period (AGG-21); joined totals, so a wide domain is no one-task window."""
    totals = table.groupBy("feature").agg(F.sum("n_ref").alias("_r"), F.sum("n_cur").alias("_c"))
    share = lambda n, t: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col(t)), F.lit(0.0))
    return (
        table.join(F.broadcast(totals), "feature")  # one row per feature
        .withColumn("ref_share", share("n_ref", "_r"))
        .withColumn("cur_share", share("n_cur", "_c"))
        .drop("_r", "_c")
    )


def _psi_term(r: Column, c: Column) -> Column:
    r, c = r + EPSILON, c + EPSILON
    return (c - r) * F.ln(c / r)


def psi(bins: DataFrame) -> DataFrame:
    return bins.groupBy("feature").agg(F.sum("contribution").alias("psi"))


# --- categorical -----------------------------------------------------------------------------------------------------


def js_categories(counts: DataFrame) -> DataFrame:
    """(feature, value, shares, both KL terms, is_new) on the union of categories (STA-06, JN-02, JN-03)."""
    r, c = F.col("ref_share"), F.col("cur_share")
    middle = (r + c) / 2

    def kl(p: Column) -> Column:
        return F.when(p > 0, p * F.ln((p + EPSILON) / (middle + EPSILON))).otherwise(0.0)

    return (
        _with_shares(counts)
        .withColumn("kl_ref", kl(r))
        .withColumn("kl_cur", kl(c))
        .withColumn("is_new", (F.col("n_ref") == 0) & (F.col("n_cur") > 0))
    )


def js(categories: DataFrame) -> DataFrame:
    """(feature, js, max_share_change, n_new) (STA-06, STA-09)."""
    gap = F.abs(half_even(F.col("ref_share"), 6) - half_even(F.col("cur_share"), 6))
    return categories.groupBy("feature").agg(
        (F.sum(F.col("kl_ref") + F.col("kl_cur")) * 0.5).alias("js"),
        F.max(gap).alias("max_share_change"),
        F.count_if("is_new").alias("n_new"),
    )


def top_values(counts: DataFrame) -> DataFrame:
    """(feature, ref_top, cur_top): most frequent value per period; ties go to the first seen, else the lowest."""
    tied = "pos_ref" in counts.columns

    def best(n: str, pos: str) -> Column:
        # smallest of (-n, position or value): one bounded struct per partial aggregate
        order = F.struct(
            (-F.col(n)).alias("n"), *([F.col(pos).alias("p")] if tied else []), F.col("value").alias("v")
        )
        return F.min(F.when(F.col(n) > 0, order))["v"]

    return counts.groupBy("feature").agg(best("n_ref", "pos_ref").alias("ref_top"), best("n_cur", "pos_cur").alias("cur_top"))


def new_categories(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Values that occur only in the current period (JN-03, SET-04). Distinct first, so the anti join carries keys only."""
    return (
        current.select(column).distinct().join(reference.select(column).distinct(), column, "left_anti")
    )


# --- status and table ------------------------------------------------------------------------------------------------


def status_of(score: Column, warning: float, danger: float) -> Column:
    """Severity 0 stable, 1 warning, 2 danger (STA-07)."""
    return F.when(score >= danger, 2).when(score >= warning, 1).otherwise(0)


def missing_severity(delta_pp: Column, config: MonitorConfig) -> Column:
    return status_of(delta_pp, config.missing_warning_pp, config.missing_warning_pp * 2)


def severity_name(severity: Column) -> Column:
    return F.when(severity == 2, "danger").when(severity == 1, "warning").otherwise("stable")


def severity_of(status: str) -> Column:
    """2, 1 or 0 from the name of a status."""
    return F.when(F.col(status) == "danger", 2).when(F.col(status) == "warning", 1).otherwise(0)


def missing_rates(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, ref_missing, cur_missing) of a frame with a `period` column, before cleaning."""
    rate = lambda f, p: F.avg(
        F.when(F.col("period") == p, (F.col(f).isNull() | F.col(f).cast("string").isin("NaN")).cast("double"))
    )
    sums = df.agg(*[F.struct(rate(f, REFERENCE).alias("r"), rate(f, CURRENT).alias("c")).alias(f) for f in features])
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"{f}.r").alias("ref_missing"), F.col(f"{f}.c").alias("cur_missing"))
            for f in features
        ]
    )
    return sums.select(F.inline(rows))


class DriftProfile:
    """Staged counts of both kinds of features; every result below is read from them."""

    def __init__(self, both: DataFrame, config: MonitorConfig, position: str | None = None, **limits):
        self.config = config
        counts, rows = stage_counted(period_value_counts(both, config.numeric), "numeric-counts")
        self.ordered = ordered_values(counts, rows=rows, **limits)
        self.summary = stage(numeric_summary(self.ordered), "numeric-summary")
        self.categorical = stage(
            period_value_counts(both, config.categorical, text=True, position=position), "category-counts"
        )

    def bins(self) -> DataFrame:
        return psi_bins(self.ordered, self.summary)

    def numeric_table(self) -> DataFrame:
        return (
            psi(self.bins())
            .join(self.summary, "feature")
            .select(
                "feature",
                F.lit("numeric").alias("kind"),
                F.lit("PSI").alias("metric"),
                F.col("psi").alias("score"),
                F.col("ref_mean").cast("string").alias("reference_value"),
                F.col("cur_mean").cast("string").alias("current_value"),
                (F.col("cur_mean") - F.col("ref_mean")).alias("change"),
                F.col("ks_pvalue").alias("pvalue"),
                "ks_statistic",
                "ref_median",
                "cur_median",
                status_of(F.col("psi"), self.config.psi_warning, self.config.psi_danger).alias("_severity"),
            )
        )

    def categorical_table(self) -> DataFrame:
        none = F.lit(None).cast("double")
        return (
            js(js_categories(self.categorical))
            .join(top_values(self.categorical), "feature")
            .select(
                "feature",
                F.lit("categorical").alias("kind"),
                F.lit("JS").alias("metric"),
                F.col("js").alias("score"),
                F.col("ref_top").alias("reference_value"),
                F.col("cur_top").alias("current_value"),
                F.col("max_share_change").alias("change"),
                none.alias("pvalue"),
                none.alias("ks_statistic"),
                none.alias("ref_median"),
                none.alias("cur_median"),
                status_of(F.col("js"), self.config.js_warning, self.config.js_danger).alias("_severity"),
            )
        )

    def table(self, missing: DataFrame | None = None) -> DataFrame:
        """One row per feature, worst first (STA-08, ORD-05). `missing` (feature, ref_missing, cur_missing) escalates."""
        rows = self.numeric_table().unionByName(self.categorical_table())
        if missing is None:
            rows = rows.withColumn("ref_missing", F.lit(0.0)).withColumn("cur_missing", F.lit(0.0))
        else:
            rows = rows.join(F.broadcast(missing), "feature", "left").na.fill(0.0, ["ref_missing", "cur_missing"])
        delta = (F.col("cur_missing") - F.col("ref_missing")) * 100
        severity = F.greatest("_severity", missing_severity(delta, self.config))
        return (
            rows.withColumn("missing_change_pp", delta)
            .withColumn("_severity", severity)
            .withColumn("status", severity_name(F.col("_severity")))
            .orderBy(F.desc("_severity"), F.desc("score"), "feature")
            .drop("_severity")
        )

    def distributions(self) -> DataFrame:
        """Bar-pair data of all features (REP-03): feature, position, label, both shares rounded to 6 places."""
        numeric = self.bins().select("feature", F.col("bin").alias("position"), "label", "ref_share", "cur_share")
        categories = js_categories(self.categorical)
        texts = categories.select(
            "feature", F.lit(None).cast("int").alias("position"), F.col("value").alias("label"), "ref_share", "cur_share"
        )
        return numeric.unionByName(texts).select(
            "feature", "position", "label",
            half_even(F.col("ref_share"), 6).alias("ref_share"), half_even(F.col("cur_share"), 6).alias("cur_share"),
        )


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    config: MonitorConfig = MonitorConfig(),
    missing: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """Drift table of two cleaned frames; pass `missing_rates` of the uncleaned ones so cleaning hides nothing."""
    columns = [*config.numeric, *config.categorical]
    both = two_periods(reference.select(*columns), current.select(*columns))
    return DriftProfile(both, config, **limits).table(missing)


def health(drift: DataFrame, unresolved: Column | int = 0) -> DataFrame:
    """Counts by status, health score and overall label (AGG-26, AGG-27)."""
    unresolved = unresolved if isinstance(unresolved, Column) else F.lit(unresolved)
    counts = drift.agg(
        F.count_if(F.col("status") == "danger").alias("danger"),
        F.count_if(F.col("status") == "warning").alias("warning"),
    ).withColumn("unresolved", unresolved)
    score = 100 - F.col("danger") * 18 - F.col("warning") * 7 - F.col("unresolved") * 12
    return counts.select(
        "danger",
        "warning",
        "unresolved",
        F.greatest(F.lit(0), score).cast("int").alias("health_score"),
        F.when(F.col("danger") > 0, "danger")
        .when((F.col("warning") > 0) | (F.col("unresolved") > 0), "warning")
        .otherwise("stable")
        .alias("overall"),
    )
