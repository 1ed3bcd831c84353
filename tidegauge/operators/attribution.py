"""What moved the mean of a number: mix and within effects by segment (STA-10..13, FLT-05, WIN-02, ORD-06, ORD-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MonitorConfig
from .drift import CURRENT, REFERENCE, UNKNOWN, bin_among, bin_label, severity_of
from .quantiles import quantiles_of_counts, stacked_values
from .scale import stage_counted


def quartile_edges(both: DataFrame, columns: Sequence[str], **limits) -> dict[str, list[float]]:
    """Inner quartile edges over both periods together; at most three numbers per column."""
    if not columns:
        return {}
    long = stacked_values(both, {c: F.col(c) for c in columns})
    counts = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    staged, rows = stage_counted(counts, "segment-counts")
    return edges_of_counts(staged, rows, **limits)


def edges_of_counts(counts: DataFrame, rows: int | None = None, **limits) -> dict[str, list[float]]:
    """The same from (feature, value, n)."""
    q = quantiles_of_counts(counts, [0, 0.25, 0.5, 0.75, 1], ["feature"], rows=rows, **limits)
    # a constant column keeps one edge less than a bin needs: everything falls in one open bin
    return {r["feature"]: sorted(set(r["q"]))[1:-1] for r in q.collect()}


def segment(column: str, edges: dict[str, list[float]]) -> Column:
    """A row's segment: the category itself, or the index of its right-closed quartile bin as text (null stays null)."""
    if column not in edges:
        return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
    value = F.col(column).cast("double")
    return bin_among(F.when(~F.isnan(value), value), edges[column]).cast("string")


def segment_name(edges: dict[str, list[float]]) -> Column:
    """Readable label of (segment_feature, segment), for counted segments."""
    name = F.col("segment")
    for column, inner in edges.items():
        label = bin_label(F.col("segment").cast("int"), F.array(*[F.lit(float(e)) for e in inner]).cast("array<double>"))
        name = F.when(F.col("segment_feature") == column, label).otherwise(name)
    return name


def segment_table(both: DataFrame, target: str, segments: Sequence[str], edges: dict[str, list[float]]) -> DataFrame:
    """(segment_feature, segment, n_ref, n_cur, mean_ref, mean_cur): one scan, partial sums before the shuffle."""
    used = {c: e for c, e in edges.items() if c in segments}
    wide = both.select(
        "period", F.col(target).cast("double").alias("_t"), *[segment(s, used).alias(f"_s_{s}") for s in segments]
    )
    long = wide.unpivot(["period", "_t"], [f"_s_{s}" for s in segments], "segment_feature", "segment")
    is_ref, is_cur = F.col("period") == REFERENCE, F.col("period") == CURRENT
    counted = (
        long.filter(F.col("segment").isNotNull())
        .groupBy("segment_feature", "segment")
        .agg(
            F.count_if(is_ref).alias("n_ref"),
            F.count_if(is_cur).alias("n_cur"),
            F.avg(F.when(is_ref, F.col("_t"))).alias("mean_ref"),
            F.avg(F.when(is_cur, F.col("_t"))).alias("mean_cur"),
        )
    )
    named = counted.withColumn("segment_feature", F.substring("segment_feature", 4, 1000))
    return named.withColumn("segment", segment_name(used))


def explain_shift(
    both: DataFrame,
    target: str,
    config: MonitorConfig = MonitorConfig(),
    segments: Sequence[str] | None = None,
    edges: dict[str, list[float]] | None = None,
    **limits,
) -> DataFrame:
    """Top causes of the change of a mean between the periods of `both` (STA-11, STA-12).

    Contribution is a share of the score of all candidates; the table then keeps the `top_causes` best. The two groups of
    a split in two have the same score but for the last bits, so the order looks at ten digits of the share, then at names.
    """
    if segments is None:
        segments = [c for c in (*config.categorical, *config.numeric) if c != target]
    if edges is None:
        edges = quartile_edges(both, [s for s in segments if s not in config.categorical], **limits)
    is_ref, is_cur = F.col("period") == REFERENCE, F.col("period") == CURRENT
    t = F.col(target).cast("double")
    whole = both.agg(
        F.struct(
            F.count_if(is_ref).alias("n_ref"),
            F.count_if(is_cur).alias("n_cur"),
            F.avg(F.when(is_ref, t)).alias("mean_ref"),
            F.avg(F.when(is_cur, t)).alias("mean_cur"),
        ).alias("w")
    )
    all_ = whole.first()["w"]
    delta = None if all_["mean_ref"] is None or all_["mean_cur"] is None else all_["mean_cur"] - all_["mean_ref"]
    groups = segment_table(both, target, segments, edges).filter(
        (F.col("n_ref") >= config.min_group_size) & (F.col("n_cur") >= config.min_group_size)
    )
    # at most rows / min_group_size groups per feature: staged, then read for the sum and for the top rows
    wr, wc = F.col("n_ref") / F.lit(all_["n_ref"]), F.col("n_cur") / F.lit(all_["n_cur"])
    mr, mc = F.col("mean_ref"), F.col("mean_cur")
    scored = groups.select(
        F.lit(target).alias("target"),
        "segment_feature",
        "segment",
        F.col("n_ref").alias("reference_count"),
        F.col("n_cur").alias("current_count"),
        wr.alias("reference_share"),
        wc.alias("current_share"),
        ((wc - wr) * 100).alias("share_change_pp"),
        mr.alias("reference_mean"),
        mc.alias("current_mean"),
        (mc - mr).alias("mean_change"),
        (0.5 * (wr + wc) * (mc - mr)).alias("within_effect"),
        (0.5 * (wr + wc) * ((mc - mr) - F.lit(delta))).alias("centered_within_effect"),
        (0.5 * (mr + mc) * (wc - wr)).alias("mix_effect"),
    ).withColumn("net_effect", F.col("within_effect") + F.col("mix_effect"))
    scored = scored.withColumn("explanation_score", F.abs("centered_within_effect") + F.abs("mix_effect"))
    staged, n = stage_counted(scored, "causes")
    total = staged.agg(F.sum("explanation_score")).first()[0] or 1.0
    direction = "stable" if not delta else "increase" if delta > 0 else "decrease"
    return (
        staged.withColumn("contribution", F.col("explanation_score") / F.lit(total))
        .withColumn("total_delta", F.lit(delta).cast("double"))
        .withColumn("direction", F.lit(direction))
        .orderBy(F.desc(F.bround("contribution", 10)), "segment_feature", "segment")
        .limit(config.top_causes)
    )


def drifting_targets(drift: DataFrame, config: MonitorConfig = MonitorConfig(), most: int = 3) -> list[str]:
    """Numeric features in warning or danger, worst first; the first target leads where it is absent (ORD-07)."""
    drifting = drift.filter((F.col("kind") == "numeric") & F.col("status").isin("danger", "warning"))
    rows = drifting.select("feature", "score", severity_of("status").alias("severity")).collect()  # one row per numeric feature at most
    names = [r["feature"] for r in sorted(rows, key=lambda r: (-r["severity"], -(r["score"] or 0.0), r["feature"]))]
    if config.first_target not in names:
        names.insert(0, config.first_target)
    return names[:most]


def root_cause_report(both: DataFrame, drift: DataFrame, config: MonitorConfig = MonitorConfig(), **limits) -> DataFrame:
    """Causes of every drifting target (STA-13), with `target_rank` from 1; the quartile edges are found once for all of them."""
    edges = quartile_edges(both, list(config.numeric), **limits)
    out = None
    for rank, target in enumerate(drifting_targets(drift, config), 1):
        part = explain_shift(both, target, config, edges=edges, **limits).withColumn("target_rank", F.lit(rank))
        out = part if out is None else out.unionByName(part)
    return out
