"""The drift report as one row (REP-02): counts by status, health, the worst drift rows and the primary cause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import health, severity_of


def report_payload(drift: DataFrame, causes: DataFrame, unresolved: Column | int = 0, *, top: int = 5) -> DataFrame:
    """One row from the drift table (a row per feature), the root-cause report (a few rows per target) and the open letters.

    The primary cause is the first cause of the leading target; it is null where no segment is large enough.
    """
    place = F.struct((-severity_of("status")).alias("s"), (-F.coalesce("score", F.lit(0.0))).alias("d"), "feature", "kind", "metric", "status", "score")
    rows = drift.agg(F.slice(F.array_sort(F.collect_list(place)), 1, top).alias("r")).select(
        F.transform("r", lambda r: F.struct(r["feature"].alias("feature"), r["kind"].alias("kind"), r["metric"].alias("metric"), r["status"].alias("status"), r["score"].alias("score"))).alias("top_drift")
    )
    first = causes.agg(
        F.min_by(
            F.struct("target", "segment_feature", "segment", "direction", "explanation_score", "contribution"),
            F.struct("target_rank", (-F.bround("contribution", 10)).alias("c"), "segment_feature", "segment"),
        ).alias("primary_cause")
    )
    return health(drift, unresolved).crossJoin(F.broadcast(rows)).crossJoin(F.broadcast(first))  # one row each
