"""Summaries kept up to date batch by batch (AGG-30, AGG-34): partial states are stored, merged, and never recomputed.

Each batch writes its own partial states under its number; a batch that runs again replaces them, so it counts once. A state
is as small as what it stands for: one row per schema version and outcome for the intake, one per run and one per item of the
batch for attempt logs. Merging is associative (sums, smallest, largest, last by sequence), so batches may come in any order
and an item's attempts may lie in several of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .attempts import outcomes_of_states, run_figures
from .ingest import ingest_counts, summary_of_counts
from .scale import stage

PHASES = ("extract", "transform", "load")


def _write(df: DataFrame, folder: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")


def add_routed(routed: DataFrame, folder: str, batch: int) -> None:
    """Store the counts of a routed batch. Letters that are replayed later are added by `add_replayed`."""
    _write(ingest_counts(routed), folder, batch)


def add_replayed(statuses: DataFrame, folder: str, replay: int) -> None:
    """Store what a replay changed: (replay, canonical) of the letters it worked off; replays are numbered from 1."""
    is_ = lambda v: F.count_if(F.col("replay") == v)
    none = F.lit(0).cast("bigint")
    changed = statuses.groupBy(F.when(F.col("replay") == "recovered", F.col("canonical.source_schema_version")).alias("_version")).agg(
        none.alias("received"), none.alias("accepted_initial"), none.alias("dlq_initial"), is_("recovered").alias("recovered"),
        is_("failed").alias("unresolved"), is_("duplicate").alias("duplicates"), is_("recovered").alias("accepted_total"),
    )
    _write(changed, folder, -replay)


def intake_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary over all batches stored so far: a few rows per batch are read."""
    stored = spark.read.parquet(folder)
    sums = [c for c in stored.columns if c not in ("_version", "batch")]
    return summary_of_counts(stored.groupBy("_version").agg(*[F.sum(c).alias(c) for c in sums]))


def add_attempts(log: DataFrame, folder: str, batch: int) -> None:
    """Store the partial states of a batch of an attempt log."""
    log = stage(log, "log-batch")
    span = lambda f, p: f(F.when(F.col("phase") == p, F.col("elapsed_ms")))
    runs = log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("event_type") == "validation_failed").alias("transform_invalid"),
        F.max("elapsed_ms").alias("total_ms"),
        *[span(F.min, p).alias(f"{p}_from") for p in PHASES], *[span(F.max, p).alias(f"{p}_to") for p in PHASES],
    )
    items = log.filter(F.col("item_id").isNotNull()).groupBy("run_id", "item_id").agg(
        F.max(F.struct("sequence", "event_type", "detail")).alias("last"), F.max("attempt").alias("attempts"),
        F.min("elapsed_ms").alias("first_ms"), F.max("elapsed_ms").alias("last_ms"),
    )
    _write(runs, f"{folder}/runs", batch)
    _write(items, f"{folder}/items", batch)


def run_summaries(spark: SparkSession, folder: str, runs: Sequence[str] | None = None, **limits) -> DataFrame:
    """One row per run from the stored states, as `run_summary` gives it from the whole log; only `runs`, if given."""
    parts = {k: spark.read.parquet(f"{folder}/{k}") for k in ("runs", "items")}
    if runs is not None:
        parts = {k: p.filter(F.col("run_id").isin(*runs)) for k, p in parts.items()}
    items = parts["items"].groupBy("run_id", "item_id").agg(
        F.max("last").alias("last"), F.max("attempts").alias("attempts"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
    )
    whole = parts["runs"].groupBy("run_id").agg(
        F.sum("event_count").alias("event_count"), F.sum("transform_invalid").alias("transform_invalid"), F.max("total_ms").alias("total_ms"),
        *[F.min(f"{p}_from").alias(f"{p}_from") for p in PHASES], *[F.max(f"{p}_to").alias(f"{p}_to") for p in PHASES],
    )
    span = lambda p: F.coalesce((F.col(f"{p}_to") - F.col(f"{p}_from")) / 1000.0, F.lit(0.0)).alias(f"{p}_seconds")
    events = whole.select(
        "run_id", "event_count", "transform_invalid", *[span(p) for p in PHASES], (F.col("total_ms") / 1000.0).alias("total_seconds")
    )
    return run_figures(stage(outcomes_of_states(items), "outcomes"), events, **limits)


def touched_runs(spark: SparkSession, folder: str, batch: int) -> list[str]:
    """The runs that a batch has events of; their summaries are the ones to renew."""
    return [r.run_id for r in spark.read.parquet(f"{folder}/runs/batch={batch}").select("run_id").collect()]  # runs of one batch
