"""Attempt-log analytics (LOG-01..08, AGG-29..32, AGG-35, WIN-05, WIN-06).

A log row is (run_id, sequence, event_type, elapsed_ms, item_id, attempt, detail). A run may hold a large share of the log,
so nothing is ordered or listed per run in one task, except decisions, which are folded in bounded chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ConcurrencyConfig
from ..functions.text import part_as_int
from .quantiles import quantiles
from .scale import lookup, numbered_rows, stage, stage_counted

SUCCEEDED, FAILED, DEAD = "request_succeeded", "request_failed", "dead_letter"
# Batches folded in one row, and tables of levels chained in one row.
CHUNK, FAN = 256, 256


def sequenced(events: DataFrame, run: str, ts: str, tie: str, **limits) -> DataFrame:
    """Add `sequence` (1-based in time order) and `elapsed_ms` since the run's first event (WIN-06).

    The events are written once: counting, cutting by range (which looks at them twice) and the runs' starts read the written rows.
    """
    events, rows = stage_counted(events, "sequenced-events")
    limits.setdefault("rows", rows)
    numbered = numbered_rows(events, [ts, tie], "sequence", [run], **limits)
    start, runs = stage_counted(events.groupBy(run).agg(F.min(ts).alias("_start")), "run-starts")
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return (
        lookup(numbered, start, [run], table_rows=runs)
        .withColumn("elapsed_ms", (us(F.col(ts)) - us(F.col("_start"))) / 1000.0)
        .drop("_start")
    )


def outcomes(log: DataFrame) -> DataFrame:
    """Final outcome per item: status, attempts, retries, latency (LOG-01). Partial maxima, no list per item."""
    states = log.filter(F.col("item_id").isNotNull()).groupBy("run_id", "item_id").agg(
        F.max_by(F.struct("event_type", "detail"), "sequence").alias("last"), F.max("attempt").alias("attempts"),
        F.min("elapsed_ms").alias("first_ms"), F.max("elapsed_ms").alias("last_ms"),
    )
    return outcomes_of_states(states)


def outcomes_of_states(states: DataFrame) -> DataFrame:
    """Outcomes from (run_id, item_id, last, attempts, first_ms, last_ms), where `last` has event_type and detail."""
    return states.select(
        "run_id",
        "item_id",
        F.when(F.col("last.event_type").isin(FAILED, DEAD), "dead_letter").otherwise("success").alias("status"),
        "attempts",
        F.greatest(F.col("attempts") - 1, F.lit(0)).alias("retries"),
        (F.col("last_ms") - F.col("first_ms")).alias("latency_ms"),
        F.col("last.detail").alias("detail"),
    )


def dead_letter_table(done: DataFrame, stage_name: str = "extract") -> DataFrame:
    """{run_id, id, stage, error_type, error, attempts} of the items that failed for good (LOG-06)."""
    return done.filter(F.col("status") == "dead_letter").select(
        "run_id",
        F.col("item_id").alias("id"),
        F.lit(stage_name).alias("stage"),
        F.get_json_object("detail", "$.error_type").alias("error_type"),
        F.get_json_object("detail", "$.error").alias("error"),
        "attempts",
    )


def expected_wait_ms(attempt: Column, base_ms: float) -> Column:
    """Back-off schedule base * 2^(attempt - 1) (LOG-02)."""
    return F.lit(base_ms) * F.pow(F.lit(2.0), attempt - 1)


def backoff_check(log: DataFrame, base_ms: float, tolerance: float = 1e-6) -> DataFrame:
    """Scheduled waits that differ from the schedule, by attempt."""
    wait = F.get_json_object("detail", "$.wait_ms").try_cast("double")
    off = F.abs(wait - expected_wait_ms(F.col("attempt"), base_ms)) > tolerance
    return (
        log.filter(F.col("event_type") == "retry_scheduled")
        .groupBy("attempt")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(off | wait.isNull()).alias("off_schedule"))
    )


def batch_members(log: DataFrame) -> DataFrame:
    """(run_id, batch, concurrency, item_id): items tied to the batch that started them (LOG-08).

    `batch` is the sequence number of the batch_started event. Its id list is bounded by the concurrency.
    """
    detail = F.from_json("detail", "concurrency int, ids array<bigint>")
    return (
        log.filter(F.col("event_type") == "batch_started")
        .select("run_id", F.col("sequence").alias("batch"), detail.alias("d"))
        .select("run_id", "batch", F.col("d.concurrency").alias("concurrency"), F.explode("d.ids").alias("item_id"))
    )


def congestion(done: DataFrame, keys: Sequence[str] = ("run_id", "batch"), **limits) -> DataFrame:
    """Items, failure rate, retry rate and nearest-rank p95 by batch (LOG-03)."""
    keys = list(keys)
    done = stage(done.select(*keys, "status", "retries", "latency_ms"), "batch-outcomes")
    rates = done.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("items"),
        F.avg((F.col("status") == "dead_letter").cast("double")).alias("failure_rate"),
        F.avg((F.col("retries") > 0).cast("double")).alias("retry_rate"),
    )
    p95 = quantiles(done, "latency_ms", [0.95], keys, method="nearest", **limits)
    return rates.join(p95.select(*keys, F.col("q")[0].alias("p95_ms")), keys, "left").na.fill(0.0, ["p95_ms"])


def latency_percentiles(done: DataFrame, keys: Sequence[str] = ("run_id",), **limits) -> DataFrame:
    """Nearest-rank p50 and p95 (AGG-20)."""
    q = quantiles(done, "latency_ms", [0.5, 0.95], list(keys), method="nearest", **limits)
    return q.select(*keys, F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"), "n")


def decision(config: ConcurrencyConfig) -> tuple[Column, Column]:
    """(action -1 | 0 | 1, reason) from failure_rate, retry_rate and p95_ms (LOG-04)."""
    congested = (
        (F.col("failure_rate") >= config.failure_limit)
        | (F.col("retry_rate") >= config.retry_limit)
        | (F.col("p95_ms") > config.latency_limit_ms)
    )
    calm = (F.col("failure_rate") == 0) & (F.col("p95_ms") < config.latency_limit_ms * config.calm_share)
    action = F.when(congested, -1).when(calm, 1).otherwise(0)
    reason = F.when(congested, "congested").when(calm, "calm").otherwise("hold")
    return action, reason


def next_level(level: Column, action: Column, config: ConcurrencyConfig) -> Column:
    half = F.greatest(F.lit(config.low), F.floor(level / 2).cast("int"))
    more = F.least(F.lit(config.high), level + config.step)
    return F.when(action < 0, half).when(action > 0, more).otherwise(level).cast("int")


def start_level(mode: Column, config: ConcurrencyConfig) -> Column:
    """`adaptive` starts at the configured level, `fixed-10` at 10 (STR-07)."""
    return F.when(mode == "adaptive", config.initial).otherwise(part_as_int(mode, "-", 2))


def _first_levels(maps: DataFrame, run: str, lowest: int, first: Column) -> DataFrame:
    """(run, _chunk, _level): the level with which each chunk of a run begins.

    `maps` holds per (run, _chunk) the table "level in -> level out". FAN neighbouring tables are chained into one until
    a run has at most FAN of them; the levels then go back down the same way, so no row grows with the run.
    """
    last = maps.agg(F.max("_chunk")).first()[0]
    upper = F.floor(F.col("_chunk") / FAN)
    listed = maps.groupBy(run, upper.alias("_upper")).agg(
        F.array_sort(F.collect_list(F.struct("_chunk", "_out"))).alias("_maps")  # at most FAN tables
    )
    out = lambda table, level: F.element_at(table, level - lowest + 1)
    if last is None or last < FAN:
        begun = listed.withColumn("_level", first)
    else:
        every = F.element_at("_maps", 1)["_out"]
        chained = F.aggregate(
            F.slice("_maps", F.lit(2), F.lit(FAN)), every, lambda acc, m: F.transform(acc, lambda level: out(m["_out"], level))
        )
        above = stage(listed.select(run, F.col("_upper").alias("_chunk"), chained.alias("_out")), "chained")
        found = _first_levels(above, run, lowest, first).withColumnRenamed("_chunk", "_upper")
        begun = listed.join(found, [run, "_upper"])
    levels = F.aggregate(
        "_maps",
        F.array(F.col("_level").cast("int")),
        lambda acc, m: F.array_append(acc, out(m["_out"], F.element_at(acc, -1))),
    )
    pairs = F.transform("_maps", lambda m, i: F.struct(m["_chunk"].alias("_chunk"), F.get(F.col("_levels"), i).alias("_level")))
    return begun.withColumn("_levels", levels).select(run, F.inline(pairs))


def concurrency_trace(metrics: DataFrame, config: ConcurrencyConfig, run: str = "run_id", batch: str = "batch", **limits) -> DataFrame:
    """Level before and after every batch of a run, in batch order (LOG-05, WIN-05).

    Runs whose `mode` (if the column is there) is not `adaptive` keep their starting level. In the others the level after a
    batch depends on all batches before it. Levels are few, so a chunk of batches is a small table "level in -> level out",
    and such tables chain: chunks are folded side by side for every level, the tables are chained in a tree, and each
    chunk then replays from its own first level.
    """
    action, reason = decision(config)
    mode = F.col("mode") if "mode" in metrics.columns else F.lit("adaptive")
    decided = stage(
        metrics.select(run, batch, mode.alias("mode"), action.alias("action"), reason.alias("reason")), "decisions"
    )
    steps = numbered_rows(decided, [batch], "_ord", [run], **limits)
    fixed = F.col("mode") != "adaptive"
    level = start_level(F.col("mode"), config).cast("int")
    kept = steps.filter(fixed).select(
        run, batch, F.col("_ord").alias("position"), level.alias("before"), level.alias("after"), "reason"
    )
    steps = stage(
        steps.filter(~fixed).select(
            run, batch, "action", "reason", F.col("_ord"), F.floor((F.col("_ord") - 1) / CHUNK).alias("_chunk")
        ),
        "steps",
    )
    lowest, highest = min(config.low, config.initial), max(config.high, config.initial)
    listed = steps.groupBy(run, "_chunk").agg(
        F.array_sort(F.collect_list(F.struct("_ord", batch, "action", "reason"))).alias("_steps")  # at most CHUNK entries
    )
    step_to = lambda level, s: next_level(level, s["action"], config)
    mapped = stage(
        listed.select(
            run,
            "_chunk",
            F.transform(
                F.sequence(F.lit(lowest), F.lit(highest)), lambda level: F.aggregate("_steps", level.cast("int"), step_to)
            ).alias("_out"),
        ),
        "chunk-levels",
    )
    starts = _first_levels(mapped, run, lowest, F.lit(config.initial).cast("int"))
    kind = metrics.schema[batch].dataType.simpleString()
    level_now = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["after"], F.col("_level"))
    replay = F.aggregate(
        "_steps",
        F.array().cast(f"array<struct<batch_key:{kind},before:int,after:int,reason:string,ord:bigint>>"),
        lambda acc, s: F.array_append(
            acc,
            F.struct(
                s[batch].alias("batch_key"),
                level_now(acc).alias("before"),
                next_level(level_now(acc), s["action"], config).alias("after"),
                s["reason"].alias("reason"),
                s["_ord"].alias("ord"),
            ),
        ),
    )
    traced = (
        listed.join(starts, [run, "_chunk"])
        .select(run, F.explode(replay).alias("t"))
        .select(run, F.col("t.batch_key").alias(batch), F.col("t.ord").alias("position"), "t.before", "t.after", "t.reason")
    )
    return traced.unionByName(kept)


def level_changes(trace: DataFrame) -> DataFrame:
    """Only the batches that changed the level (the recorded events)."""
    return trace.filter(F.col("before") != F.col("after"))


def run_summary(log: DataFrame, **limits) -> DataFrame:
    """One row per run from its event log (AGG-30)."""
    log = stage(log, "attempt-log")
    done = stage(outcomes(log), "outcomes")
    span = lambda phase: F.coalesce(
        (
            F.max(F.when(F.col("phase") == phase, F.col("elapsed_ms")))
            - F.min(F.when(F.col("phase") == phase, F.col("elapsed_ms")))
        )
        / 1000.0,
        F.lit(0.0),
    )
    invalid = F.count_if(F.col("event_type") == "validation_failed")
    events = log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        invalid.alias("transform_invalid"),
        *[span(p).alias(f"{p}_seconds") for p in ("extract", "transform", "load")],
        (F.max("elapsed_ms") / 1000.0).alias("total_seconds"),
    )
    return run_figures(done, events, **limits)


def run_figures(done: DataFrame, events: DataFrame, **limits) -> DataFrame:
    """A row per run from its items' outcomes (staged) and its event figures."""
    items = done.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("status") == "success").alias("extracted"),
        F.count_if(F.col("status") == "dead_letter").alias("extract_failed"),
        F.sum("retries").alias("retries"),
    )
    return (
        items.join(events, "run_id")
        .join(latency_percentiles(done, **limits).drop("n"), "run_id", "left")
        .withColumn("valid", F.col("extracted") - F.col("transform_invalid"))
    )


def experiment_cards(summaries: DataFrame) -> DataFrame:
    """Runs, retries, failures, fastest run and mean p95 of the adaptive runs (AGG-31) in one row."""
    return summaries.agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("retries").alias("retries"),
        F.sum("extract_failed").alias("extract_failed"),
        F.min_by("run_id", F.struct("total_seconds", "run_id")).alias("fastest_run"),
        F.min("total_seconds").alias("fastest_seconds"),
        F.coalesce(F.avg(F.when(F.col("mode") == "adaptive", F.col("p95_ms"))), F.lit(0.0)).alias("adaptive_p95_ms"),
    )


def speed_up(summaries: DataFrame, sequential: str, concurrent: str) -> DataFrame:
    """sequential / concurrent seconds (LOG-07)."""
    return summaries.withColumn("speed_up", F.try_divide(F.col(sequential), F.col(concurrent)))
