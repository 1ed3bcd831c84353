"""Attempt-log analytics on the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import ConcurrencyConfig
from ..functions.shipping import ship_by_value
from ..functions.text import elided
from ..operators import attempts as A
from ..operators import incremental as N
from ..operators.scale import own_folder, stage
from ..sources.fetch import dead_letters, fetch, retry_metrics
from ..sources.readers import table
from .catalogue import query
from .tables import LOG_SQL, attempt_log

ship_by_value(__name__)

LEVELS = ConcurrencyConfig(initial=10, low=1, high=30, latency_limit_ms=2_000_000.0, failure_limit=0.3, retry_limit=0.15)


def done(spark, sf):
    return A.outcomes(attempt_log(spark, sf))


@query(
    "event_sequence", "WIN-06",
    f"WITH {LOG_SQL} SELECT run_id, sequence, attempt, item_id, round(elapsed_ms, 3) AS elapsed_ms, event_type FROM log",
)
def event_sequence(spark, sf):
    log = attempt_log(spark, sf)
    return log.select(
        "run_id", "sequence", F.col("attempt").cast("bigint").alias("attempt"), "item_id", F.round("elapsed_ms", 3).alias("elapsed_ms"), "event_type"
    )


@query(
    "attempt_outcomes", "LOG-01",
    f"WITH {LOG_SQL} SELECT run_id, item_id, status, attempts, retries, round(latency_ms, 3) AS latency_ms FROM done",
)
def attempt_outcomes(spark, sf):
    return done(spark, sf).select(
        "run_id", "item_id", "status", F.col("attempts").cast("bigint").alias("attempts"), F.col("retries").cast("bigint").alias("retries"),
        F.round("latency_ms", 3).alias("latency_ms"),
    )


@query(
    "attempt_dead_letters", "LOG-06 SET-03",
    f"WITH {LOG_SQL} SELECT run_id, item_id AS id, 'extract' AS stage, error_type, error, attempts FROM done WHERE status = 'dead_letter'",
)
def attempt_dead_letters(spark, sf):
    return A.dead_letter_table(done(spark, sf)).withColumn("attempts", F.col("attempts").cast("bigint"))


@query(
    "latency_percentiles", "AGG-20",
    f"""WITH {LOG_SQL} SELECT run_id, round(quantile_disc(latency_ms, 0.5), 3) AS p50_ms, round(quantile_disc(latency_ms, 0.95), 3) AS p95_ms, count(*) AS n
        FROM done GROUP BY run_id""",
)
def latency_percentiles(spark, sf):
    return A.latency_percentiles(done(spark, sf)).select(
        "run_id", F.round("p50_ms", 3).alias("p50_ms"), F.round("p95_ms", 3).alias("p95_ms"), "n"
    )


BATCH_SQL = f"""{LOG_SQL},
batches AS (SELECT run_id, item_id % 24 AS batch, count(*) AS items, avg((status = 'dead_letter')::INT) AS failure_rate,
                   avg((retries > 0)::INT) AS retry_rate, quantile_disc(latency_ms, 0.95) AS p95_ms FROM done GROUP BY ALL)"""


def batch_metrics(spark, sf):
    batched = done(spark, sf).withColumn("batch", F.col("item_id") % 24)
    return A.congestion(batched)


@query(
    "congestion", "LOG-03 LOG-04",
    f"""WITH {BATCH_SQL}
        SELECT run_id, batch, items, round(failure_rate, 8) AS failure_rate, round(retry_rate, 8) AS retry_rate, round(p95_ms, 3) AS p95_ms,
               CASE WHEN failure_rate >= 0.3 OR retry_rate >= 0.15 OR p95_ms > 2000000 THEN 'congested'
                    WHEN failure_rate = 0 AND p95_ms < 1500000 THEN 'calm' ELSE 'hold' END AS reason FROM batches""",
)
def congestion(spark, sf):
    _, reason = A.decision(LEVELS)
    m = batch_metrics(spark, sf).withColumn("reason", reason)
    return m.withColumns({"failure_rate": F.round("failure_rate", 8), "retry_rate": F.round("retry_rate", 8), "p95_ms": F.round("p95_ms", 3)})


TRACE_SQL = f"""RECURSIVE {BATCH_SQL.lstrip()},
acts AS (SELECT run_id, batch, row_number() OVER (PARTITION BY run_id ORDER BY batch) AS i,
                CASE WHEN failure_rate >= 0.3 OR retry_rate >= 0.15 OR p95_ms > 2000000 THEN -1 WHEN failure_rate = 0 AND p95_ms < 1500000 THEN 1 ELSE 0 END AS a FROM batches),
trace AS (SELECT run_id, batch, i, 10 AS before, CASE WHEN a < 0 THEN greatest(1, 10 // 2) WHEN a > 0 THEN least(30, 12) ELSE 10 END AS after FROM acts WHERE i = 1
          UNION ALL
          SELECT n.run_id, n.batch, n.i, t.after, CASE WHEN a < 0 THEN greatest(1, t.after // 2) WHEN a > 0 THEN least(30, t.after + 2) ELSE t.after END
          FROM trace t JOIN acts n ON n.run_id = t.run_id AND n.i = t.i + 1)"""


@query(
    "concurrency_trace", "WIN-05 LOG-05 LOG-04 STR-07",
    f"""WITH {TRACE_SQL} SELECT run_id, batch, i AS position, CASE WHEN run_id LIKE '%3' THEN 7 ELSE before END AS before,
               CASE WHEN run_id LIKE '%3' THEN 7 ELSE after END AS after FROM trace""",
)
def concurrency_trace(spark, sf):
    """Days that end in 3 run at a fixed level, all others adapt theirs."""
    mode = F.when(F.col("run_id").endswith("3"), "fixed-7").otherwise("adaptive")
    t = A.concurrency_trace(batch_metrics(spark, sf).withColumn("mode", mode), LEVELS)
    return t.select("run_id", F.col("batch").cast("bigint").alias("batch"), "position", "before", "after")


@query(
    "concurrency_history", "AGG-29 STR-10 LOG-05",
    f"""WITH {TRACE_SQL}, h AS (SELECT run_id, list_prepend(10, coalesce(list(after ORDER BY i) FILTER (before <> after), [])) AS h FROM trace GROUP BY run_id)
        SELECT run_id, CASE WHEN len(h) > 6 THEN array_to_string(h[1:3], '→') || '→…→' || array_to_string(h[-2:], '→') ELSE array_to_string(h, '→') END AS history FROM h""",
)
def concurrency_history(spark, sf):
    trace = stage(A.concurrency_trace(batch_metrics(spark, sf), LEVELS), "trace")
    # a run's day has at most 24 batches
    changed = F.collect_list(F.when(F.col("before") != F.col("after"), F.struct("position", "after")))
    levels = F.transform(F.array_sort(changed), lambda e: e["after"])
    return trace.groupBy("run_id").agg(elided(F.concat(F.array(F.lit(LEVELS.initial)), levels)).alias("history"))


@query(
    "run_summary", "AGG-30 AGG-35",
    f"""WITH {LOG_SQL},
        e AS (SELECT run_id, count(*) AS event_count, round(max(elapsed_ms) / 1000, 4) AS total_seconds FROM log GROUP BY run_id)
        SELECT run_id, count(*) AS requested, count(*) FILTER (status = 'success') AS extracted, count(*) FILTER (status = 'dead_letter') AS extract_failed,
               CAST(sum(retries) AS BIGINT) AS retries, any_value(event_count) AS event_count, any_value(total_seconds) AS total_seconds,
               round(quantile_disc(latency_ms, 0.5), 3) AS p50_ms, round(quantile_disc(latency_ms, 0.95), 3) AS p95_ms,
               count(*) FILTER (status = 'success') AS valid FROM done JOIN e USING (run_id) GROUP BY run_id""",
)
def run_summary(spark, sf):
    s = A.run_summary(attempt_log(spark, sf))
    return s.select(
        "run_id", "requested", "extracted", "extract_failed", "retries", "event_count", F.round("total_seconds", 4).alias("total_seconds"),
        F.round("p50_ms", 3).alias("p50_ms"), F.round("p95_ms", 3).alias("p95_ms"), "valid",
    )


@query(
    "run_summary_by_batches", "AGG-30 AGG-35",
    f"""WITH {LOG_SQL},
        e AS (SELECT run_id, count(*) AS event_count, round(max(elapsed_ms) / 1000, 4) AS total_seconds FROM log GROUP BY run_id)
        SELECT run_id, count(*) AS requested, count(*) FILTER (status = 'success') AS extracted, count(*) FILTER (status = 'dead_letter') AS extract_failed,
               CAST(sum(retries) AS BIGINT) AS retries, any_value(event_count) AS event_count, any_value(total_seconds) AS total_seconds,
               round(quantile_disc(latency_ms, 0.95), 3) AS p95_ms FROM done JOIN e USING (run_id) GROUP BY run_id""",
)
def run_summary_by_batches(spark, sf):
    """The same summary from the partial states of three batches of the log, one of which is written twice."""
    log = stage(attempt_log(spark, sf), "log")
    folder = f"{own_folder(spark)}/states-{uuid.uuid4().hex}"
    for batch in (2, 0, 1, 0):
        N.add_attempts(log.filter(F.pmod("sequence", F.lit(3)) == batch), folder, batch)
    return N.run_summaries(spark, folder).select(
        "run_id", "requested", "extracted", "extract_failed", "retries", "event_count", F.round("total_seconds", 4).alias("total_seconds"),
        F.round("p95_ms", 3).alias("p95_ms"),
    )


@query(
    "experiment_cards", "AGG-31 AGG-24 LOG-07",
    f"""WITH {LOG_SQL}, e AS (SELECT run_id, max(elapsed_ms) / 1000 AS s FROM log GROUP BY run_id),
        r AS (SELECT run_id, sum(retries) AS retries, count(*) FILTER (status = 'dead_letter') AS failed, quantile_disc(latency_ms, 0.95) AS p95, any_value(s) AS s
              FROM done JOIN e USING (run_id) GROUP BY run_id)
        SELECT count(*) AS runs, CAST(sum(retries) AS BIGINT) AS retries, CAST(sum(failed) AS BIGINT) AS extract_failed, arg_min(run_id, (s, run_id)) AS fastest_run,
               round(min(s), 4) AS fastest_seconds, round(avg(p95), 3) AS adaptive_p95_ms, round(sum(s) / max(s), 6) AS speed_up FROM r""",
)
def experiment_cards(spark, sf):
    runs = stage(A.run_summary(attempt_log(spark, sf)).withColumn("mode", F.lit("adaptive")), "runs")
    cards = A.experiment_cards(runs).withColumns({"fastest_seconds": F.round("fastest_seconds", 4), "adaptive_p95_ms": F.round("adaptive_p95_ms", 3)})
    times = runs.agg(F.sum("total_seconds").alias("one_by_one"), F.max("total_seconds").alias("side_by_side"))
    ratio = A.speed_up(times, "one_by_one", "side_by_side").select(F.round("speed_up", 6).alias("s"))
    return cards.withColumn("speed_up", ratio.scalar())


@query(
    "retry_metrics", "AGG-35",
    f"WITH {LOG_SQL} SELECT run_id, item_id, retries FROM done WHERE retries > 0",
)
def retry_by_item(spark, sf):
    return done(spark, sf).filter(F.col("retries") > 0).select("run_id", "item_id", F.col("retries").cast("bigint").alias("retries"))


@query(
    "backoff_check", "LOG-02",
    f"""WITH {LOG_SQL} SELECT attempt, count(*) AS n, count(*) FILTER (abs(50 * attempt - 50 * pow(2, attempt - 1)) > 1e-6) AS off_schedule
        FROM log WHERE attempt > 1 GROUP BY attempt""",
)
def backoff_check(spark, sf):
    """A log in which further attempts are scheduled retries and first attempts are not."""
    kind = F.when(F.col("attempt") > 1, "retry_scheduled").otherwise(F.col("event_type"))
    log = attempt_log(spark, sf).withColumn("event_type", kind)
    return A.backoff_check(log, 50.0).withColumn("attempt", F.col("attempt").cast("bigint"))


@query(
    "batch_members", "LOG-08",
    f"WITH {LOG_SQL} SELECT run_id, sequence AS batch, 2 AS concurrency, item_id + i AS item_id FROM log, range(2) t(i)",
)
def batch_members(spark, sf):
    """A log in which every event stands beside a batch that it started; the operator takes the batches and leaves the events."""
    detail = F.to_json(F.struct(F.lit(2).alias("concurrency"), F.array("item_id", F.col("item_id") + 1).alias("ids")))
    own = F.struct("event_type", "detail")
    start = F.struct(F.lit("batch_started").alias("event_type"), detail.alias("detail"))
    log = attempt_log(spark, sf).withColumn("_e", F.explode(F.array(own, start))).drop("event_type", "detail").select("*", "_e.*")
    return A.batch_members(log)


def respond(item: int, attempt: int) -> dict:
    """A stand-in service: every 7th id needs a second attempt, every 11th never answers."""
    if item % 11 == 0 or (item % 7 == 0 and attempt == 1):
        raise TimeoutError("slow")
    return {"id": item, "value": item * 7 % 101}


@query(
    "fetch_customers", "SRC-09 JN-06 AGG-35 LOG-06",
    """SELECT count(*) AS requested, count(*) FILTER (c_custkey % 11 <> 0) AS collected, count(*) FILTER (c_custkey % 11 = 0) AS failed,
              CAST(sum(CASE WHEN c_custkey % 11 = 0 THEN 1 WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS retries,
              count(*) FILTER (c_custkey % 11 = 0) AS dead_letters FROM customer""",
)
def fetch_customers(spark, sf):
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    fetched = stage(fetch(ids, respond, max_attempts=2, backoff_seconds=0.0), "fetched")
    letters = dead_letters(fetched).agg(F.count(F.lit(1)).alias("n"))
    return retry_metrics(fetched).withColumn("dead_letters", letters.scalar())
