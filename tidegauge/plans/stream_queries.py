"""Streaming forms on the shared tables, run over everything available and compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.shipping import ship_by_value
from ..operators.scale import stage
from ..streaming import adaptive, counters, intake, keyed, recurring
from ..streaming.run import drain, run_folder, stream_table
from .attempt_queries import LEVELS, TRACE_SQL, batch_metrics
from .catalogue import query
from .intake_queries import ROUTED_SQL, spread_table, with_faults
from .tables import customers

ship_by_value(__name__)


@query("stream_counts", "ST-01 SRC-01", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_counts(spark, sf):
    return drain(counters.running_counts(stream_table(spark, sf, "events"), "event_type"), "counts", "complete")


@query(
    "stream_hourly", "ST-02",
    """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events
       WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def stream_hourly(spark, sf):
    """Closed hours only: an hour whose end the watermark has not passed stays open and is not written."""
    hours = counters.hourly_counts(stream_table(spark, sf, "events"), "ts", "event_type")
    out = drain(hours, "hourly")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


@query("stream_accept_once", "ST-03", "SELECT DISTINCT user_id FROM events")
def stream_accept_once(spark, sf):
    once = intake.accept_once(stream_table(spark, sf, "events"), "ts", "user_id", "60 days")
    return drain(once.select("user_id"), "once")


@query(
    "stream_route", "ST-04",
    f"WITH {ROUTED_SQL} SELECT outcome, count(*) AS n FROM routed GROUP BY outcome",
)
def stream_route(spark, sf):
    folder = run_folder(spark, "route")
    sent = with_faults(customers_stream(spark, sf))
    intake.route_stream(sent, folder, f"{folder}/checkpoint").awaitTermination()
    parts = [
        spark.read.parquet(f"{folder}/{o}").select(F.lit(o).alias("outcome")) for o in ("accepted", "dlq", "duplicate")
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_replay", "ST-04 ING-08",
    f"WITH {ROUTED_SQL} SELECT seq, replay FROM routed WHERE outcome = 'dlq'",
)
def stream_replay(spark, sf):
    folder = run_folder(spark, "replay")
    intake.route_stream(with_faults(customers_stream(spark, sf)), folder, f"{folder}/checkpoint").awaitTermination()
    return intake.replay_letters(spark, folder).select("seq", "replay")


def sent_in_parts(spark, rows, tag, parts, hashed):
    """Rows written as `parts` files that a stream reads one after the other, dealt by a hash of columns."""
    folder = run_folder(spark, tag)
    staged = stage(rows.withColumn("_part", F.pmod(F.xxhash64(*hashed), F.lit(parts))), tag)
    for i in range(parts):
        staged.filter(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query(
    "stream_route_keyed", "ST-04 JN-04",
    f"""WITH {ROUTED_SQL} SELECT outcome, count(*) AS n, count(DISTINCT event_id) AS ids FROM
          (SELECT event_id, 'twice' AS outcome FROM routed WHERE outcome = 'accepted'
           UNION ALL SELECT event_id, CASE WHEN outcome <> 'dlq' THEN 'once' ELSE 'letter' END FROM routed) GROUP BY outcome""",
)
def stream_route_keyed(spark, sf):
    """The feed in four micro-batches with accepted ids in keyed state: one of two equal events is accepted, the other a duplicate."""
    sent = with_faults(customers(spark, sf, spread_table)).withColumn("seq", F.col("seq").cast("bigint"))
    # a broken event and its whole twin come in one file, as they lie a fixed distance apart
    folder, live = sent_in_parts(spark, sent.withColumn("_k", F.col("seq") % 1_000_000_000_000), "keyed-feed", 4, ["_k"])
    keyed.route_keyed(live.drop("_k"), f"{folder}-out", f"{folder}-checkpoint").awaitTermination()
    got = {o: spark.read.parquet(f"{folder}-out/{o}").select("event_id") for o in ("accepted", "dlq", "duplicate")}
    rows = got["accepted"].select("event_id", F.lit("twice").alias("outcome")).unionByName(
        got["accepted"].unionByName(got["duplicate"]).withColumn("outcome", F.lit("once"))
    ).unionByName(got["dlq"].withColumn("outcome", F.lit("letter")))
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("stream_adaptive_ordered", "ST-05 WIN-05", f"WITH {TRACE_SQL} SELECT run_id, batch, before, after FROM trace")
def stream_adaptive_ordered(spark, sf):
    """The same levels from batches that come in any order, in three micro-batches; a last row moves the watermark past all."""
    metrics = batch_metrics(spark, sf).withColumn("ts", F.make_timestamp(
        F.year("run_id"), F.month("run_id"), F.dayofmonth("run_id"), F.col("batch"), F.lit(0), F.lit(0)
    ))
    rows = metrics.select("run_id", F.col("batch").cast("bigint").alias("batch"), "ts", "failure_rate", "retry_rate", "p95_ms")
    folder, live = sent_in_parts(spark, rows, "shuffled-metrics", 3, ["run_id", "batch"])
    last = rows.limit(1).select(F.lit("end").alias("run_id"), "batch", F.lit("2100-01-01").cast("timestamp").alias("ts"), "failure_rate", "retry_rate", "p95_ms")
    last.coalesce(1).write.mode("append").parquet(folder)
    with keyed.rocks_state(spark):
        out = drain(keyed.ordered_levels(live, LEVELS, lateness="60 days"), "ordered")
    return out.filter(F.col("run_id") != "end").select("run_id", "batch", "before", "after")


def customers_stream(spark, sf):
    return customers(spark, sf, stream_table)


@query("stream_adaptive", "ST-05", f"WITH {TRACE_SQL} SELECT run_id, batch, before, after FROM trace")
def stream_adaptive(spark, sf):
    metrics = stage(batch_metrics(spark, sf), "batch-metrics")
    folder = run_folder(spark, "metrics")
    metrics.write.parquet(folder)
    live = spark.readStream.schema(metrics.schema).parquet(folder)
    return drain(adaptive.adaptive_levels(live, LEVELS), "adaptive").select("run_id", "batch", "before", "after")


@query(
    "stream_report", "ST-06",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY event_type",
)
def stream_report(spark, sf):
    folder = run_folder(spark, "report")

    def report(batch, n):
        batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).write.mode(
            "overwrite"
        ).parquet(f"{folder}/out/run={n}")

    recurring.recurring(stream_table(spark, sf, "events"), report, f"{folder}/checkpoint").awaitTermination()
    # each run wrote the sums of its own rows
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(
        F.sum("n").alias("n"), F.round(F.sum("value"), 2).alias("value")
    )
