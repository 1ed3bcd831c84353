"""Streaming intake: accept once, route, replay later (ST-03, ST-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import route
from ..operators.scale import path_exists, stage, staged_until_end
from .counters import with_event_time


def accept_once(stream: DataFrame, ts: str, key: str = "event_id", horizon: str = "1 day") -> DataFrame:
    """First event per id; ids are remembered for `horizon` of event time, so the state stays bounded."""
    return with_event_time(stream, ts).withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written by earlier batches; empty only if nothing has been written. Any other fault is an error."""
    return spark.read.parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


ACCEPTED = "event_id string, batch bigint"


def route_batch(batch: DataFrame, batch_id: int, folder: str) -> None:
    """Route one micro-batch against everything accepted before it, replayed letters included.

    Each batch owns its own partition and replaces it when it runs again, and ignores what it wrote itself, so a batch
    that failed half-way gives the same tables. What it staged goes when its tables are written.
    """
    spark = batch.sparkSession
    accepted = _read(spark, f"{folder}/accepted", ACCEPTED).filter(F.col("batch") < batch_id)
    with staged_until_end(spark):
        # stage the routed rows: three sinks read them, and the replay question is left to a later run
        routed = stage(route(batch, accepted.select("event_id")), "routed-batch")
        write_routed(routed, folder, batch_id)


def write_routed(routed: DataFrame, folder: str, batch_id: int) -> None:
    """The three tables of a routed micro-batch, each in the partition that belongs to the batch."""
    rows = {
        "accepted": routed.filter(F.col("outcome") == "accepted").select("seq", "canonical.*"),
        "dlq": routed.filter(F.col("outcome") == "dlq").select("seq", "event_id", "reason_code", "error_message", "event"),
        "duplicate": routed.filter(F.col("outcome") == "duplicate").select("seq", "event_id"),
    }
    for name, part in rows.items():
        part.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")


def route_stream(stream: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Route a stream of (seq, event); tables accepted, dlq and duplicate lie under `folder`."""
    return (
        stream.writeStream.foreachBatch(lambda df, n: route_batch(df, n, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def replay_letters(spark: SparkSession, folder: str, replay_id: int | None = None) -> DataFrame:
    """Route the pending dead letters once more, with the safe repair, and record what became of them (ING-08).

    A letter is pending until a replay has recorded a status for it. Recovered rows join the accepted table, so their ids
    are duplicates from then on. A replay owns the partitions of its number (the next one if none is given) and may be run
    again under it after a failure; the accepted rows are written before the statuses. Returns the statuses it recorded.
    """
    known = _read(spark, f"{folder}/replays", "seq bigint, replay_id bigint")
    if replay_id is None:
        replay_id = (known.agg(F.max("replay_id")).first()[0] or 0) + 1
    own = -replay_id  # partitions of replays are counted down, below those of batches
    earlier = known.filter(F.col("replay_id") != replay_id).select("seq")
    letters = _read(spark, f"{folder}/dlq", "seq bigint, event_id string, event string").join(earlier, "seq", "left_anti")
    accepted = _read(spark, f"{folder}/accepted", ACCEPTED).filter(F.col("batch") != own)
    status = (
        F.when(F.col("outcome") == "dlq", F.col("replay"))
        .when(F.col("outcome") == "duplicate", "duplicate")  # accepted since
        .otherwise("recovered")
    )
    with staged_until_end(spark):
        again = stage(route(letters.select("seq", "event"), accepted.select("event_id")).withColumn("replay", status), "replayed")
        recovered = again.filter(F.col("replay") == "recovered").select("seq", "canonical.*")
        recovered.write.mode("overwrite").parquet(f"{folder}/accepted/batch={own}")
        again.select("seq", "event_id", "replay", "replay_code", "replay_message", "canonical").write.mode("overwrite").parquet(
            f"{folder}/replays/replay_id={replay_id}"
        )
    return spark.read.parquet(f"{folder}/replays/replay_id={replay_id}")
