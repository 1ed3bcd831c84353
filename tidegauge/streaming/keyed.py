"""Keyed state on RocksDB: accept once without rereading what was accepted (JN-04, ST-04), ordered levels (ST-05, WIN-05).

State is versioned with the stream's checkpoint: a micro-batch that runs again starts from the state before it, and a restarted
stream goes on where it stopped. A micro-batch touches the keys it holds and nothing else, however much was accepted before.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import ConcurrencyConfig
from ..functions.shipping import ship_by_value
from ..operators.ingest import decided, judged_events
from ..operators.scale import make_folder, stage, stage_counted, staged_until_end
from .adaptive import decisions
from .intake import replay_letters, write_routed

ship_by_value(__name__)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession):
    """Streams started inside the block keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class FirstAccepted(StatefulProcessor):
    """Where an id was accepted first: -1 if an earlier micro-batch (or a replay) took it, else the smallest valid position of
    this one. Ids of which no valid event has come have no state."""

    def __init__(self, keep_ms: int | None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getValueState("accepted", "seq bigint", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # marks, already reduced before the shuffle; as rows, since a frame per id costs milliseconds
        first = min((row["valid_seq"] for row in rows if row["valid_seq"] is not None), default=None)
        if self.accepted.exists():
            first = -1
        elif first is not None:
            self.accepted.update((first,))
        if first is not None:
            yield Row(event_id=key[0], first_seq=first)

    def close(self) -> None:
        pass


def _smallest_by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One mark per id and batch of rows, before the shuffle: an id with a third of all events sends a row per batch."""
    for batch in batches:
        least = pa.Table.from_batches([batch]).group_by("event_id").aggregate([("valid_seq", "min")])
        yield from least.rename_columns(["event_id", "valid_seq"]).to_batches()


def first_accepted(marks: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """(event_id, first_seq) for every id of the micro-batch that is accepted in it or was before.

    `marks` has (event_id, valid_seq), with a null position for an event that is not valid; `keep_ms` bounds how long an id is
    remembered (processing time; for ever if none).
    """
    kind = "event_id string, valid_seq bigint"
    reduced = marks.mapInArrow(_smallest_by_id, kind)
    mode = "ProcessingTime" if keep_ms else "None"
    return reduced.groupBy("event_id").transformWithState(
        FirstAccepted(keep_ms), "event_id string, first_seq bigint", "Append", mode
    )


def route_keyed(stream: DataFrame, folder: str, checkpoint: str, *, keep_ms: int | None = None, **trigger) -> StreamingQuery:
    """Route a stream of (seq, event) as `route_stream` does, with accepted ids in keyed state.

    Tables accepted, dlq and duplicate lie under `folder`. Ids that `replay_keyed` recovers reach the state through a second
    source, so they are duplicates from the next micro-batch on.
    """
    spark = stream.sparkSession
    recovered = f"{folder}/recovered_ids"
    make_folder(spark, recovered)
    # a micro-batch may be one row group, and so one task's work; the events are dealt before they are parsed
    judged = judged_events(stream.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    named = judged.filter(F.coalesce("event_id", F.lit("")) != "")
    marks = named.select("event_id", F.when(F.col("_s_code").isNull(), F.col("seq").cast("bigint")).alias("valid_seq"))
    back = spark.readStream.schema("event_id string").option("recursiveFileLookup", "true").parquet(recovered)
    marks = marks.unionByName(back.select("event_id", F.lit(-1).cast("bigint").alias("valid_seq")))
    firsts = first_accepted(marks, keep_ms)
    both = judged.unionByName(firsts, allowMissingColumns=True)  # one output, so that events and first positions come together

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_until_end(spark):
            rows = stage(batch, "keyed-batch")
            of_ids = rows.filter(F.col("first_seq").isNotNull()).select(
                "event_id", F.col("first_seq").alias("_f"), F.lit(None).cast("bigint").alias("_g")
            )
            events = rows.filter(F.col("first_seq").isNull()).drop("first_seq")
            counts = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"))
            firsts, ids = stage_counted(of_ids.join(counts, "event_id"), "first-positions")
            write_routed(stage(decided(events, firsts, ids), "routed-batch"), folder, batch_id)

    with rocks_state(spark):
        return (
            both.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def replay_keyed(spark: SparkSession, folder: str, replay_id: int | None = None) -> DataFrame:
    """`replay_letters`, whose recovered ids are also handed to the running or the next stream."""
    statuses = replay_letters(spark, folder, replay_id)
    recovered = statuses.filter(F.col("replay") == "recovered").select("event_id")
    recovered.write.mode("append").parquet(f"{folder}/recovered_ids")  # an id that comes twice changes nothing
    return statuses


class OrderedLevels(StatefulProcessor):
    """The level of a run, folded over its batches in the order of their time.

    A batch waits in the state until the watermark has passed it: then no earlier one can come any more. A run that pauses for more
    than `idle_ms` of event time begins anew, and its state is dropped.
    """

    def __init__(self, config: ConcurrencyConfig, idle_ms: int) -> None:
        self.config, self.idle_ms = config, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.level = handle.getValueState("level", "level int, last bigint")
        self.waiting = handle.getMapState("waiting", "at bigint, batch bigint", "action int, reason string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for at, batch, action, reason in zip(frame["at"], frame["batch"], frame["action"], frame["reason"], strict=True):
                self.waiting.updateValue((int(at), int(batch)), (int(action), reason))
                self.handle.registerTimer(int(at))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, config = timerValues.getCurrentWatermarkInMs(), self.config
        ready = sorted((place, step) for place, step in self.waiting.iterator() if place[0] <= passed)
        level, last = self.level.get() if self.level.exists() else (config.initial, None)
        if not ready:
            if self.level.exists() and last + self.idle_ms <= passed and next(self.waiting.keys(), None) is None:
                self.level.clear()
            return
        out = []
        for (at, batch), (action, reason) in ready:
            if last is not None and at > last + self.idle_ms:
                level = config.initial
            before = level
            if action < 0:
                level = max(config.low, level // 2)
            elif action > 0:
                level = min(config.high, level + config.step)
            out.append((key[0], batch, before, level, reason))
            self.waiting.removeKey((at, batch))
            last = at
        self.level.update((level, last))
        self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame(out, columns=["run_id", "batch", "before", "after", "reason"])

    def close(self) -> None:
        pass


def ordered_levels(
    metrics: DataFrame, config: ConcurrencyConfig = ConcurrencyConfig(), *, lateness: str = "1 hour", idle_ms: int = 7 * 86_400_000
) -> DataFrame:
    """Level before and after every batch, from metrics (run_id, batch, ts, failure_rate, retry_rate, p95_ms) in any order.

    `ts` orders the batches of a run (ties by batch number). A batch may come up to `lateness` of event time after later ones
    and is folded in its place; what comes later than that is dropped. Start it inside `rocks_state`.
    """
    timed = metrics.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    action = decisions(timed.select("run_id", F.struct("batch", "ts").alias("batch"), "failure_rate", "retry_rate", "p95_ms"), config)
    steps = action.select(
        "run_id", F.col("batch.batch").cast("bigint").alias("batch"), F.col("batch.ts").alias("ts"), "action", "reason",
    ).withColumn("at", F.unix_millis("ts"))
    return steps.groupBy("run_id").transformWithStateInPandas(
        OrderedLevels(config, idle_ms), "run_id string, batch bigint, before int, after int, reason string", "Append", "EventTime"
    )
