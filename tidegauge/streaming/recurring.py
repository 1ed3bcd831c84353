"""Recurring jobs on a stream (ST-06)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scale import path_exists, remove_path

LOGGER = logging.getLogger(__name__)

Task = Callable[[DataFrame, int], object]


def guarded(task: Task, failed: str) -> Task:
    """Log a failing batch, keep its rows under `failed`, and let the next batch run.

    The stream counts the batch as done, so the kept rows are what `rework` works off later. If they cannot be
    kept, the error goes up and the stream stops before the batch is committed.
    """

    def run(batch: DataFrame, batch_id: int):
        try:
            return task(batch, batch_id)
        except Exception:
            LOGGER.exception("batch %s failed; its rows are kept and the next one runs", batch_id)
            batch.write.mode("overwrite").parquet(f"{failed}/failed_batch={batch_id}")
            return None

    return run


def rework(spark: SparkSession, task: Task, failed: str) -> list[int]:
    """Run the task on the batches kept under `failed`, oldest first; those that succeed are removed and returned."""
    if not path_exists(spark, failed):
        return []
    kept = spark.read.option("basePath", failed).parquet(f"{failed}/*")
    done = []
    for batch_id in sorted(r.failed_batch for r in kept.select("failed_batch").distinct().collect()):
        try:
            task(kept.filter(F.col("failed_batch") == batch_id).drop("failed_batch"), batch_id)
        except Exception:
            LOGGER.exception("batch %s failed again", batch_id)
            continue
        remove_path(spark, f"{failed}/failed_batch={batch_id}")
        done.append(batch_id)
    if len(done) and not path_left(spark, failed):
        remove_path(spark, failed)
    return done


def path_left(spark: SparkSession, folder: str) -> bool:
    """Whether a folder still holds batches."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/failed_batch=*")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def recurring(stream: DataFrame, task: Task, checkpoint: str, every_seconds: int | None = None) -> StreamingQuery:
    """Run a report for each micro-batch: everything available once, or every n seconds.

    Batches that failed in an earlier run are worked off first, so a batch is late but never lost.
    """
    if every_seconds is not None and every_seconds <= 0:
        raise ValueError("the interval must be at least one second")
    trigger = {"availableNow": True} if every_seconds is None else {"processingTime": f"{every_seconds} seconds"}
    failed = f"{checkpoint.rstrip('/')}-failed"
    rework(stream.sparkSession, task, failed)
    return (
        stream.writeStream.foreachBatch(guarded(task, failed))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
