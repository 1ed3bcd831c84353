"""Keyed fetch from a service as an ingestion job (SRC-09, LOG-02, LOG-06)."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as WaitTimeout

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shipping import ship_by_value

ship_by_value(__name__)

FETCHED = "id bigint, payload string, error_type string, error string, attempts int, retries int"


def backoff(base: float, attempt: Column) -> Column:
    """Wait after a failed attempt: base * 2^(attempt - 1)."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def fetch(
    ids: DataFrame,
    call: Callable[[int, int], dict],
    *,
    max_concurrent: int = 10,
    max_attempts: int = 3,
    timeout_seconds: float = 1.0,
    backoff_seconds: float = 0.05,
    retriable: tuple[type[Exception], ...] = (),
) -> DataFrame:
    """Fetch every id of column `id`; one row each with the payload (JSON text) or the final error.

    The number of partitions is the gate: at most `max_concurrent` requests run at once. Time-outs and `retriable`
    errors are tried again; any other error ends the id, never the job. A lost task fetches its ids again, so `call`
    must be safe to repeat.
    """
    if max_concurrent < 1 or max_attempts < 1:
        raise ValueError("max_concurrent and max_attempts must be at least 1")
    again = (TimeoutError, WaitTimeout, *retriable)

    def one(item: int, pool: list[ThreadPoolExecutor]) -> tuple:
        last: Exception | None = None
        for attempt in range(1, max_attempts + 1):
            try:
                payload = pool[0].submit(call, item, attempt).result(timeout=timeout_seconds)
                return item, json.dumps(payload, ensure_ascii=False), None, None, attempt, attempt - 1
            except again as e:
                last = e
                if isinstance(e, WaitTimeout):  # the stuck call keeps its thread; go on with a new one
                    pool[0].shutdown(wait=False)
                    pool[0] = ThreadPoolExecutor(1)
                if attempt < max_attempts:
                    time.sleep(backoff_seconds * 2 ** (attempt - 1))
            except Exception as e:
                return item, None, type(e).__name__, str(e), attempt, attempt - 1
        text = f"id {item}: gave up after {max_attempts} attempts ({last})"
        return item, None, type(last).__name__, text, max_attempts, max_attempts - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = [ThreadPoolExecutor(1)]
        for batch in batches:
            rows = [one(int(i), pool) for i in batch["id"]]
            yield pd.DataFrame(rows, columns=["id", "payload", "error_type", "error", "attempts", "retries"])
        pool[0].shutdown(wait=False)

    gated = ids.select(F.col("id").cast("bigint")).repartition(max_concurrent, "id")
    return gated.mapInPandas(run, FETCHED)


def dead_letters(fetched: DataFrame, stage: str = "extract") -> DataFrame:
    return fetched.filter(F.col("payload").isNull()).select(
        "id", F.lit(stage).alias("stage"), "error_type", "error", "attempts"
    )


def retry_metrics(fetched: DataFrame) -> DataFrame:
    """Requested, collected, failed and total retries (AGG-35)."""
    return fetched.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count("payload").alias("collected"),
        F.count_if(F.col("payload").isNull()).alias("failed"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"),
    )


def retries_by_id(fetched: DataFrame) -> DataFrame:
    """One row per id that was tried again (AGG-35); a table, as the map could outgrow one row."""
    return fetched.filter(F.col("retries") > 0).select("id", "retries")
