"""Adaptive decision with kept state (ST-05)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import ConcurrencyConfig
from ..functions.shipping import ship_by_value
from ..operators.attempts import decision

ship_by_value(__name__)

TRACE = "run_id string, batch bigint, before int, after int, reason string"


def decisions(metrics: DataFrame, config: ConcurrencyConfig) -> DataFrame:
    """Batch metrics (run_id, batch, failure_rate, retry_rate, p95_ms) -> (run_id, batch, action, reason), on the JVM."""
    action, reason = decision(config)
    return metrics.select("run_id", "batch", action.alias("action"), reason.alias("reason"))


def adaptive_levels(metrics: DataFrame, config: ConcurrencyConfig = ConcurrencyConfig()) -> DataFrame:
    """Level before and after every batch; the level of a run is kept between micro-batches.

    The state is one number per run, and the rows that reach Python are one per batch of requests, already counted.
    """
    initial, low, high, step = config.initial, config.low, config.high, config.step

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level = state.get[0] if state.exists else initial
        rows = pd.concat(list(frames)).sort_values("batch")
        before, after = [], []
        for action in rows["action"]:
            before.append(level)
            if action < 0:
                level = max(low, level // 2)
            elif action > 0:
                level = min(high, level + step)
            after.append(level)
        state.update((level,))
        yield pd.DataFrame(
            {"run_id": key[0], "batch": rows["batch"], "before": before, "after": after, "reason": rows["reason"]}
        )

    return (
        decisions(metrics, config)
        .withColumn("batch", F.col("batch").cast("bigint"))
        .groupBy("run_id")
        .applyInPandasWithState(fold, TRACE, "level int", "append", GroupStateTimeout.NoTimeout)
    )
