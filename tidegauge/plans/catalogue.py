"""The query catalogue: name -> (Spark query, equivalent SQL or None), filled by the modules of this folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    ids: tuple[str, ...]


CATALOGUE: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a query with the operator ids it exercises."""

    def add(run: Run) -> Run:
        if name in CATALOGUE:
            raise ValueError(f"query {name} exists")
        CATALOGUE[name] = Query(run, sql, tuple(ids.split()))
        return run

    return add


def load() -> dict[str, Query]:
    from . import attempt_queries, cleaning_queries, intake_queries, monitor_queries, record_queries, rollup_queries  # noqa: F401
    from . import scalar_queries, sink_queries, stream_queries  # noqa: F401

    return CATALOGUE
