"""Sinks (SNK-01..07, SRC-10)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header CSV in UTF-8. No byte-order mark: with many part files it would land inside the data."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, non-ASCII kept, nulls written."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_event_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSONL per run, in sequence order within each file (SNK-04).

    Range-partitioned on (run, sequence): a long run spreads over several files, each an unbroken stretch of it.
    """
    log.repartitionByRange("run_id", "sequence").sortWithinPartitions("run_id", "sequence").write.mode(mode).json(path)


def fresh_path(spark: SparkSession, folder: str, name: str, at: datetime | None = None) -> str:
    """Time-stamped output path that never overwrites: `_01`, `_02`, ... on collision (SRC-10)."""
    stamp = (at or datetime.now()).strftime("%Y%m%d_%H%M%S")
    base = f"{folder.rstrip('/')}/{name}_{stamp}"
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path, n = base, 0
    while fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
        n += 1
        path = f"{base}_{n:02d}"
    return path


def plan_text(df: DataFrame) -> str:
    """Formatted physical plan (SNK-06)."""
    name = f"plan_{abs(hash(df.semanticHash()))}"
    df.createOrReplaceTempView(name)
    try:
        return df.sparkSession.sql(f"EXPLAIN FORMATTED SELECT * FROM {name}").first()[0]
    finally:
        df.sparkSession.catalog.dropTempView(name)


def write_bundle(outputs: dict[str, tuple[DataFrame, str]], folder: str) -> None:
    """Several outputs of one run (SNK-07): name -> (frame, csv | parquet | json). Stage their common base first."""
    writers = {"csv": write_csv, "parquet": write_parquet, "json": write_json}
    for name, (df, kind) in outputs.items():
        writers[kind](df, f"{folder.rstrip('/')}/{name}")


def row_count(df: DataFrame) -> DataFrame:
    """Row count without loading columns (AGG-36)."""
    return df.agg(F.count(F.lit(1)).alias("n"))
