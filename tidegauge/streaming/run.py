"""Run a streaming query over everything available and hand back what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.scale import own_folder


def run_folder(spark: SparkSession, tag: str) -> str:
    return f"{own_folder(spark)}/stream-{tag}-{uuid.uuid4().hex}"


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table as a file stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def drain(result: DataFrame, tag: str, mode: str = "append") -> DataFrame:
    """All output of a streaming frame as a table; in `complete` mode the last micro-batch holds all of it."""
    if mode not in ("append", "complete"):
        raise ValueError("update mode has no single final table")
    spark = result.sparkSession
    folder = run_folder(spark, tag)

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/microbatch={n}")

    query = (
        result.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    out = spark.read.schema(StructType([*result.schema.fields, StructField("microbatch", LongType())])).parquet(f"{folder}/out")
    if mode == "complete":
        last = out.agg(F.max("microbatch")).first()[0]
        out = out.filter(F.col("microbatch") == last)
    return out.drop("microbatch")
