"""Readers (SRC-01, SRC-04..08, SRC-11)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.collections import at, json_fault, object_mark, parsed, type_of
from .gates import require_columns

# The texts a CSV cell may hold for "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    required: Iterable[str] = (),
    missing_texts: bool = False,
) -> DataFrame:
    """Header CSV, lazily and split by Spark. Declare the schema: inference costs a pass over the data."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    require_columns(df, required)
    return texts_to_null(df) if missing_texts else df


def texts_to_null(df: DataFrame, texts: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Turn the usual "missing" texts of string columns into null."""
    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.when(~F.col(c).isin(*texts), F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns]
    )


def stream_csv(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None):
    """The same CSV as a stream of files."""
    reader = spark.readStream.schema(schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def csv_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """SQL over a file path (SRC-06): a temp view on the CSV, ready for `spark.sql`."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} USING csv OPTIONS (path '{path}', header 'true', inferSchema 'true')")
    return spark.table(name)


def view(df: DataFrame, name: str) -> DataFrame:
    """SQL over a frame (SRC-07)."""
    df.createOrReplaceTempView(name)
    return df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dimension(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal dimension table (SRC-11)."""
    return spark.createDataFrame(list(rows), schema)


def envelope_status(envelopes: DataFrame, text: str = "value") -> DataFrame:
    """Check JSON envelopes {status, count, results[]} held as text: adds `envelope` and `fault` (SRC-08, JSN-01).

    Faults: malformed JSON (with position), not an object, results no list, a result no object, count mismatch.
    """
    v = F.col("envelope")
    found = F.col("_found")
    read = envelopes.withColumn("envelope", parsed(F.col(text))).withColumns(
        {
            "_top": object_mark(v),
            "_list": type_of(at(v, "results", "variant")),
            "_found": at(v, "results", "array<variant>"),
            "_declared": at(v, "count", "bigint"),
        }
    )
    number = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    mismatch = F.concat(
        F.lit("count ("), number(F.col("_declared")), F.lit(") differs from the number of results ("),
        F.size(found).cast("string"), F.lit(")"),
    )
    fault = (
        F.when(v.isNull(), F.lit("malformed"))
        .when(F.col("_top") != "OBJECT", F.lit("the top level must be an object"))
        .when(F.coalesce("_list", F.lit("")) != "ARRAY", F.lit("there is no results list"))
        .when(~F.forall(found, lambda r: type_of(r) == "OBJECT"), F.lit("results must hold objects only"))
        .when(~F.coalesce(F.col("_declared") == F.size(found), F.lit(False)), mismatch)
    )
    return read.withColumn("fault", fault).drop("_top", "_list", "_found", "_declared")


def envelope_records(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (row = 1-based position, record VARIANT) of the faultless envelopes."""
    return (
        checked.filter(F.col("fault").isNull())
        .select(*keep, F.posexplode(at(F.col("envelope"), "results", "array<variant>")).alias("pos", "record"))
        .select(*keep, (F.col("pos") + 1).alias("row"), "record")
    )


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON envelope files; any faulty file stops the job with its fault."""
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    checked = envelope_status(files)
    bad = checked.filter(F.col("fault").isNotNull()).select("file", "fault", "value").limit(1)
    first = bad.select(
        "file", F.when(F.col("fault") == "malformed", json_fault(F.col("value"))).otherwise(F.col("fault")).alias("f")
    ).first()
    if first:
        raise ValueError(f"{first['file']}: {first['f']}")
    return envelope_records(checked, ["file"])
