"""Labels for learning: which rows are held out, and a bounded sample of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound of labelled documents a classifier is fitted on; fewer labels are all used.
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text has the remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(
    labels: DataFrame, label: str, modulus: int, remainder: int, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, y) of at most about `rows` labelled documents that are not held out, chosen by a hash of the id.

    Null labels and ids are left out; a document with several labels counts with the largest.
    """
    usable = (
        labels.select("doc_id", F.col(label).alias("y"))
        .filter("doc_id IS NOT NULL AND y IS NOT NULL")
        .filter(~held_out(F.col("doc_id"), modulus, remainder))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    count = usable.count()
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, rows / max(count, 1)) * (1 << 30))
    return usable.filter(part) if count > rows else usable
