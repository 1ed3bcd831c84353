"""What keeps the operators whole at any size: staging, running totals, hot keys, checked broadcasts.

Three rules hold everywhere in this package:

* a side is broadcast only after its row count was read from the staged table, or where it is a bound by proof;
* a key that may hold a large share of all rows is never one task's work;
* anything read twice by partition is written once to the shared folder, so a lost executor changes nothing.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of narrow key/number tables one task may order, and one executor may hold as a broadcast.
ONE_TASK_ROWS = 2_000_000
BROADCAST_ROWS = 500_000
# Rows per slice when a larger table is cut by range: each is one task's sort, and there should be many more than cores.
SLICE_ROWS = 250_000
MAX_SLICES = 20_000
# A key above this share of the rows counts as hot: at most 1 / HOT_SHARE such keys exist.
HOT_SHARE = 0.002
# Rows a task should take where every row costs much (parsing a record, passing a forest).
COSTLY_ROWS = 25_000
# The same where a row becomes a JSON record of some dozen leaves, each read and judged.
RECORD_ROWS = 10_000
# Rows of a hot key that one salt should hold.
SALT_ROWS = 250_000


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a temporary one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tidegauge-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{staging_root(spark)}/tidegauge/{spark.sparkContext.applicationId}"


def _on_file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; an unreachable one is an error, not an absent one."""
    system, found = _on_file_system(spark, path)
    return system.exists(found)


def make_folder(spark: SparkSession, path: str) -> None:
    system, found = _on_file_system(spark, path)
    system.mkdirs(found)


def remove_path(spark: SparkSession, path: str) -> None:
    system, found = _on_file_system(spark, path)
    system.delete(found, True)


def clear_staging(spark: SparkSession) -> None:
    """Remove what this application staged; frames read from staged tables end with it. Call it when a job is done."""
    remove_path(spark, own_folder(spark))


_OPEN_SCOPES: list[list[str]] = []


@contextmanager
def staged_until_end(spark: SparkSession):
    """Remove what is staged inside the block when it ends; for steps whose results are written before that."""
    _OPEN_SCOPES.append([])
    try:
        yield
    finally:
        for path in _OPEN_SCOPES.pop():
            remove_path(spark, path)


def stage(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write once to the shared folder and go on from the written table.

    Cuts lineage, survives lost executors, and gives Catalyst real file sizes for its join choice.
    """
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, tag: str = "table") -> tuple[DataFrame, int]:
    """Stage and read the row count from the written table."""
    staged = stage(df, tag)
    return staged, staged.count()


def spread(df: DataFrame, *, rows: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """Deal rows over tasks by their number, in front of work that is costly per row.

    A scan has at most a task per row group, and a million narrow rows may lie in one; sizes in bytes say nothing about that
    work either. `rows`, if given, is known to the caller (the frame is then not counted).
    """
    rows = df.count() if rows is None else rows
    tasks = min(MAX_SLICES, -(-rows // (rows_per_task or COSTLY_ROWS)))
    return df.repartition(tasks) if tasks > 1 else df


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weights: Sequence[str],
    *,
    rows: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add `<w>_before` and `<w>_total` for every weight: exclusive running sum and total within a key.

    Rows must be distinct on (keys, order). A table up to `one_task_rows` is ordered with one window. A larger one
    is cut by range over (keys, order) and written with its slice number; slice totals give each slice its offset,
    and the running sum is local to a slice. No key is ever gathered in one task, however large.
    `rows`, if given, is an upper bound known to the caller (the table is then not counted again).
    """
    keys = list(keys)
    if rows is None:
        df, rows = stage_counted(df, "ordered")
    if rows <= one_task_rows:
        by_key = Window.partitionBy(*(keys or [F.lit(0)]))
        before = by_key.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*",
            *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_before") for w in weights],
            *[F.sum(w).over(by_key).alias(f"{w}_total") for w in weights],
        )

    slices = max(2, min(MAX_SLICES, -(-rows // slice_rows)))
    cut = stage(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()), "sliced"
    )
    by_slice = cut.groupBy(*keys, "_slice").agg(*[F.sum(w).alias(f"_{w}") for w in weights])
    by_key = Window.partitionBy(*(keys or [F.lit(0)]))  # at most one row per slice and key
    before = by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_slice.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_slice").alias("_s"),
        *[F.coalesce(F.sum(f"_{w}").over(before), F.lit(0)).alias(f"_{w}_offset") for w in weights],
        *[F.sum(f"_{w}").over(by_key).alias(f"{w}_total") for w in weights],
    )
    on = cut["_slice"] == offsets["_s"]
    for i, k in enumerate(keys):
        on = on & cut[k].eqNullSafe(offsets[f"_k{i}"])
    local = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(offsets, on).select(
        *df.columns,
        *[
            (F.col(f"_{w}_offset") + F.coalesce(F.sum(w).over(local), F.lit(0))).alias(f"{w}_before")
            for w in weights
        ],
        *[f"{w}_total" for w in weights],
    )


def numbered_rows(df: DataFrame, order: Sequence[str], out: str, keys: Sequence[str] = (), **limits) -> DataFrame:
    """1-based position in the given order (unique on it), without a single-task sort of a large table.

    The rows may be wide, so they are counted by a column-pruned scan and written at most once.
    """
    limits.setdefault("rows", df.count())
    placed = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, ["_one"], **limits)
    return placed.withColumn(out, F.col("_one_before") + 1).drop("_one", "_one_before", "_one_total")


def carry_forward(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    out: str,
    *,
    rows: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Last non-null `value` at or before each row in a total order: an as-of join over the union of both sides.

    Like `running_totals`, cut by range once the table is larger than one task should order; each slice starts with
    the last value of the slices before it.
    """
    if rows is None:
        df, rows = stage_counted(df, "ordered")
    if rows <= one_task_rows:
        upto = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    slices = max(2, min(MAX_SLICES, -(-rows // slice_rows)))
    cut = stage(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "sliced")
    ends = cut.groupBy("_slice").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(F.col("_slice").alias("_s"), F.last("_end", ignorenulls=True).over(before).alias("_start"))
    local = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(F.broadcast(starts), F.col("_slice") == F.col("_s"))  # one row per slice, at most MAX_SLICES
        .withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("_start")))
        .drop("_slice", "_s", "_start")
    )


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], *, table_rows: int) -> DataFrame:
    """Left-join a table that is unique on its keys, whose row count (or a bound of it) the caller has read.

    Small: broadcast. Large: `salted_lookup`.
    """
    if table_rows <= BROADCAST_ROWS:
        return _left(rows, F.broadcast(table), list(keys))
    return salted_lookup(rows, table, keys)


def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    weight: str | None = None,
    salt_rows: int = SALT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Left-join a large unique table where single keys may hold a large share of `rows`.

    `weight` names the column of `table` that holds how many rows carry the key (counted here when absent). Keys above
    `hot_share` of the total, at most 1/hot_share of them, get one salt per `salt_rows` rows on both sides, so that the part
    of a salt does not grow with the key; all others keep salt 0.
    """
    keys = list(keys)
    if weight is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    else:
        sizes = table.select(*keys, F.col(weight).alias("_weight"))
    total = sizes.agg(F.sum("_weight").alias("t")).scalar()
    hot = sizes.filter(F.col("_weight") > F.greatest(total * hot_share, F.lit(1000))).select(
        *keys, F.greatest(F.ceil(F.col("_weight") / salt_rows), F.lit(2)).cast("int").alias("_hot")
    )
    marked_rows = _left(rows, F.broadcast(hot), keys)  # at most 1/hot_share rows by construction
    marked_table = _left(table, F.broadcast(hot), keys)
    spread = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_hot") - 1)).otherwise(F.array(F.lit(0)))
    # the partition number gives the same salt when a lost task runs again
    left = marked_rows.withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.spark_partition_id(), F.col("_hot"))).otherwise(F.lit(0))
    ).drop("_hot")
    right = marked_table.withColumn("_salt", F.explode(spread)).drop("_hot")
    return _left(left, right, [*keys, "_salt"]).drop("_salt")


def _left(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    renamed = table.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in table.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return rows.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])
