"""What the sinks write, read back; and tables that are appended."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import attempts as A
from ..operators import drift as D
from ..operators import validate as V
from ..sources import sinks
from ..sources.readers import table
from ..streaming.run import run_folder
from .catalogue import query
from .record_queries import USER_ERRORS_SQL, checked_users
from .tables import LINES_SQL, LOG_SQL, attempt_log, line_periods


@query(
    "bundle_round_trip", "SNK-01 SNK-02 SNK-03 SNK-07",
    """SELECT kind, n_name, n, best FROM (VALUES ('csv'), ('json'), ('parquet')) k(kind),
         (SELECT n_name, count(c_custkey) AS n, round(max(c_acctbal), 2) AS best FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name)""",
)
def bundle_round_trip(spark, sf):
    """One summary in three formats, each read back with the types it has."""
    joined = table(spark, sf, "nation").join(table(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    summary = joined.groupBy("n_name").agg(F.count("c_custkey").alias("n"), F.round(F.max("c_acctbal"), 2).alias("best"))
    folder, kinds = run_folder(spark, "bundle"), ("csv", "parquet", "json")
    sinks.write_bundle({kind: (summary, kind) for kind in kinds}, folder)
    reader = spark.read.schema(summary.schema)
    back = {"csv": reader.option("header", True).csv(f"{folder}/csv"), "parquet": reader.parquet(f"{folder}/parquet"), "json": reader.json(f"{folder}/json")}
    rows = [df.withColumn("kind", F.lit(kind)) for kind, df in back.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "parquet_partitions", "SNK-02",
    "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus",
)
def parquet_partitions(spark, sf):
    """Orders written by status; each status is read back from its own folder."""
    folder = run_folder(spark, "orders")
    sinks.write_parquet(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), folder, partition_by=["o_orderstatus"])
    back = spark.read.parquet(folder)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers"))


@query(
    "event_log_round_trip", "SNK-04",
    f"""WITH {LOG_SQL} SELECT run_id, count(*) AS events, max(sequence) AS last, 0 AS out_of_order FROM log GROUP BY run_id""",
)
def event_log_round_trip(spark, sf):
    """The attempt log as JSON lines; inside each file the sequence of a run only rises."""
    folder = run_folder(spark, "log")
    sinks.write_event_log(attempt_log(spark, sf), folder)
    back = spark.read.schema("run_id string, sequence bigint").json(folder)
    placed = back.select("run_id", "sequence", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    before = F.lag("sequence").over(Window.partitionBy("file", "run_id").orderBy("line"))
    return placed.withColumn("before", before).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("events"), F.max("sequence").alias("last"), F.count_if(F.col("before") >= F.col("sequence")).alias("out_of_order")
    )


@query(
    "fresh_paths", "SRC-10",
    "SELECT path, n FROM (VALUES ('orders_20250102_030405'), ('orders_20250102_030405_01'), ('orders_20250102_030405_02')) p(path), (SELECT count(*) AS n FROM orders)",
)
def fresh_paths(spark, sf):
    """Three outputs of one second: none replaces another."""
    folder, at = run_folder(spark, "fresh"), datetime(2025, 1, 2, 3, 4, 5)
    for _ in range(3):
        sinks.write_parquet(table(spark, sf, "orders"), sinks.fresh_path(spark, folder, "orders", at))
    back = spark.read.parquet(f"{folder}/*")
    name = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return back.groupBy(name.alias("path")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "plan_text", "SNK-06",
    "SELECT count(*) AS n, TRUE AS filter_pushed, TRUE AS columns_pruned, TRUE AS one_stage FROM events WHERE value > 100",
)
def plan_text(spark, sf):
    """The written plan of a filtered scan, read back: its filter and its two columns reach the Parquet reader."""
    chosen = table(spark, sf, "events").filter("value > 100").select("event_type", "value")
    folder = run_folder(spark, "plan")
    spark.createDataFrame([(sinks.plan_text(chosen),)], "plan string").coalesce(1).write.text(folder)
    text = F.array_join(F.collect_list("value"), "\n")  # a plan's lines
    lines = spark.read.text(folder, wholetext=True).agg(text.alias("plan"))
    checked = lines.select(
        F.col("plan").rlike(r"PushedFilters: \[[^\]]*GreaterThan\(value,100").alias("filter_pushed"),
        F.col("plan").rlike(r"ReadSchema: struct<event_type:string,value:double>").alias("columns_pruned"),
        (~F.col("plan").contains("Exchange")).alias("one_stage"),
    )
    return chosen.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(checked))  # one row each


@query(
    "appended_periods", "SET-01",
    f"WITH {LINES_SQL} SELECT period, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lines GROUP BY period",
)
def appended_periods(spark, sf):
    lines = line_periods(spark, sf)
    part = lambda p: lines.filter(F.col("period") == p).drop("period")
    both = D.two_periods(part(D.REFERENCE), part(D.CURRENT))
    return both.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    "failures_of_both_stages", "SET-03",
    f"""WITH {USER_ERRORS_SQL}, {LOG_SQL.strip()}
        SELECT 'transform' AS stage, row AS id, len(errors) AS n_errors, '' AS error_type FROM errs WHERE len(errors) > 0
        UNION ALL SELECT 'extract', item_id, 0, coalesce(error_type, '') FROM done WHERE status = 'dead_letter'""",
)
def failures_of_both_stages(spark, sf):
    """Letters of the fetching stage and rows that failed validation, in one table."""
    letters = A.dead_letter_table(A.outcomes(attempt_log(spark, sf)))
    bad = V.invalid_rows(checked_users(spark, sf), ["row"], "text")
    failed = bad.select("stage", F.col("row").alias("id"), F.size("errors").cast("bigint").alias("n_errors"))
    both = failed.unionByName(letters.select("stage", "id", "error_type"), allowMissingColumns=True)
    return both.fillna(0, ["n_errors"]).fillna("", ["error_type"])


@query(
    "map_value_rule", "VAL-12",
    """SELECT event_id, CASE WHEN user_id % 7 = 3 THEN 'counts:map_type' WHEN user_id % 7 = 5 THEN 'counts:value_error' ELSE '' END AS errors FROM events""",
)
def map_value_rule(spark, sf):
    """A record whose map of counts must hold no negative number."""
    seventh = F.col("user_id") % 7
    value = F.when(seventh == 3, '"none"').when(seventh == 5, '{"a":1,"b":-1}').otherwise('{"a":1,"b":0}')
    records = table(spark, sf, "events").select("event_id", F.concat(F.lit('{"counts":'), value, F.lit("}")).alias("text"))
    checked = V.validate(records.withColumn("record", F.try_parse_json("text")), "record", (V.Field("counts", "map<int>", element_ge=0),))
    marks = F.transform("errors", lambda e: F.concat_ws(":", e["loc"], e["type"]))
    return checked.select("event_id", F.array_join(marks, ";").alias("errors"))
