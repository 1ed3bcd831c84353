"""Views of the shared tables in the shape the operators work on, each with the same thing in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MonitorConfig
from ..sources.readers import table

CUT_DATE = "1998-06-01"
LINE_CONFIG = MonitorConfig(
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
    first_target="l_extendedprice",
)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line: order_id, region of the supplier, category of the part, quantity, price, discount, amount."""
    t = lambda name: table(spark, sf, name)
    regions = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
        t("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(regions.select("s_suppkey", "r_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("r_name").alias("region"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_discount").alias("discount"),
            (F.col("l_quantity") * F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        )
    )


SALES_SQL = """
sales AS (
  SELECT l_orderkey AS order_id, r_name AS region, p_type AS category, l_quantity AS quantity,
         l_extendedprice AS unit_price, l_discount AS discount,
         l_quantity * l_extendedprice * (1 - l_discount) AS amount
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales as an uncleaned text feed: gaps, unreadable dates and numbers, negative prices, outliers."""
    line, tax = F.col("l_linenumber"), F.col("l_tax")
    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "part").select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey")
    )
    text = lambda c: c.cast("string")
    return joined.select(
        text(F.col("l_orderkey")).alias("order_id"),
        F.when(line == 7, "unknown")
        .when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("region"),
        F.when(F.col("p_size") < 48, F.col("p_type")).alias("category"),
        F.when(tax == 0.08, "n/a")
        .when((line == 6) & (F.col("l_returnflag") == "A"), text(F.col("l_quantity") * 100))
        .otherwise(text(F.col("l_quantity")))
        .alias("quantity"),
        F.when(tax == 0.07, F.lit(None))
        .when((tax == 0.06) & (F.col("l_discount") == 0.1), text(-F.col("l_extendedprice")))
        .otherwise(text(F.col("l_extendedprice")))
        .alias("unit_price"),
        F.when(tax == 0.05, F.lit(None)).when(tax == 0.03, "1.5").otherwise(text(F.col("l_discount"))).alias("discount"),
    )


RAW_SALES_SQL = """
raw_sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS order_date,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS region,
         CASE WHEN p_size < 48 THEN p_type END AS category,
         CASE WHEN l_tax = 0.08 THEN NULL WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN l_quantity * 100
              ELSE l_quantity END AS quantity,
         CASE WHEN l_tax = 0.07 THEN NULL WHEN l_tax = 0.06 AND l_discount = 0.1 THEN -l_extendedprice
              ELSE l_extendedprice END AS unit_price,
         CASE WHEN l_tax = 0.05 THEN NULL WHEN l_tax = 0.03 THEN 1.5 ELSE l_discount END AS discount
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def customers(spark: SparkSession, sf: str, read=table) -> DataFrame:
    """Customers in the canonical schema of the monitor, with a period, missing charges and stray spaces."""
    n, b = F.col("c_nationkey"), F.col("c_acctbal")
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("seq"),
        n.alias("nation"),
        F.col("c_name").alias("customer_id"),
        F.when(n < 12, " Female ").when(n < 24, "Male").alias("gender"),
        (n >= 20).cast("int").alias("senior"),
        (n * 3).alias("tenure_months"),
        (F.abs(b) / 100).alias("monthly_charges"),
        F.when(b > 0, b * 2).alias("total_charges"),
        F.col("c_mktsegment").alias("contract"),
        F.when(n < 8, "Card").when(n < 16, "Transfer").otherwise("Check").alias("payment_method"),
        (n % 8 + 1).alias("num_services"),
        (b < 0).cast("int").alias("churn"),
        F.when(F.right("c_name", F.lit(1)) < "5", "reference").otherwise("current").alias("period"),
    )


CUSTOMERS_SQL = """
customers AS (
  SELECT c_custkey AS seq, c_nationkey AS nation, c_name AS customer_id,
         CASE WHEN c_nationkey < 12 THEN ' Female ' WHEN c_nationkey < 24 THEN 'Male' END AS gender,
         CAST(c_nationkey >= 20 AS INT) AS senior, c_nationkey * 3 AS tenure_months,
         abs(c_acctbal) / 100 AS monthly_charges, CASE WHEN c_acctbal > 0 THEN c_acctbal * 2 END AS total_charges,
         c_mktsegment AS contract,
         CASE WHEN c_nationkey < 8 THEN 'Card' WHEN c_nationkey < 16 THEN 'Transfer' ELSE 'Check' END AS payment_method,
         c_nationkey % 8 + 1 AS num_services, CAST(c_acctbal < 0 AS INT) AS churn,
         CASE WHEN right(c_name, 1) < '5' THEN 'reference' ELSE 'current' END AS period
  FROM customer)"""


def line_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Lines before and after a date; after it one flag's prices rise by a third up to a cap, a status splits and tax has gaps."""
    now = F.col("l_shipdate") >= F.lit(CUT_DATE).cast("timestamp_ntz")
    rise = now & (F.col("l_returnflag") == "A")
    return table(spark, sf, "lineitem").select(
        F.when(now, "current").otherwise("reference").alias("period"),
        "l_quantity",
        F.when(rise, F.least(F.col("l_extendedprice") * 1.35, F.lit(100000.0)))
        .otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"),
        "l_discount",
        F.when(~(now & (F.col("l_tax") == 0.08)), F.col("l_tax")).alias("l_tax"),
        "l_returnflag",
        F.when(now & (F.col("l_discount") == 0.1), "X").otherwise(F.col("l_linestatus")).alias("l_linestatus"),
    )


LINES_SQL = f"""
lines AS (
  SELECT CASE WHEN l_shipdate >= TIMESTAMP '{CUT_DATE}' THEN 'current' ELSE 'reference' END AS period, l_quantity,
         CASE WHEN l_shipdate >= TIMESTAMP '{CUT_DATE}' AND l_returnflag = 'A'
              THEN least(l_extendedprice * 1.35::DOUBLE, 100000.0::DOUBLE) ELSE l_extendedprice END AS l_extendedprice,
         l_discount,
         CASE WHEN l_shipdate >= TIMESTAMP '{CUT_DATE}' AND l_tax = 0.08 THEN NULL ELSE l_tax END AS l_tax,
         l_returnflag,
         CASE WHEN l_shipdate >= TIMESTAMP '{CUT_DATE}' AND l_discount = 0.1 THEN 'X' ELSE l_linestatus END AS l_linestatus
  FROM lineitem)"""


def attempt_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an attempt log: a day is a run, an item is a user's hour, an `error` is a failed attempt."""
    from ..operators.attempts import sequenced
    from ..operators.scale import numbered_rows

    events = table(spark, sf, "events").withColumns(
        {
            "run_id": F.date_format("ts", "yyyy-MM-dd"),
            "item_id": F.col("user_id") * 24 + F.hour("ts"),
        }
    )
    tried = numbered_rows(events, ["ts", "event_id"], "attempt", ["run_id", "item_id"])
    log = sequenced(tried, "run_id", "ts", "event_id")
    return log.select(
        "run_id",
        "sequence",
        F.lit("adaptive").alias("mode"),
        F.lit("extract").alias("phase"),
        F.when(F.col("event_type") == "error", "request_failed").otherwise("request_succeeded").alias("event_type"),
        "elapsed_ms",
        "item_id",
        F.col("attempt").cast("int").alias("attempt"),
        F.to_json(
            F.struct(
                F.col("event_type").alias("error_type"),
                F.col("props").alias("error"),
                (F.lit(50.0) * F.col("attempt")).alias("wait_ms"),
            )
        ).alias("detail"),
    )


LOG_SQL = """
log AS (
  SELECT run_id, item_id,
         row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS sequence,
         row_number() OVER (PARTITION BY run_id, item_id ORDER BY ts, event_id) AS attempt,
         (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY run_id))) / 1000.0::DOUBLE AS elapsed_ms,
         CASE WHEN event_type = 'error' THEN 'request_failed' ELSE 'request_succeeded' END AS event_type,
         event_type AS error_type, props AS error
  FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS run_id, user_id * 24 + hour(ts) AS item_id FROM events)),
done AS (
  SELECT run_id, item_id, CASE WHEN arg_max(event_type, sequence) = 'request_failed' THEN 'dead_letter' ELSE 'success' END AS status,
         max(attempt) AS attempts, greatest(max(attempt) - 1, 0) AS retries, max(elapsed_ms) - min(elapsed_ms) AS latency_ms,
         arg_max(error_type, sequence) AS error_type, arg_max(error, sequence) AS error
  FROM log GROUP BY run_id, item_id)"""
