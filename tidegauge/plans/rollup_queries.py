"""Roll-ups, pivots, KPI tables and top-k on the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators.clean import join_check, join_dimension
from ..operators.compare import compare, compare_by_digests
from ..operators.quantiles import quantiles
from ..operators.scale import own_folder
from ..sources.readers import csv_view, dimension, read_csv, table, view
from ..sources.sinks import row_count, write_csv
from .catalogue import query
from .tables import SALES_SQL, sales

# The part types, and a literal dimension over them.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MANAGERS = (
    ("ECONOMY", "Ada"), ("LARGE", "Ben"), ("MEDIUM", "Cleo"), ("PROMO", "Dan"), ("SMALL", "Eve"), ("STANDARD", "Finn"),
)
MANAGERS_SQL = "managers(category, manager) AS (VALUES " + ", ".join(f"('{c}', '{m}')" for c, m in MANAGERS) + ")"


@query(
    "event_type_summary", "FLT-01 AGG-03 AGG-04 ORD-01 SRC-05",
    """SELECT event_type, count(*) AS n_rows, count(value) AS n_values, round(avg(value), 6) AS mean_value,
              round(sum(value), 2) AS sum_value
       FROM events WHERE value > 10 GROUP BY event_type ORDER BY event_type""",
)
def event_type_summary(spark, sf):
    events = table(spark, sf, "events").filter(F.col("value") > 10)
    s = A.summary(events, ["event_type"], "value")
    return s.select(
        "event_type", "n_rows", "n_values", F.round("mean_value", 6).alias("mean_value"), F.round("sum_value", 2).alias("sum_value")
    ).orderBy("event_type")


@query(
    "event_type_summary_sql", "SRC-07 AGG-12",
    """SELECT event_type, count(*) AS n_rows, count(value) AS n_values, round(avg(value), 6) AS mean_value,
              round(sum(value), 2) AS sum_value
       FROM events WHERE value > 10 GROUP BY event_type""",
)
def event_type_summary_sql(spark, sf):
    view(table(spark, sf, "events"), "tidegauge_events")
    return spark.sql(
        """SELECT event_type, count(*) AS n_rows, count(value) AS n_values, round(avg(value), 6) AS mean_value,
                  round(sum(value), 2) AS sum_value
           FROM tidegauge_events WHERE value > 10 GROUP BY event_type"""
    )


def log_rows(spark, sf):
    """Events as web-log rows."""
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("ip"),
        F.when(F.col("event_type") == "error", "500").when(F.col("event_type") == "signup", "301").otherwise("200").alias("status"),
        F.get_json_object("props", "$.k").alias("path"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").substr(12, 2).alias("hour"),
    )


LOG_ROWS_SQL = """
log_rows AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ip,
         CASE WHEN event_type = 'error' THEN '500' WHEN event_type = 'signup' THEN '301' ELSE '200' END AS status,
         regexp_extract(props, '"k": *([0-9]+)', 1) AS path, strftime(ts, '%H') AS hour
  FROM events)"""


@query(
    "log_rollup", "AGG-01 STR-06 SRC-01",
    f"""WITH {LOG_ROWS_SQL}
        SELECT 'total' AS dimension, NULL AS key, count(*) AS n, min(event_id) AS first_pos FROM log_rows
        UNION ALL SELECT 'status', status, count(*), min(event_id) FROM log_rows GROUP BY status
        UNION ALL SELECT 'path', path, count(*), min(event_id) FROM log_rows GROUP BY path
        UNION ALL SELECT 'hour', hour, count(*), min(event_id) FROM log_rows GROUP BY hour
        UNION ALL SELECT 'ip', ip, count(*), min(event_id) FROM log_rows GROUP BY ip""",
)
def log_rollup(spark, sf):
    return A.keyed_counts(log_rows(spark, sf), ["status", "path", "hour", "ip"], order="event_id")


@query(
    "error_rate", "AGG-02 STR-05",
    f"""WITH {LOG_ROWS_SQL}
        SELECT count(*) AS total, count(*) FILTER (starts_with(status, '5')) AS errors,
               round(100.0::DOUBLE * count(*) FILTER (starts_with(status, '5')) / count(*), 6) AS error_pct FROM log_rows""",
)
def error_rate(spark, sf):
    return A.error_rate(log_rows(spark, sf), "status").withColumn("error_pct", F.round("error_pct", 6))


@query(
    "top_users", "ORD-02",
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, min(event_id) LIMIT 5",
)
def top_users(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_pos"))
    return A.top_k(counts, 5, F.desc("n"), F.asc("first_pos")).drop("first_pos")


@query(
    "top_paths", "ORD-02",
    f"WITH {LOG_ROWS_SQL} SELECT path, count(*) AS n FROM log_rows GROUP BY path ORDER BY n DESC, min(event_id) LIMIT 5",
)
def top_paths(spark, sf):
    counts = log_rows(spark, sf).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_pos"))
    return A.top_k(counts, 5, F.desc("n"), F.asc("first_pos")).drop("first_pos")


@query("row_count", "AGG-36", "SELECT count(*) AS n FROM lineitem")
def rows(spark, sf):
    return row_count(table(spark, sf, "lineitem"))


@query(
    "category_summary", "PRJ-01 AGG-05 ORD-04",
    f"""WITH {SALES_SQL}
        SELECT category, count(order_id) AS orders, round_even(avg(unit_price), 2) AS avg_price,
               round_even(sum(quantity), 2) AS total_quantity, round_even(sum(amount), 2) AS total_sales
        FROM sales GROUP BY category ORDER BY total_sales DESC""",
)
def category_summary(spark, sf):
    return A.category_summary(sales(spark, sf))


@query(
    "region_category_pivot", "AGG-06",
    f"""WITH {SALES_SQL} SELECT region, """
    + ", ".join(f"round_even(sum(CASE WHEN category = '{c}' THEN amount ELSE 0 END), 0) AS \"{c}\"" for c in CATEGORIES)
    + " FROM sales GROUP BY region",
)
def region_category_pivot(spark, sf):
    return A.pivot_sum(sales(spark, sf), "region", "category", "amount", CATEGORIES)


@query(
    "manager_join", "JN-01 SRC-11",
    f"""WITH {SALES_SQL}, {MANAGERS_SQL}
        SELECT manager, count(*) AS n, round(sum(quantity), 2) AS quantity
        FROM sales LEFT JOIN managers USING (category) GROUP BY manager""",
)
def manager_join(spark, sf):
    managers = dimension(spark, MANAGERS, "category string, manager string")
    joined = join_dimension(sales(spark, sf), managers, "category", "manager")
    return joined.groupBy("manager").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("quantity"), 2).alias("quantity"))


@query(
    "manager_join_check", "JN-01",
    f"""WITH {SALES_SQL}, managers(category, manager) AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{m}')" for c, m in MANAGERS[:5])}))
        SELECT (SELECT count(*) FROM sales) AS rows_before, count(*) AS rows_after, count(*) FILTER (manager IS NULL) AS unmatched
        FROM sales LEFT JOIN managers USING (category)""",
)
def manager_join_check(spark, sf):
    managers = dimension(spark, MANAGERS[:5], "category string, manager string")
    return join_check(sales(spark, sf), managers, "category", "manager")


SOME_IDS_SQL = "SELECT CASE WHEN order_id % 97 <> 0 THEN order_id END AS order_id, amount FROM sales"
REPORT_SQL = f"""WITH {SALES_SQL},
per_order AS (SELECT order_id, sum(amount) AS amount FROM ({SOME_IDS_SQL}) GROUP BY order_id),
ranked AS (
  SELECT section, label, value, row_number() OVER (PARTITION BY section ORDER BY value DESC, label)::INT AS rank
  FROM (SELECT 'category' AS section, category AS label, sum(amount) AS value FROM sales GROUP BY category
        UNION ALL SELECT 'region', region, sum(amount) FROM sales GROUP BY region))
SELECT 'kpi' AS section, 'orders' AS label, CAST(count(order_id) AS DOUBLE) AS value, 1 AS rank FROM per_order
UNION ALL SELECT 'kpi', 'net_sales', round_even(sum(amount), 0), 2 FROM per_order
UNION ALL SELECT 'kpi', 'mean_order_value', round_even(avg(amount) FILTER (order_id IS NOT NULL), 0), 3 FROM per_order
UNION ALL SELECT 'kpi', 'regions', CAST(count(DISTINCT region) AS DOUBLE), 4 FROM sales
UNION ALL SELECT section, label, round(value, 2), rank FROM ranked WHERE section = 'region' OR rank <= 3"""


@query("sales_report", "REP-01 AGG-08 AGG-09 ORD-03 ORD-04 NUM-03", REPORT_SQL)
def sales_report(spark, sf):
    return A.sales_report(without_some_ids(sales(spark, sf)), 3).withColumn("value", F.round("value", 2))


def without_some_ids(rows):
    """Sales in which every 97th order has lost its id."""
    return rows.withColumn("order_id", F.when(F.col("order_id") % 97 != 0, F.col("order_id")))


@query(
    "kpi", "AGG-08 AGG-09",
    f"""WITH {SALES_SQL}, per_order AS (SELECT order_id, sum(amount) AS amount FROM ({SOME_IDS_SQL}) GROUP BY order_id)
        SELECT count(order_id) AS orders, round_even(sum(amount), 0) AS net_sales,
               round_even(avg(amount) FILTER (order_id IS NOT NULL), 0) AS mean_order_value,
               (SELECT count(DISTINCT region) FROM sales) AS regions FROM per_order""",
)
def kpi(spark, sf):
    return A.kpi(without_some_ids(sales(spark, sf)))


@query(
    "status_priority_counts", "AGG-07",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority",
)
def status_priority_counts(spark, sf):
    return A.cross_tab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query(
    "class_profile", "AGG-10",
    """SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price, round(avg(year(o_orderdate)), 6) AS mean_year
       FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus""",
)
def class_profile(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("o_totalprice"), 4).alias("mean_price"),
            F.round(F.avg(F.year("o_orderdate")), 6).alias("mean_year"),
        )
        .orderBy("o_orderstatus")
    )


@query(
    "segment_rate", "AGG-11",
    """SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END), 6) AS rate
       FROM orders GROUP BY o_orderpriority ORDER BY rate""",
)
def segment_rate(spark, sf):
    return A.rate_by(table(spark, sf, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F").withColumn("rate", F.round("rate", 6))


PROFILE = """SELECT c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 6) AS mean_balance,
                    round(avg(CASE WHEN c_acctbal < 0 THEN 1.0D ELSE 0.0D END), 6) AS negative_rate
             FROM {table} GROUP BY c_mktsegment"""


def _profile(df):
    return df.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("c_acctbal"), 6).alias("mean_balance"),
        F.round(F.avg((F.col("c_acctbal") < 0).cast("double")), 6).alias("negative_rate"),
    )


@query("contract_profile", "AGG-12", PROFILE.format(table="customer").replace("1.0D", "1.0::DOUBLE").replace("0.0D", "0.0::DOUBLE"))
def contract_profile(spark, sf):
    return _profile(table(spark, sf, "customer"))


@query(
    "profile_parity", "SET-05 SRC-07",
    """SELECT 0 AS only_first, 0 AS only_second, 0 AS cells_off, count(DISTINCT c_mktsegment) AS rows, true AS equal FROM customer""",
)
def profile_parity(spark, sf):
    customers = table(spark, sf, "customer")
    view(customers, "tidegauge_customer")
    by_sql = spark.sql(PROFILE.format(table="tidegauge_customer"))
    return compare(_profile(customers), by_sql, ["c_mktsegment"], ["customers", "mean_balance", "negative_rate"])


@query(
    "orders_parity", "SET-05",
    """SELECT t.name, CASE WHEN name = 'changed' THEN count(*) FILTER (o_orderkey % 5000 = 3) ELSE 0 END AS only_first, 0::BIGINT AS only_second,
              CASE WHEN name = 'changed' THEN count(*) FILTER (o_orderkey % 5000 = 7) ELSE 0 END AS cells_off, count(*) AS rows,
              name <> 'changed' OR count(*) FILTER (o_orderkey % 5000 IN (3, 7)) = 0 AS equal, name = 'same' OR NULL AS without_join
       FROM orders, (VALUES ('same'), ('near'), ('changed')) AS t(name) GROUP BY name""",
)
def orders_parity(spark, sf):
    """Orders against themselves, against prices with small errors, and against a copy with a few changed and missing rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    others = {
        "same": orders.repartition(3, "o_orderstatus"),
        "near": orders.withColumn("o_totalprice", price * (1 + F.lit(1e-13) * (key % 7))),
        "changed": orders.withColumn("o_totalprice", F.when(key % 5000 == 7, price + 1).otherwise(price)).filter(key % 5000 != 3),
    }
    rows = None
    for name, other in others.items():
        found = compare_by_digests(orders, other, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
        row = found.select(
            F.lit(name).alias("name"), "only_first", "only_second", "cells_off", "rows", "equal",
            F.when(F.lit(name == "same"), F.col("joined_rows") == 0).alias("without_join"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "head_sample", "ORD-08 PRJ-02",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 50",
)
def head_sample(spark, sf):
    return A.top_k(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), 50, F.asc("o_orderkey"))


@query(
    "top_orders", "ORD-03",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_orders(spark, sf):
    return A.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "priority_ranking", "AGG-37 AGG-24 AGG-25",
    """WITH m AS (SELECT o_orderpriority, median(o_totalprice) AS mid FROM orders GROUP BY o_orderpriority)
       SELECT o_orderpriority, round(mid, 4) AS mid, round(mid / (SELECT min(mid) FROM m), 8) AS ratio,
              o_orderpriority = (SELECT arg_min(o_orderpriority, mid) FROM m) AS fastest FROM m""",
)
def priority_ranking(spark, sf):
    q = quantiles(table(spark, sf, "orders"), "o_totalprice", [0.5], ["o_orderpriority"])
    ranked = A.ratio_to_best(q.select("o_orderpriority", F.col("q")[0].alias("mid")), "o_orderpriority", "mid")
    return ranked.select("o_orderpriority", F.round("mid", 4).alias("mid"), F.round("ratio", 8).alias("ratio"), "fastest")


@query(
    "bar_scale", "AGG-32 FLT-06",
    """WITH s AS (SELECT o_orderpriority, sum(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority)
       SELECT o_orderpriority, round(v / greatest((SELECT max(v) FROM s), 0.001), 8) AS width FROM s""",
)
def bar_scale(spark, sf):
    shown = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    sums = shown.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    return A.scaled_to_max(sums, "v", "w").select("o_orderpriority", F.round("w", 8).alias("width"))


@query(
    "box_plot", "REP-04 AGG-19 AGG-23",
    """SELECT c_mktsegment, c_acctbal < 0 AS negative, count(*) AS n, round(min(c_acctbal), 4) AS low,
              round(quantile_cont(c_acctbal, 0.25), 4) AS q1, round(quantile_cont(c_acctbal, 0.5), 4) AS median,
              round(quantile_cont(c_acctbal, 0.75), 4) AS q3, round(max(c_acctbal), 4) AS high
       FROM customer GROUP BY ALL""",
)
def box_plot(spark, sf):
    df = table(spark, sf, "customer").withColumn("negative", F.col("c_acctbal") < 0)
    box = A.five_numbers(df, ["c_mktsegment", "negative"], "c_acctbal")
    return box.select("c_mktsegment", "negative", "n", *[F.round(c, 4).alias(c) for c in ("low", "q1", "median", "q3", "high")])


@query(
    "segment_modes", "AGG-22",
    """WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS p FROM orders GROUP BY ALL)
       SELECT o_orderstatus, arg_max(o_orderpriority, n * 100000000 - p) AS top FROM c GROUP BY o_orderstatus""",
)
def segment_modes(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("p")
    )
    return A.most_frequent(counts, ["o_orderstatus"], "o_orderpriority", "n", "p")


@query(
    "csv_summary", "SRC-04 SRC-05 SRC-06",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS first_order,
              count(*) FILTER (o_orderstatus = 'F') AS finished
       FROM orders GROUP BY o_orderpriority""",
)
def csv_summary(spark, sf):
    """Orders written as CSV, read back once with a declared schema and once through SQL over the path."""
    folder = f"{own_folder(spark)}/orders-csv-{uuid.uuid4().hex}"
    write_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"), folder)
    csv_view(spark, "tidegauge_orders_csv", folder)
    by_sql = spark.sql(
        "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM tidegauge_orders_csv GROUP BY o_orderpriority"
    )
    schema = "o_orderkey bigint, o_orderpriority string, o_orderstatus string, o_totalprice double"
    by_frame = (
        read_csv(spark, folder, schema, required=["o_orderkey", "o_orderstatus"])
        .groupBy("o_orderpriority")
        .agg(F.min("o_orderkey").alias("first_order"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))
    )
    return by_sql.join(by_frame, "o_orderpriority")
