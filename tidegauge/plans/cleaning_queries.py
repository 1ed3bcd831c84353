"""Quality, quantiles and the cleaning recipes on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CANONICAL_FIELDS, NUMERIC_FEATURES
from ..functions.numeric import masked, positive_or_null, rounded, scaled_with_cap
from ..operators import clean as C
from ..operators.aggregate import category_summary, pivot_sum
from ..operators.profile import casualties, null_rates, quality_snapshot
from ..operators.quantiles import quantiles
from ..operators.scale import stage
from ..sources.gates import domain_check, require_columns, require_rows, surplus_ids
from ..sources.readers import table
from .catalogue import query
from .tables import CUSTOMERS_SQL, RAW_SALES_SQL, customers, raw_sales


def canonical(spark, sf):
    return customers(spark, sf).select(*CANONICAL_FIELDS)


@query(
    "null_rates", "AGG-14",
    f"WITH {CUSTOMERS_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 8) AS missing_rate FROM customers"
        for c in CANONICAL_FIELDS
    ),
)
def null_rates_query(spark, sf):
    return null_rates(canonical(spark, sf)).withColumn("missing_rate", F.round("missing_rate", 8))


@query(
    "quality_snapshot", "AGG-13 AGG-15 AGG-17 AGG-18 NUL-02",
    f"""WITH {RAW_SALES_SQL}
        SELECT count(*) AS rows, count(*) - count(DISTINCT order_id) AS duplicate_ids,
               CAST(sum((region IS NULL)::INT + (category IS NULL)::INT) AS BIGINT)
                 + (SELECT count(*) FROM lineitem WHERE l_tax IN (0.07, 0.05)) AS missing_cells,
               round((sum((region IS NULL)::INT + (category IS NULL)::INT)
                 + (SELECT count(*) FROM lineitem WHERE l_tax IN (0.07, 0.05)))::DOUBLE / (count(*) * 7), 8) AS missing_rate,
               (SELECT count(*) FROM lineitem WHERE l_tax = 0.08) AS numeric_coercions
        FROM raw_sales""",
)
def quality(spark, sf):
    snap = quality_snapshot(raw_sales(spark, sf), "order_id", ["quantity", "unit_price", "discount"])
    return snap.withColumn("missing_rate", F.round("missing_rate", 8))


@query("surplus_ids", "AGG-15 VAL-13", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_ids FROM lineitem")
def surplus(spark, sf):
    return surplus_ids(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "domain_check", "AGG-16 VAL-13 SRC-02 SRC-03",
    """SELECT count(*) FILTER (quality IS NULL) AS nulls, count(*) FILTER (quality NOT IN (0, 1)) AS foreign_values,
              count(*) FILTER (quality IS NULL OR quality NOT IN (0, 1)) = 0 AND count(DISTINCT quality) = 2 AS exact_domain
       FROM labels""",
)
def domain(spark, sf):
    labels = require_rows(require_columns(table(spark, sf, "labels"), ["doc_id", "quality"]))
    return domain_check(labels, "quality", (0, 1))


@query(
    "coercion_casualties", "AGG-17 NUM-01",
    "SELECT count(*) FILTER (l_tax = 0.08) AS quantity, 0 AS unit_price FROM lineitem",
)
def lost(spark, sf):
    return raw_sales(spark, sf).agg(casualties("quantity").alias("quantity"), casualties("unit_price").alias("unit_price"))


@query(
    "winsorize_bounds", "CLN-01 AGG-19",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(q[1], 6) AS q1, round(q[2], 6) AS q3,
                   round(greatest(q[1] - 1.5::DOUBLE * (q[2] - q[1]), 0.0::DOUBLE), 6) AS lower, round(q[2] + 1.5::DOUBLE * (q[2] - q[1]), 6) AS upper
            FROM (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM lineitem)"""
        for c in ("l_extendedprice", "l_quantity")
    ),
)
def winsorize_bounds(spark, sf):
    b = C.winsorize_bounds(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], minimum=0.0)
    return b.select("feature", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower", "upper")])


@query(
    "winsorized", "CLN-01 NUM-02 JN-05",
    """WITH b AS (SELECT q[1] - 0.5::DOUBLE * (q[2] - q[1]) AS low, q[2] + 0.5::DOUBLE * (q[2] - q[1]) AS high
                  FROM (SELECT quantile_cont(o_totalprice, [0.25, 0.75]) AS q FROM orders))
       SELECT o_orderkey, round(greatest(low, least(high, o_totalprice)), 4) AS o_totalprice FROM orders, b""",
)
def winsorized(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return C.winsorize(orders, ["o_totalprice"], factor=0.5).withColumn("o_totalprice", F.round("o_totalprice", 4))


CLEAN_A_SQL = f"""WITH {RAW_SALES_SQL},
t AS (SELECT order_id, order_date, coalesce(region, 'Unknown') AS region, coalesce(category, 'Unknown') AS category, quantity,
             CASE WHEN unit_price > 0 THEN unit_price END AS unit_price,
             greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(discount, 0))) AS discount FROM raw_sales),
g AS (SELECT category, median(unit_price) AS m FROM t GROUP BY category),
u AS (SELECT t.* EXCLUDE (unit_price), coalesce(unit_price, m) AS unit_price FROM t LEFT JOIN g USING (category)),
d AS (SELECT quantile_cont(epoch_us(order_date)::DOUBLE, 0.5) AS date_us, median(unit_price) AS price, median(quantity) AS quantity FROM u),
v AS (SELECT order_id, coalesce(order_date, make_timestamp(trunc(date_us)::BIGINT)) AS order_date, region, category,
             coalesce(u.quantity, d.quantity) AS quantity, coalesce(unit_price, price) AS unit_price, discount FROM u, d),
q AS (SELECT quantile_cont(unit_price, [0.25, 0.75]) AS p, quantile_cont(quantity, [0.25, 0.75]) AS n FROM v),
b AS (SELECT greatest(p[1] - 1.5::DOUBLE * (p[2] - p[1]), 0.0::DOUBLE) AS p_low, p[2] + 1.5::DOUBLE * (p[2] - p[1]) AS p_high,
             greatest(n[1] - 1.5::DOUBLE * (n[2] - n[1]), 0.0::DOUBLE) AS n_low, n[2] + 1.5::DOUBLE * (n[2] - n[1]) AS n_high FROM q),
c AS (SELECT order_id, order_date, region, category, greatest(n_low, least(n_high, quantity)) AS quantity,
             greatest(p_low, least(p_high, unit_price)) AS unit_price, discount FROM v, b)"""


@query(
    "clean_a", "CLN-02 WIN-01 DT-01 DT-02 PRJ-07 NUL-01 NUM-01 NUM-02",
    CLEAN_A_SQL + """
SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, region, category, round(quantity, 4) AS quantity,
       round(unit_price, 4) AS unit_price, discount, round(quantity * unit_price * (1 - discount), 6) AS amount FROM c""",
)
def clean_a(spark, sf):
    clean, _ = C.clean_sales(raw_sales(spark, sf))
    return clean.select(
        "order_id",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        "region",
        "category",
        rounded(F.col("quantity"), 4).alias("quantity"),
        rounded(F.col("unit_price"), 4).alias("unit_price"),
        "discount",
        rounded(F.col("amount"), 6).alias("amount"),
    )


@query(
    "clean_a_metrics", "CLN-05 AGG-13 AGG-23",
    CLEAN_A_SQL + """
SELECT (SELECT count(*) FROM c) AS rows,
       (SELECT CAST(sum((region IS NULL)::INT + (category IS NULL)::INT) AS BIGINT) FROM raw_sales)
         + (SELECT count(*) FROM lineitem WHERE l_tax IN (0.07, 0.05)) AS missing_before, 0 AS missing_after,
       (SELECT max(unit_price) FROM raw_sales) AS max_price_before, round((SELECT max(unit_price) FROM c), 4) AS max_price_after,
       (SELECT max(quantity) FROM raw_sales) AS max_quantity_before, round((SELECT max(quantity) FROM c), 4) AS max_quantity_after,
       round(p_low, 4) AS price_lower, round(p_high, 4) AS price_upper, round(n_low, 4) AS quantity_lower, round(n_high, 4) AS quantity_upper,
       round((SELECT sum(quantity * unit_price * (1 - discount)) FROM c), 0) AS total_sales FROM b""",
)
def clean_a_metrics(spark, sf):
    raw = raw_sales(spark, sf)
    clean, bounds = C.clean_sales(raw)
    m = C.sales_metrics(raw, clean, bounds)
    four = ("max_price_after", "max_quantity_after", "price_lower", "price_upper", "quantity_lower", "quantity_upper")
    return m.withColumns({c: F.round(c, 4) for c in four} | {"total_sales": F.round("total_sales", 0)})


@query(
    "clean_a_summary", "AGG-05",
    CLEAN_A_SQL + """
SELECT category, count(order_id) AS orders, round_even(avg(unit_price), 2) AS avg_price, round_even(sum(quantity), 2) AS total_quantity,
       round_even(sum(quantity * unit_price * (1 - discount)), 2) AS total_sales FROM c GROUP BY category""",
)
def clean_a_summary(spark, sf):
    clean, _ = C.clean_sales(raw_sales(spark, sf))
    return category_summary(clean)


@query(
    "clean_a_pivot", "AGG-06",
    CLEAN_A_SQL + """
SELECT category, """ + ", ".join(
        f"round_even(sum(CASE WHEN region = '{r}' THEN quantity * unit_price * (1 - discount) ELSE 0 END), 0) AS \"{r}\"" for r in ("A", "R", "Unknown")
    ) + " FROM c GROUP BY category",
)
def clean_a_pivot(spark, sf):
    clean, _ = C.clean_sales(raw_sales(spark, sf))
    return pivot_sum(clean, "category", "region", "amount", ("A", "R", "Unknown"))


@query(
    "clean_b", "CLN-03 FLT-02 WIN-01",
    f"""WITH {RAW_SALES_SQL},
t AS (SELECT order_id, coalesce(category, 'Unknown') AS category, coalesce(region, 'Unknown') AS region, unit_price, quantity,
             greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(discount, 0))) AS discount FROM raw_sales),
g AS (SELECT category, median(unit_price) AS m FROM t GROUP BY category),
u AS (SELECT t.* EXCLUDE (unit_price), coalesce(unit_price, m) AS unit_price FROM t LEFT JOIN g USING (category)),
d AS (SELECT median(unit_price) AS price, median(quantity) AS n FROM u),
v AS (SELECT order_id, category, region, coalesce(unit_price, price) AS unit_price, coalesce(quantity, n) AS quantity, discount FROM u, d)
SELECT order_id, category, region, round(unit_price, 4) AS unit_price, quantity, discount, round(quantity * unit_price * (1 - discount), 6) AS amount
FROM v WHERE unit_price > 0 AND quantity > 0""",
)
def clean_b(spark, sf):
    kept = C.report_sales(raw_sales(spark, sf))
    return kept.withColumns({"unit_price": F.round("unit_price", 4), "amount": F.round("amount", 6)})


CLEAN_C_SQL = f"""WITH {CUSTOMERS_SQL},
t AS (SELECT customer_id, coalesce(trim(gender), 'Unknown') AS gender, senior, tenure_months, monthly_charges, total_charges, contract,
             payment_method, num_services, churn FROM customers),
g AS (SELECT contract, median(total_charges) AS m FROM t GROUP BY contract)
SELECT customer_id, gender, senior, tenure_months::DOUBLE AS tenure_months, round(monthly_charges, 6) AS monthly_charges,
       round(coalesce(total_charges, m), 6) AS total_charges, contract, payment_method, num_services::DOUBLE AS num_services, churn::DOUBLE AS churn
FROM t LEFT JOIN g USING (contract)"""


def clean_customers(rows):
    return C.clean_customers(
        rows,
        required=CANONICAL_FIELDS,
        numeric=NUMERIC_FEATURES,
        texts=("gender", "contract", "payment_method"),
        target="churn",
        grouped="total_charges",
        group="contract",
    )


@query("clean_c", "CLN-04 STR-01 WIN-01", CLEAN_C_SQL)
def clean_c(spark, sf):
    rows = clean_customers(canonical(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("monthly_charges", "total_charges")})


@query(
    "clean_c_snapshot", "AGG-18 CLN-04",
    f"""WITH {CUSTOMERS_SQL}
        SELECT count(*) AS rows, 0 AS duplicate_ids, count(*) FILTER (gender IS NULL) + count(*) FILTER (total_charges IS NULL) AS missing_cells,
               round((count(*) FILTER (gender IS NULL) + count(*) FILTER (total_charges IS NULL))::DOUBLE / (count(*) * 10), 8) AS missing_rate,
               0 AS numeric_coercions FROM customers""",
)
def clean_c_snapshot(spark, sf):
    snap = quality_snapshot(canonical(spark, sf), "customer_id", [*NUMERIC_FEATURES, "churn"])
    return snap.withColumn("missing_rate", F.round("missing_rate", 8))


@query(
    "group_medians", "WIN-01 AGG-19",
    """SELECT o_orderkey, o_orderstatus, round(median(o_totalprice) OVER (PARTITION BY o_orderstatus), 4) AS group_median FROM orders""",
)
def group_medians(spark, sf):
    from ..operators.scale import lookup, stage_counted

    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    q = quantiles(orders, "o_totalprice", [0.5], ["o_orderstatus"])
    medians, n = stage_counted(q.select("o_orderstatus", F.round(F.col("q")[0], 4).alias("group_median")), "medians")
    return lookup(orders.drop("o_totalprice"), medians, ["o_orderstatus"], table_rows=n)


@query(
    "quantiles_linear", "AGG-19",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{int(p * 100):02d}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + " FROM lineitem GROUP BY l_returnflag",
)
def quantiles_linear(spark, sf):
    probs = (0.1, 0.25, 0.5, 0.75, 0.9)
    q = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", probs, ["l_returnflag"])
    return q.select("l_returnflag", *[F.round(F.col("q")[i], 4).alias(f"p{int(p * 100):02d}") for i, p in enumerate(probs)])


@query(
    "quantiles_nearest", "AGG-20",
    "SELECT l_returnflag, "
    + ", ".join(f"quantile_disc(l_extendedprice, {p}) AS p{int(p * 100):02d}" for p in (0.5, 0.95))
    + " FROM lineitem GROUP BY l_returnflag",
)
def quantiles_nearest(spark, sf):
    q = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", (0.5, 0.95), ["l_returnflag"], method="nearest")
    return q.select("l_returnflag", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"))


@query(
    "masked_update", "PRJ-06 PRJ-07 PRJ-08 NUM-02 NUM-03",
    """SELECT c_custkey, round(CASE WHEN c_mktsegment = 'BUILDING' THEN least(c_acctbal * 1.35::DOUBLE, 9000) ELSE c_acctbal END, 4) AS balance,
              round_even(CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey * 0.45::DOUBLE ELSE c_nationkey END, 0) AS tenure,
              CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive, 'current' AS period FROM customer""",
)
def masked_update(spark, sf):
    focus = F.col("c_mktsegment") == "BUILDING"
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.round(masked(focus, scaled_with_cap(F.col("c_acctbal"), 1.35, 9000.0), F.col("c_acctbal")), 4).alias("balance"),
        F.bround(masked(focus, F.col("c_nationkey") * 0.45, F.col("c_nationkey").cast("double")), 0).alias("tenure"),
        positive_or_null(F.col("c_acctbal")).alias("positive"),
        F.lit("current").alias("period"),
    )


def staged_clean_sales(spark, sf):
    """Recipe A staged once, for jobs with several outputs."""
    clean, bounds = C.clean_sales(raw_sales(spark, sf))
    return stage(clean, "clean-sales"), bounds
