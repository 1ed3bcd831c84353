"""Scalar functions on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import collections as J
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..sources.readers import table
from .catalogue import query


@query(
    "text_functions", "STR-01 STR-02 STR-03 STR-04 STR-05 STR-07 STR-08 STR-09 STR-10 STR-11",
    r"""SELECT c_custkey, lower(trim('  ' || c_name || '@Example.COM ')) AS email,
               c_nationkey <> 3 AS email_ok, length(c_mktsegment) BETWEEN 8 AND 9 AS length_ok,
               starts_with(CAST(500 + c_nationkey AS VARCHAR), '5') AS server_error, c_nationkey AS level,
               'seller.' || c_mktsegment AS path, 'CUS-' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS code,
               CASE WHEN length(c_name) > 14 THEN substr(c_name, 1, 12) || '…' ELSE c_name END AS label,
               CASE WHEN c_nationkey > 6 THEN '1→2→3→…→' || (c_nationkey - 1) || '→' || c_nationkey
                    WHEN c_nationkey = 0 THEN '' ELSE array_to_string(range(1, c_nationkey + 1), '→') END AS trail
        FROM customer""",
)
def text_functions(spark, sf):
    n = F.col("c_nationkey")
    address = F.concat(F.lit("  "), "c_name", F.when(n != 3, F.lit("@")).otherwise(F.lit(" at ")), F.lit("Example.COM "))
    mail = X.strip_lower(address)
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.regexp_replace(mail, " at ", "@").alias("email"),
        X.is_email(mail).alias("email_ok"),
        X.length_between(F.col("c_mktsegment"), 8, 9).alias("length_ok"),
        X.is_server_error((n + 500).cast("string")).alias("server_error"),
        X.part_as_int(F.concat(F.lit("fixed-"), n.cast("string")), "-", 2).alias("level"),
        X.dotted(F.array(F.lit("seller"), F.col("c_mktsegment"))).alias("path"),
        X.numbered("CUS-%05d", F.col("c_custkey")).alias("code"),
        X.short_label(F.col("c_name")).alias("label"),
        X.elided(F.when(n > 0, F.sequence(F.lit(1), F.when(n > 0, n).otherwise(1))).otherwise(F.array().cast("array<int>"))).alias("trail"),
    )


@query(
    "number_formats", "STR-09",
    """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price, format('{:.1f}%', round_even((o_orderkey % 1000) / 800.0::DOUBLE * 100, 1)) AS share,
              format('{:+.2f}', (o_custkey - 500) / 4.0::DOUBLE) AS delta FROM orders""",
)
def number_formats(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        X.thousands(F.col("o_totalprice")).alias("price"),
        X.percent((F.col("o_orderkey") % 1000) / 800.0).alias("share"),
        X.signed((F.col("o_custkey") - 500) / 4.0).alias("delta"),
    )


@query(
    "numeric_functions", "NUM-01 NUM-02 NUM-03 NUM-04 NUM-05 NUL-01 NUL-02",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity END AS coerced, greatest(10.0::DOUBLE, least(40.0::DOUBLE, l_quantity)) AS clipped,
              round_even(l_quantity / 2, 0) AS half, round(ln(l_extendedprice), 8) AS log_price, CAST(ceil(l_quantity / 7) AS BIGINT) AS up,
              CAST(floor(l_quantity / 7) AS BIGINT) AS down, CAST(l_partkey % 7 AS BIGINT) AS rest, coalesce(CASE WHEN l_tax = 0.08 THEN NULL ELSE l_tax END, -1) AS filled,
              round(('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE, 12) AS draw
       FROM lineitem""",
)
def numeric_functions(spark, sf):
    q, tax = F.col("l_quantity"), F.col("l_tax")
    gap = F.when(tax != 0.08, tax).otherwise(F.lit(float("nan")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        N.to_number(F.when(tax == 0.08, "n/a").otherwise(q.cast("string"))).alias("coerced"),
        N.clip(q, 10.0, 40.0).alias("clipped"),
        N.half_even(q / 2).alias("half"),
        F.round(F.ln("l_extendedprice"), 8).alias("log_price"),
        F.ceil(q / 7).alias("up"),
        F.floor(q / 7).alias("down"),
        F.pmod("l_partkey", F.lit(7)).cast("bigint").alias("rest"),
        N.fill(N.nan_to_null(gap), -1.0).alias("filled"),
        F.round(N.unit_value(42, F.col("l_orderkey"), F.col("l_linenumber")), 12).alias("draw"),
    )


@query(
    "date_functions", "DT-01 DT-02 DT-03 STR-06",
    """WITH d AS (SELECT make_timestamp(trunc(quantile_cont(epoch_us(o_orderdate)::DOUBLE, 0.5))::BIGINT) AS mid FROM orders)
       SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
              o_orderstatus <> 'F' AS iso_ok, strftime(o_orderdate, '%H') AS hour, strftime(mid, '%Y-%m-%d') AS median_date FROM orders, d""",
)
def date_functions(spark, sf):
    from ..operators.quantiles import quantiles

    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "P", "invalid").when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy/MM/dd")
    ).otherwise(day)
    orders = table(spark, sf, "orders")
    mid = quantiles(orders, D.micros(F.col("o_orderdate").cast("timestamp")), [0.5]).first()["q"][0]
    iso = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd")).otherwise(day)
    return orders.select(
        "o_orderkey",
        F.date_format(D.mixed_timestamp(text), "yyyy-MM-dd").alias("parsed"),
        D.iso_date(iso).isNotNull().alias("iso_ok"),
        X.iso_hour(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("hour"),
        F.date_format(D.from_micros(F.lit(mid)), "yyyy-MM-dd").alias("median_date"),
    )


@query(
    "json_functions", "JSN-01 JSN-02 MAP-01 MAP-02 ARR-01 ARR-02 ARR-03",
    """SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, event_type <> 'error' AS parses,
              event_type IN ('click', 'view') AS is_light, CASE WHEN event_type = 'signup' THEN 'value,kind' ELSE 'kind' END AS absent,
              user_id AS id, event_type <> 'purchase' AS all_present, event_type <> 'click' AS counts_ok,
              '{"id":' || user_id || ',"type":"' || event_type || '"}' AS packed
       FROM events""",
)
def json_functions(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "error", F.concat(F.lit("{broken"), "props")).otherwise(F.col("props"))
    v = J.parsed(F.col("props"))
    # the user id lies under its old or its new name
    alias = J.parsed(
        F.concat(F.when(kind == "view", '{"userId":').otherwise('{"user_id":'), F.col("user_id").cast("string"), F.lit("}"))
    )
    counts = F.create_map(F.lit(1), F.lit(2), F.lit(2), F.when(kind == "click", -1).otherwise(0))
    return table(spark, sf, "events").select(
        "event_id",
        J.at(v, "k", "bigint").alias("k"),
        J.parsed(text).isNotNull().alias("parses"),
        F.array_contains(F.array(F.lit("click"), F.lit("view")), kind).alias("is_light"),
        F.array_join(
            J.missing_names(
                {"value": F.when(kind != "signup", F.col("value").cast("string")), "user": F.col("user_id").cast("string"), "kind": J.at(v, "kind")}
            ),
            ",",
        ).alias("absent"),
        F.coalesce(J.at(alias, "user_id", "bigint"), J.at(alias, "userId", "bigint")).alias("id"),
        J.all_present(F.array(kind, F.when(kind != "purchase", kind))).alias("all_present"),
        F.forall(F.map_values(counts), lambda x: x >= 0).alias("counts_ok"),
        F.to_json(F.struct(F.col("user_id").alias("id"), kind.alias("type"))).alias("packed"),
    )
