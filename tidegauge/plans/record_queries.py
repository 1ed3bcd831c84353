"""Row validation on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import EMAIL_PATTERN
from ..operators import validate as V
from ..operators import scale
from ..operators.scale import spread, stage
from ..sources.readers import envelope_records, envelope_status, table
from .catalogue import query

# The two record contracts.
USER_FIELDS = (
    V.Field("id", "int", gt=0),
    V.Field("username", "str", min_length=3, max_length=30),
    V.Field("email", "str", strip=True, lower=True, pattern=EMAIL_PATTERN, pattern_message="not a valid e-mail address"),
    V.Field("age", "int", ge=0, le=120),
    V.Field("is_active", "bool"),
    V.Field("signup_date", "date"),
    V.Field("profile.country", "str", choices=("KR", "US", "JP", "DE"), name="country"),
    V.Field("profile.tier", "str", choices=("free", "pro", "enterprise"), name="tier"),
    V.Field("profile.score", "float", ge=0, le=100, name="score"),
    V.Field("tags", "list<str>"),
)
PRODUCT_FIELDS = (
    V.Field("id", "int", gt=0),
    V.Field("name", "str", min_length=1, strip=True, min_stripped=1),
    V.Field("category", "str", min_length=2, strip=True, lower=True, min_stripped=2),
    V.Field("price", "float", gt=0),
    V.Field("seller.seller_id", "int", gt=0, name="seller_id"),
    V.Field("seller.region", "str", min_length=2, strip=True, min_stripped=2, name="seller_region"),
)


def user_records(spark, sf):
    """Customers as raw JSON user records with a range of defects, by nation."""
    n = F.col("c_nationkey")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    num = lambda c: c.cast("string")
    parts = {
        "id": num(F.col("c_custkey")),
        "username": q(F.when(n == 3, F.lit("ab")).otherwise(F.col("c_name"))),
        "email": F.when(n == 5, q(F.lit("not-an-email"))).when(n != 7, q(F.concat(F.lit("  "), "c_name", F.lit("@Example.COM ")))),
        "age": F.when(n == 9, F.lit("-5")).when(n == 23, F.lit('"abc"')).when(n == 24, F.lit('" 24 "')).otherwise(num(n * 4)),
        "is_active": F.when(n == 11, F.lit("2")).when(F.col("c_acctbal") > 0, F.lit("true")).otherwise(F.lit('"no"')),
        "signup_date": F.when(n == 13, F.lit('"20240702"')).when(n == 14, F.lit('"2024-07-02T10:00:00"')).otherwise(F.lit('"2024-07-02"')),
        "profile": F.when(n == 16, F.lit('"none"')).otherwise(
            F.concat(
                F.lit('{"country":"'),
                F.when(n == 15, "XX").when(n < 8, "KR").when(n < 16, "US").otherwise("DE"),
                F.lit('","tier":"'),
                F.when(F.col("c_mktsegment") == "BUILDING", "free").when(F.col("c_mktsegment") == "FURNITURE", "gold").otherwise("pro"),
                F.lit('","score":'),
                num(F.col("c_acctbal") / 50),
                F.lit("}"),
            )
        ),
        "tags": F.when(n == 17, F.lit('["a",5]')).when(n == 18, F.lit('"a"')).otherwise(F.lit('["a","b"]')),
    }
    fields = [F.when(c.isNotNull(), F.concat(F.lit(f'"{k}":'), c)) for k, c in parts.items()]
    rows = spread(table(spark, sf, "customer"), rows_per_task=scale.RECORD_ROWS)  # before the records, as the rows are narrow
    return rows.select(
        F.col("c_custkey").alias("row"), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("text")
    )


def checked_users(spark, sf):
    """Validated once and staged: valid rows, invalid rows, reports and counts are read from the written table."""
    records = user_records(spark, sf).withColumn("record", F.try_parse_json("text"))
    return stage(V.validate(records, "record", USER_FIELDS).drop("record"), "checked-users")


USER_ERRORS_SQL = """
errs AS (
  SELECT c_custkey AS row, list_filter([
    CASE WHEN c_custkey <= 0 THEN 'id:greater_than' END,
    CASE WHEN c_nationkey = 3 THEN 'username:string_too_short' END,
    CASE WHEN c_nationkey = 5 THEN 'email:value_error' WHEN c_nationkey = 7 THEN 'email:missing' END,
    CASE WHEN c_nationkey = 9 THEN 'age:greater_than_equal' WHEN c_nationkey = 23 THEN 'age:int_parsing' END,
    CASE WHEN c_nationkey = 11 THEN 'is_active:bool_parsing' END,
    CASE WHEN c_nationkey = 13 THEN 'signup_date:date_parsing' WHEN c_nationkey = 14 THEN 'signup_date:date_inexact' END,
    CASE WHEN c_nationkey = 16 THEN 'profile:model_type' END,
    CASE WHEN c_nationkey = 15 THEN 'profile.country:literal_error' END,
    CASE WHEN c_nationkey <> 16 AND c_mktsegment = 'FURNITURE' THEN 'profile.tier:literal_error' END,
    CASE WHEN c_nationkey <> 16 AND c_acctbal / 50 > 100 THEN 'profile.score:less_than_equal'
         WHEN c_nationkey <> 16 AND c_acctbal < 0 THEN 'profile.score:greater_than_equal' END,
    CASE WHEN c_nationkey = 17 THEN 'tags.1:string_type' WHEN c_nationkey = 18 THEN 'tags:list_type' END
  ], lambda e: e IS NOT NULL) AS errors, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)"""


@query(
    "validate_records", "VAL-01 VAL-02 VAL-03 VAL-04 VAL-05 VAL-06 VAL-07 VAL-09 STR-03 STR-04 DT-03 ARR-01",
    f"WITH {USER_ERRORS_SQL} SELECT row, len(errors) AS n_errors, array_to_string(errors, ';') AS errors FROM errs",
)
def validate_records(spark, sf):
    marks = F.transform("errors", lambda e: F.concat_ws(":", e["loc"], e["type"]))
    return checked_users(spark, sf).select("row", F.size("errors").cast("bigint").alias("n_errors"), F.array_join(marks, ";").alias("errors"))


@query(
    "valid_users", "VAL-08 VAL-10 STR-01 STR-02",
    f"""WITH {USER_ERRORS_SQL}
        SELECT row, row AS id, c_name AS username, lower(c_name) || '@example.com' AS email,
               CASE WHEN c_nationkey = 24 THEN 24 ELSE c_nationkey * 4 END AS age, c_acctbal > 0 AS is_active, DATE '2024-07-02' AS signup_date,
               CASE WHEN c_nationkey < 8 THEN 'KR' WHEN c_nationkey < 16 THEN 'US' ELSE 'DE' END AS country,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'free' ELSE 'pro' END AS tier, round(c_acctbal / 50, 4) AS score, 'a,b' AS tags
        FROM errs WHERE len(errors) = 0""",
)
def valid_users(spark, sf):
    rows = V.valid_rows(checked_users(spark, sf), ["row"])
    return rows.withColumn("score", F.round("score", 4)).withColumn("tags", F.array_join("tags", ","))


@query(
    "invalid_users", "VAL-10",
    f"WITH {USER_ERRORS_SQL} SELECT row, 'transform' AS stage, len(errors) AS n_errors FROM errs WHERE len(errors) > 0",
)
def invalid_users(spark, sf):
    bad = V.invalid_rows(checked_users(spark, sf), ["row"], "text")
    return bad.select("row", "stage", F.size("errors").cast("bigint").alias("n_errors"))


@query(
    "validation_errors", "VAL-11 STR-08",
    f"""WITH {USER_ERRORS_SQL}, e AS (SELECT unnest(errors) AS e FROM errs)
        SELECT split_part(e, ':', 1) AS loc, split_part(e, ':', 2) AS type, count(*) AS n FROM e GROUP BY ALL""",
)
def validation_errors(spark, sf):
    return V.error_report(checked_users(spark, sf))


@query(
    "validation_counts", "AGG-33 VAL-10",
    f"""WITH {USER_ERRORS_SQL}
        SELECT count(*) AS extracted, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid,
               CAST(sum(len(errors)) AS BIGINT) AS n_errors FROM errs""",
)
def validation_counts(spark, sf):
    return V.split_counts(checked_users(spark, sf))


def product_records(spark, sf):
    """Parts as nested product records; some prices negative, some sellers without a number."""
    price = F.when(F.col("p_size") == 13, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("category"),
        price.alias("price"),
        F.struct((F.col("p_size") - 1).alias("seller_id"), F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("region")).alias("seller"),
    )
    rows = spread(table(spark, sf, "part"), rows_per_task=scale.RECORD_ROWS)
    return rows.select(F.col("p_partkey").alias("row"), F.to_json(record).alias("text"))


def checked_products(spark, sf):
    records = product_records(spark, sf).withColumn("record", F.try_parse_json("text"))
    return stage(V.validate(records, "record", PRODUCT_FIELDS).drop("record"), "checked-products")


@query(
    "products_flat", "PRJ-03 VAL-08",
    """SELECT p_partkey AS id, p_name AS name, lower(p_type) AS category, p_retailprice AS price, CAST(p_size - 1 AS BIGINT) AS seller_id,
              p_brand AS seller_region
       FROM part WHERE p_partkey > 0 AND p_size <> 13 AND p_size > 1""",
)
def products_flat(spark, sf):
    return V.valid_rows(checked_products(spark, sf))


@query(
    "product_summary", "AGG-33",
    """SELECT count(*) AS extracted, count(*) FILTER (p_partkey > 0 AND p_size <> 13 AND p_size > 1) AS valid,
              count(*) FILTER (NOT (p_partkey > 0 AND p_size <> 13 AND p_size > 1)) AS invalid,
              CAST(sum((p_partkey <= 0)::INT + (p_size = 13)::INT + (p_size <= 1)::INT) AS BIGINT) AS n_errors FROM part""",
)
def product_summary(spark, sf):
    return V.split_counts(checked_products(spark, sf))


TURN_FIELDS = (
    V.Field("role", "str", choices=("user", "assistant")),
    V.Field("turn", "int", ge=0),
    V.Field("text", "str", strip=True, min_stripped=1),
)


@query(
    "conversation_rules", "VAL-05 VAL-09",
    """SELECT role, count(*) AS n, count(*) FILTER (role NOT IN ('user', 'assistant') OR length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) = 0) AS invalid
       FROM conversations GROUP BY role""",
)
def conversation_rules(spark, sf):
    turns = table(spark, sf, "conversations")
    record = F.try_parse_json(F.to_json(F.struct("role", "turn", "text")))
    checked = stage(V.validate(turns.withColumn("record", record), "record", TURN_FIELDS).select("role", "errors"), "checked-turns")
    return checked.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("errors") > 0).alias("invalid"))


@query(
    "envelope_records", "SRC-08 PRJ-10 JSN-01",
    """SELECT conv_id, CAST(turn + 1 AS BIGINT) AS pos, NULL::VARCHAR AS fault, turn AS value FROM
         (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n, min(turn) OVER (PARTITION BY conv_id) AS low FROM conversations) WHERE false
       UNION ALL
       SELECT o_orderkey, i + 1, NULL, o_custkey + i FROM orders, range(2) t(i) WHERE o_orderstatus <> 'P'
       UNION ALL
       SELECT o_orderkey, NULL, 'count (3) differs from the number of results (2)', NULL FROM orders WHERE o_orderstatus = 'P'""",
)
def envelopes(spark, sf):
    """Each order as an envelope of two records; orders in status P declare one too many."""
    result = lambda i: F.struct((F.col("o_custkey") + i).alias("value"))
    text = F.to_json(
        F.struct(
            F.lit("ok").alias("status"),
            F.when(F.col("o_orderstatus") == "P", 3).otherwise(2).alias("count"),
            F.array(result(0), result(1)).alias("results"),
        )
    )
    checked = envelope_status(table(spark, sf, "orders").select(F.col("o_orderkey").alias("conv_id"), text.alias("value")))
    good = envelope_records(checked, ["conv_id"]).select(
        "conv_id",
        F.col("row").cast("bigint").alias("pos"),
        F.lit(None).cast("string").alias("fault"),
        F.try_variant_get("record", "$.value", "bigint").alias("value"),
    )
    none = F.lit(None).cast("bigint")
    bad = checked.filter(F.col("fault").isNotNull()).select("conv_id", none.alias("pos"), "fault", none.alias("value"))
    return good.unionByName(bad)

