"""Event intake on the shared tables: envelopes of customers with injected faults, chosen by nation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL_FIELDS
from ..operators import incremental as N
from ..operators import ingest as I
from ..operators import scale
from ..operators.scale import own_folder, spread, stage
from ..sources.readers import table
from .catalogue import query
from .tables import CUSTOMERS_SQL, customers

TWIN = 1_000_000_000_000


def events(spark, sf) -> DataFrame:
    """(seq, event): nation 0 an unknown version, 1 and 2 old aliases, 3 no id, 4 sent twice, 5 a bad label, 6 no event id,
    7 broken first and sent again whole."""
    return with_faults(customers(spark, sf, spread_table))


def spread_table(spark, sf, name) -> DataFrame:
    """A table dealt over tasks while its rows are narrow: each becomes an event that is parsed and judged."""
    return spread(table(spark, sf, name), rows_per_task=scale.RECORD_ROWS)


def with_faults(rows: DataFrame) -> DataFrame:
    second = F.col("seq") % 2 == 1
    sent = I.to_events(rows, F.when(second, 2).otherwise(1), order="seq").withColumn(
        "nation", F.get_json_object("event", "$.payload.tenure_months").cast("int") / 3
    )
    nation = F.coalesce("nation", F.get_json_object("event", "$.payload.subscription.tenureMonths").cast("int") / 3)
    sent = sent.withColumn("nation", nation.cast("int"))
    n, e = F.col("nation"), F.col("event")
    faulty = (
        F.when(n == 0, F.regexp_replace(e, '"schema_version":[12]', '"schema_version":99'))
        .when(n == 1, F.regexp_replace(e, r'"billing":\{"monthlyCharges":([^,]*),', r'"monthly_charges":$1,"billing":{'))
        .when(n == 2, F.regexp_replace(e, '"customer_id":', '"customerId":'))
        .when(n == 3, F.regexp_replace(e, '"customerId":"[^"]*",', ""))
        .when(n == 5, F.regexp_replace(e, '"churn":[01]', '"churn":7'))
        .when(n == 6, F.regexp_replace(e, '"event_id":"[^"]*",', ""))
        .when(n == 7, F.regexp_replace(e, '"payload":.*$', '"payload":"broken"}'))
        .otherwise(e)
    )
    copies = sent.filter(n.isin(4, 7)).select((F.col("seq") + TWIN).alias("seq"), "event")
    return sent.select("seq", faulty.alias("event")).unionByName(copies)


ROUTED_SQL = f"""{CUSTOMERS_SQL},
sent AS (SELECT *, seq % 2 = 1 AS v2, FALSE AS twin FROM customers
         UNION ALL SELECT * REPLACE (seq + {TWIN} AS seq), seq % 2 = 1, TRUE FROM customers WHERE nation IN (4, 7)),
routed AS (
  SELECT seq, nation, v2, twin, customer_id, period, monthly_charges, total_charges,
         CASE WHEN nation <> 6 THEN period || ':' || customer_id END AS event_id,
         CASE WHEN nation = 4 AND twin THEN 'duplicate'
              WHEN nation = 0 OR nation = 1 AND v2 OR nation = 2 AND NOT v2 OR nation = 3 AND v2 OR nation IN (5, 6)
                   OR nation = 7 AND NOT twin OR nation >= 24 AND gender IS NULL THEN 'dlq' ELSE 'accepted' END AS outcome,
         CASE WHEN nation = 0 THEN 'unsupported_schema' WHEN nation = 1 AND v2 OR nation = 2 AND NOT v2 OR nation = 3 AND v2 THEN 'missing_required_field'
              WHEN nation = 5 THEN 'invalid_churn' WHEN nation = 6 THEN 'missing_event_id' WHEN nation = 7 AND NOT twin THEN 'invalid_structure'
              WHEN nation >= 24 THEN 'missing_required_field' END AS reason_code,
         CASE WHEN nation = 0 AND NOT v2 OR nation = 1 AND v2 OR nation = 2 AND NOT v2 THEN 'recovered'
              WHEN nation = 0 OR nation = 3 AND v2 OR nation IN (5, 6) OR nation >= 24 THEN 'failed'
              WHEN nation = 7 AND NOT twin THEN 'duplicate' END AS replay,
         CASE WHEN v2 THEN 2 ELSE 1 END AS version
  FROM sent)"""


@query(
    "ingest_route", "ING-01 ING-02 ING-03 ING-04 ING-05 ING-07 ING-08 JN-04 WIN-03 PRJ-04 PRJ-05 STR-09",
    f"WITH {ROUTED_SQL} SELECT seq, event_id, outcome, reason_code, replay FROM routed",
)
def ingest_route(spark, sf):
    return I.route(events(spark, sf)).select("seq", "event_id", "outcome", "reason_code", "replay")


@query(
    "dlq_records", "ING-06 PRJ-09 AGG-29",
    f"""WITH {ROUTED_SQL}
        SELECT seq, 'DLQ-' || lpad(CAST(row_number() OVER (ORDER BY seq) AS VARCHAR), 5, '0') AS dlq_id, event_id, reason_code,
               replay AS status, 1 AS retry_count,
               'pending:' || reason_code || '>' || replay || CASE WHEN replay = 'failed' THEN ':' || reason_code ELSE '' END AS history
        FROM routed WHERE outcome = 'dlq'""",
)
def dlq_records(spark, sf):
    letters = I.dead_letters(I.route(events(spark, sf)))
    steps = F.transform("history", lambda h: F.concat_ws(":", h["status"], h["reason_code"]))
    return letters.select("seq", "dlq_id", "event_id", "reason_code", "status", "retry_count", F.array_join(steps, ">").alias("history"))


@query(
    "accepted_rows", "ING-09 ING-01",
    f"""WITH {ROUTED_SQL}
        SELECT CASE WHEN outcome = 'accepted' THEN 1 ELSE 2 END AS phase, seq, customer_id, round(monthly_charges, 6) AS monthly_charges,
               round(total_charges, 6) AS total_charges, period,
               CASE WHEN nation = 0 THEN 1 ELSE version END AS source_schema_version
        FROM routed WHERE outcome = 'accepted' OR replay = 'recovered'""",
)
def accepted_rows(spark, sf):
    rows = I.typed_customers(I.accepted(I.route(events(spark, sf))), ["monthly_charges", "total_charges"])
    return rows.select(
        "phase", "seq", "customer_id", F.round("monthly_charges", 6).alias("monthly_charges"),
        F.round("total_charges", 6).alias("total_charges"), "period", "source_schema_version",
    )


@query(
    "ingest_summary", "ING-10 AGG-34 AGG-26 AGG-28",
    f"""WITH {ROUTED_SQL}
        SELECT count(*) AS received, count(*) FILTER (outcome = 'accepted') AS accepted_initial, count(*) FILTER (outcome = 'dlq') AS dlq_initial,
               count(*) FILTER (replay = 'recovered') AS recovered, count(*) FILTER (replay = 'failed') AS unresolved,
               count(*) FILTER (outcome = 'duplicate' OR replay = 'duplicate') AS duplicates,
               count(*) FILTER (outcome = 'accepted' OR replay = 'recovered') AS accepted_total,
               '1=' || count(*) FILTER ((outcome = 'accepted' OR replay = 'recovered') AND (nation = 0 OR NOT v2)) || ',2='
                    || count(*) FILTER ((outcome = 'accepted' OR replay = 'recovered') AND nation <> 0 AND v2) AS versions
        FROM routed""",
)
def ingest_summary(spark, sf):
    summary = I.ingest_summary(I.route(events(spark, sf)))
    pairs = F.transform(F.map_entries("accepted_schema_versions"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return summary.withColumn("versions", F.array_join(pairs, ",")).drop("accepted_schema_versions")


@query(
    "ingest_summary_by_batches", "AGG-34 AGG-28",
    f"""WITH {ROUTED_SQL}
        SELECT count(*) AS received, count(*) FILTER (outcome = 'accepted') AS accepted_initial, count(*) FILTER (outcome = 'dlq') AS dlq_initial,
               count(*) FILTER (replay = 'recovered') AS recovered, count(*) FILTER (replay = 'failed') AS unresolved,
               count(*) FILTER (outcome = 'duplicate' OR replay = 'duplicate') AS duplicates,
               count(*) FILTER (outcome = 'accepted' OR replay = 'recovered') AS accepted_total,
               '1=' || count(*) FILTER ((outcome = 'accepted' OR replay = 'recovered') AND (nation = 0 OR NOT v2)) || ',2='
                    || count(*) FILTER ((outcome = 'accepted' OR replay = 'recovered') AND nation <> 0 AND v2) AS versions
        FROM routed""",
)
def ingest_summary_by_batches(spark, sf):
    """The same summary from the counts of three batches, one of which is written twice, and of the replay that follows."""
    routed = stage(I.route(events(spark, sf)), "routed")
    folder = f"{own_folder(spark)}/counts-{uuid.uuid4().hex}"
    for batch in (0, 2, 1, 2):
        N.add_routed(I.without_replay(routed.filter(F.pmod("seq", F.lit(3)) == batch)), folder, batch)
    N.add_replayed(routed.filter(F.col("outcome") == "dlq"), folder, 1)
    summary = N.intake_summary(spark, folder)
    pairs = F.transform(F.map_entries("accepted_schema_versions"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return summary.withColumn("versions", F.array_join(pairs, ",")).drop("accepted_schema_versions")


@query(
    "period_summaries", "ING-10 AGG-34",
    f"""WITH {ROUTED_SQL}
        SELECT period, count(*) AS received, count(*) FILTER (outcome = 'accepted') AS accepted_initial,
               count(*) FILTER (outcome = 'dlq') AS dlq_initial,
               count(*) FILTER (replay = 'recovered' AND period = 'current') AS recovered,
               count(*) FILTER (outcome = 'duplicate' OR replay = 'duplicate' AND period = 'current') AS duplicates,
               count(*) FILTER (outcome = 'accepted' OR replay = 'recovered' AND period = 'current') AS accepted_total
        FROM routed GROUP BY period""",
)
def period_summaries(spark, sf):
    """The two periods as two feeds; only the current one is replayed."""
    # a broken payload has lost its period; the customer's number tells it
    known = customers(spark, sf).select(F.col("seq").alias("_seq"), F.col("period").alias("_period"))
    placed = events(spark, sf).join(known, F.col("seq") % TWIN == F.col("_seq"))
    feeds = {p: I.route(placed.filter(F.col("_period") == p).select("seq", "event")) for p in ("reference", "current")}
    feeds["reference"] = I.without_replay(feeds["reference"])
    rows = [I.ingest_summary(r).withColumn("period", F.lit(p)) for p, r in feeds.items()]
    return rows[0].unionByName(rows[1]).drop("unresolved", "accepted_schema_versions")


@query(
    "second_run_route", "JN-04 ST-04",
    f"""WITH {ROUTED_SQL}, known AS (SELECT DISTINCT event_id FROM routed WHERE outcome = 'accepted')
        SELECT outcome, count(*) AS n FROM
          (SELECT CASE WHEN event_id IN (SELECT event_id FROM known) THEN 'duplicate' ELSE 'dlq' END AS outcome FROM routed) GROUP BY outcome""",
)
def second_run_route(spark, sf):
    """The whole feed sent again: every id accepted before is a duplicate, also its broken twin."""
    sent = events(spark, sf)
    known = stage(I.route(sent).filter(F.col("outcome") == "accepted").select("event_id"), "accepted-ids")
    return I.route(sent, known).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "version_counts", "AGG-28",
    f"""WITH {ROUTED_SQL} SELECT '1=' || count(*) FILTER (NOT v2) || ',2=' || count(*) FILTER (v2) AS versions
        FROM routed WHERE outcome = 'accepted'""",
)
def version_counts(spark, sf):
    rows = I.accepted(I.route(events(spark, sf))).filter(F.col("phase") == 1)
    pairs = F.transform(F.map_entries("versions"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return I.version_counts(rows).select(F.array_join(pairs, ",").alias("versions"))


@query(
    "envelopes", "PRJ-04 PRJ-05 JSN-02",
    f"""WITH {CUSTOMERS_SQL}
        SELECT seq, period || ':' || customer_id AS event_id, CASE WHEN seq % 2 = 1 THEN 2 ELSE 1 END AS version, contract,
               CASE WHEN seq % 2 = 1 THEN 4 + 3 ELSE {len(CANONICAL_FIELDS) + 1} END AS n_keys FROM customers""",
)
def envelopes(spark, sf):
    sent = I.to_events(customers(spark, sf), F.when(F.col("seq") % 2 == 1, 2).otherwise(1), order="seq")
    g = lambda p: F.get_json_object("event", p)
    return sent.select(
        "seq",
        g("$.event_id").alias("event_id"),
        g("$.schema_version").cast("int").alias("version"),
        F.coalesce(g("$.payload.contract"), g("$.payload.subscription.contract")).alias("contract"),
        (F.size(F.json_object_keys(g("$.payload"))) + F.when(g("$.payload.customerId").isNotNull(), 1).otherwise(0)).cast("int").alias("n_keys"),
    )
