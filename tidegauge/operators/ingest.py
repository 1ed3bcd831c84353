"""Versioned events: normalise, route, repair, replay, accept once (ING-01..10, PRJ-04, PRJ-05, WIN-03, JN-04).

Everything is a set expression. An event's outcome depends only on two numbers per id: the position of its first valid
event, and the position of its first event that is valid after repair. Both come from one grouped minimum, so there is
no sequential pass and no per-id list, and an id that holds a third of all events costs one partial minimum per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL_FIELDS
from ..functions.collections import NUMBER_TYPES, at, counts_map, missing_names, object_mark, parsed, type_of
from ..functions.text import numbered, strip
from .scale import BROADCAST_ROWS, lookup, numbered_rows, salted_lookup, stage, stage_counted

SUPPORTED_VERSIONS = (1, 2)
OPTIONAL_FIELDS = ("total_charges",)

# Where version 2 keeps each canonical field.
V2_PATHS = {
    "customer_id": "customerId",
    "gender": "demographics.gender",
    "senior": "demographics.isSenior",
    "tenure_months": "subscription.tenureMonths",
    "monthly_charges": "billing.monthlyCharges",
    "total_charges": "billing.totalCharges",
    "contract": "subscription.contract",
    "payment_method": "billing.paymentMethod",
    "num_services": "subscription.serviceCount",
    "churn": "label.churn",
}
V2_OBJECTS = ("demographics", "subscription", "billing", "label")


def to_events(rows: DataFrame, version: Column, *, order: str, period: str = "period", key: str = "customer_id") -> DataFrame:
    """Flat rows -> (seq, event JSON) envelopes; version 1 is flat, version 2 nested (PRJ-04, PRJ-05)."""
    flat = F.struct(*[F.col(c) for c in CANONICAL_FIELDS], F.col(period).alias("period"))
    nested = F.struct(
        F.col("customer_id").alias("customerId"),
        F.col(period).alias("period"),
        F.struct("gender", F.col("senior").alias("isSenior")).alias("demographics"),
        F.struct(
            F.col("tenure_months").alias("tenureMonths"), "contract", F.col("num_services").alias("serviceCount")
        ).alias("subscription"),
        F.struct(
            F.col("monthly_charges").alias("monthlyCharges"),
            F.col("total_charges").alias("totalCharges"),
            F.col("payment_method").alias("paymentMethod"),
        ).alias("billing"),
        F.struct("churn").alias("label"),
    )
    event_id = F.concat_ws(":", F.coalesce(F.col(period), F.lit("unknown")), F.col(key).cast("string"))
    keep_nulls = {"ignoreNullFields": "false"}

    def envelope(v: int, payload: Column) -> Column:
        return F.to_json(
            F.struct(event_id.alias("event_id"), F.lit(v).alias("schema_version"), payload.alias("payload")), keep_nulls
        )

    return rows.select(
        F.col(order).alias("seq"), F.when(version == 2, envelope(2, nested)).otherwise(envelope(1, flat)).alias("event")
    )


# Columns every reading needs besides the 2 x 10 field texts: projected once, then compared by name.
_WORK = "_w_"


def _w(name: str) -> Column:
    return F.col(_WORK + name)


def _is(name: str, wanted: str) -> Column:
    return F.coalesce(_w(name) == wanted, F.lit(False))


def _read(events: DataFrame, event: str) -> DataFrame:
    """Parse once and project every leaf of both payload shapes as its own column."""
    v = F.col("_v")
    number = lambda path: F.when(
        type_of(at(v, path, "variant")).isin(*NUMBER_TYPES, "BOOLEAN"), at(v, path, "double")
    )
    leaves = {
        "root": object_mark(v),
        "event_id": strip(at(v, "event_id")),
        "version": number("schema_version"),
        "payload": object_mark(v, "payload"),
        "period": at(v, "payload.period"),
        "churn1": number("payload.churn"),
        "churn2": number("payload.label.churn"),
        "no_flat_id": at(v, "payload.customer_id", "variant").isNull(),
        "no_nested_id": at(v, "payload.customerId", "variant").isNull(),
        "no_nested_monthly": at(v, "payload.billing.monthlyCharges", "variant").isNull(),
    }
    leaves |= {f"object_{p}": object_mark(v, f"payload.{p}") for p in V2_OBJECTS}
    leaves |= {f"flat_{f}": at(v, f"payload.{f}") for f in CANONICAL_FIELDS}
    leaves |= {f"nested_{f}": at(v, f"payload.{p}") for f, p in V2_PATHS.items()}
    # presence of a key, which may hold a null
    any_flat = F.lit(False)
    for f in CANONICAL_FIELDS:
        any_flat = any_flat | at(v, f"payload.{f}", "variant").isNotNull()
    # looked at only where the version is unknown
    leaves["any_flat"] = F.when(~_supported(number("schema_version")), any_flat).otherwise(F.lit(False))
    return events.withColumn("_v", parsed(F.col(event))).withColumns({_WORK + n: c for n, c in leaves.items()}).drop("_v")


def _supported(version: Column) -> Column:
    return F.coalesce(version.isin(*map(float, SUPPORTED_VERSIONS)), F.lit(False))


def _judge(read: DataFrame, side: str, repaired: bool) -> DataFrame:
    """Add the event as read in one way, as sent or after the safe repair: `<side>_code`, `<side>_message`, fields."""
    s = lambda n: F.col(f"{side}_{n}")
    version = _w("version")
    if repaired:
        # an unknown version with any canonical field at the top of the payload reads as version 1
        version = F.when(~_supported(version) & _is("payload", "OBJECT") & _w("any_flat"), 1.0).otherwise(version)
    out = read.withColumn(f"{side}_version", version)
    out = out.withColumn(f"{side}_second", F.coalesce(s("version") == 2.0, F.lit(False)))
    flat = {f: _w(f"flat_{f}") for f in CANONICAL_FIELDS}
    nested = {f: _w(f"nested_{f}") for f in CANONICAL_FIELDS}
    if repaired:
        # an alias counts only where the proper key is absent, not where it is null
        flat["customer_id"] = F.when(_w("no_flat_id"), _w("nested_customer_id")).otherwise(_w("flat_customer_id"))
        nested["customer_id"] = F.when(_w("no_nested_id"), _w("flat_customer_id")).otherwise(_w("nested_customer_id"))
        nested["monthly_charges"] = F.when(
            _w("no_nested_monthly") & _is("object_billing", "OBJECT"), _w("flat_monthly_charges")
        ).otherwise(_w("nested_monthly_charges"))
    out = out.withColumns({f"{side}_{f}": F.when(s("second"), nested[f]).otherwise(flat[f]) for f in CANONICAL_FIELDS})
    lost = F.lit(None).cast("string")
    for p in reversed(V2_OBJECTS):
        lost = F.when(~_is(f"object_{p}", "OBJECT"), F.lit(p)).otherwise(lost)
    out = out.withColumns(
        {
            f"{side}_lost": F.when(~_is("payload", "OBJECT"), F.lit("payload")).when(s("second"), lost),
            f"{side}_absent": missing_names({f: s(f) for f in CANONICAL_FIELDS if f not in OPTIONAL_FIELDS}),
            f"{side}_label": F.when(s("second"), _w("churn2")).otherwise(_w("churn1")),
        }
    )
    # the first failing check names the failure
    code = (
        F.when(~_is("root", "OBJECT"), "invalid_event")
        .when(F.coalesce(_w("event_id"), F.lit("")) == "", "missing_event_id")
        .when(~_supported(s("version")), "unsupported_schema")
        .when(s("lost").isNotNull(), "invalid_structure")
        .when(F.size(s("absent")) > 0, "missing_required_field")
        .when(~F.coalesce(s("label").isin(0.0, 1.0), F.lit(False)), "invalid_churn")
    )
    shown = F.coalesce(s("version").cast("bigint").cast("string"), F.lit("none"))
    out = out.withColumn(f"{side}_code", code)
    message = (
        F.when(s("code") == "invalid_event", "an event must be an object")
        .when(s("code") == "missing_event_id", "event_id is missing")
        .when(s("code") == "unsupported_schema", F.concat(F.lit("unsupported schema version: "), shown))
        .when(s("code") == "invalid_structure", F.concat(s("lost"), F.lit(" must be an object")))
        .when(s("code") == "missing_required_field", F.concat(F.lit("missing fields: "), F.array_join(s("absent"), ", ")))
        .when(s("code") == "invalid_churn", "churn must be 0 or 1")
    )
    return out.withColumn(f"{side}_message", message)


def _canonical(side: str) -> Column:
    return F.struct(
        *[F.col(f"{side}_{f}").alias(f) for f in CANONICAL_FIELDS],
        _w("period").alias("period"),
        _w("event_id").alias("event_id"),
        F.col(f"{side}_version").cast("int").alias("source_schema_version"),
    )


def normalize(events: DataFrame, event: str = "event", *, repaired: bool = False) -> DataFrame:
    """Add `reason_code`, `error_message` (first failing check) and `canonical` (null where one failed) (ING-01..03)."""
    judged = _judge(_read(events, event), "_s", repaired)
    return judged.select(
        *events.columns,
        F.col("_s_code").alias("reason_code"),
        F.col("_s_message").alias("error_message"),
        F.when(F.col("_s_code").isNull(), _canonical("_s")).alias("canonical"),
    )


def judged_events(events: DataFrame) -> DataFrame:
    """(seq, event) with event_id, schema_version, `_s_code` and `_s_message` as sent, `_m_code` and `_m_message` after the safe
    repair, and canonical. Stateless, so it also works on streams."""
    judged = _judge(_judge(_read(events, "event"), "_s", False), "_m", True)
    return judged.select(
        "seq",
        "event",
        _w("event_id").alias("event_id"),
        F.col("_s_version").cast("int").alias("schema_version"),
        "_s_code",
        "_s_message",
        "_m_code",
        "_m_message",
        F.when(F.col("_s_code").isNull(), _canonical("_s")).when(F.col("_m_code").isNull(), _canonical("_m")).alias("canonical"),
    )


def route(events: DataFrame, accepted_ids: DataFrame | None = None) -> DataFrame:
    """Route (seq, event) to exactly one outcome each and decide the replay of the dead letters (ING-04..08).

    Adds event_id, schema_version, outcome (accepted | duplicate | dlq), reason_code, error_message, replay (recovered |
    duplicate | failed, null unless dlq), replay_code, replay_message, and canonical (of the event or of its repair).
    `accepted_ids` (event_id) holds ids accepted by earlier runs; seq must be unique.

    The JSON is parsed once: the judged events are staged, and the grouped minimum then reads four narrow columns of them.
    """
    read = stage(judged_events(events), "judged-events")
    good, mended = F.col("_s_code").isNull(), F.col("_m_code").isNull()
    marks = read.filter(F.coalesce("event_id", F.lit("")) != "").select(
        "event_id",
        F.when(good, F.col("seq")).alias("valid_seq"),
        F.when(~good & mended, F.col("seq")).alias("mended_seq"),
    )
    if accepted_ids is not None:
        before = accepted_ids.select("event_id").join(marks.select("event_id").distinct(), "event_id", "left_semi")
        none = F.lit(None).cast("bigint")
        marks = marks.unionByName(
            before.select("event_id", F.lit(-1).cast("bigint").alias("valid_seq"), none.alias("mended_seq"))
        )
    firsts = marks.groupBy("event_id").agg(
        F.min("valid_seq").alias("_f"), F.min("mended_seq").alias("_g"), F.count(F.lit(1)).alias("_n")
    )
    firsts, ids = stage_counted(firsts, "first-positions")
    return decided(read, firsts, ids)


def decided(read: DataFrame, firsts: DataFrame, ids: int) -> DataFrame:
    """Outcomes of judged events from the first positions per id: `_f` of a valid event (-1: accepted earlier), `_g` of one that
    the repair mends, `_n` events; `ids` is the number of rows of `firsts`."""
    good, f, g, seq = F.col("_s_code").isNull(), F.col("_f"), F.col("_g"), F.col("seq")
    # events without an id are letters whatever else came: they stay out of the join, where they would be one hot key
    has_id = F.coalesce("event_id", F.lit("")) != ""
    asked, nameless = read.filter(has_id), read.filter(~has_id)
    if ids <= BROADCAST_ROWS:
        joined = lookup(asked, firsts, ["event_id"], table_rows=ids)
    else:
        joined = salted_lookup(asked, firsts, ["event_id"], weight="_n")
    joined = joined.unionByName(nameless, allowMissingColumns=True)
    outcome = F.when(good & (seq == f), "accepted").when(f.isNotNull() & (seq > f), "duplicate").otherwise("dlq")
    replay = F.when(
        F.col("outcome") == "dlq",
        F.when(f.isNotNull(), "duplicate")
        .when(g.isNull() | (seq < g), "failed")
        .when(seq == g, "recovered")
        .otherwise("duplicate"),
    )
    dlq, failed = F.col("outcome") == "dlq", F.col("replay") == "failed"
    taken = (F.col("outcome") == "accepted") | F.coalesce(F.col("replay") == "recovered", F.lit(False))
    return (
        joined.withColumn("outcome", outcome)
        .withColumn("replay", replay)
        .select(
            "seq",
            "event_id",
            "schema_version",
            "outcome",
            F.when(dlq, F.col("_s_code")).alias("reason_code"),
            F.when(dlq, F.col("_s_message")).alias("error_message"),
            "replay",
            F.when(failed, F.col("_m_code")).alias("replay_code"),
            F.when(failed, F.col("_m_message")).alias("replay_message"),
            F.when(taken, F.col("canonical")).alias("canonical"),
            "event",
        )
    )


def without_replay(routed: DataFrame) -> DataFrame:
    """Routed events as they stand before any replay: letters are pending, and nothing of them is accepted."""
    letter = F.col("outcome") == "dlq"
    keep = lambda c: F.when(~letter, F.col(c)).alias(c)
    return routed.select(*[keep(c) if c in ("replay", "replay_code", "replay_message", "canonical") else c for c in routed.columns])


def dead_letters(routed: DataFrame, *, replayed: bool = True, **limits) -> DataFrame:
    """DLQ records numbered in arrival order, before or after the one replay (ING-06, ING-08)."""
    letters = routed.filter(F.col("outcome") == "dlq").select(
        "seq", "event_id", "schema_version", "reason_code", "error_message", "replay", "replay_code", "replay_message", "event"
    )
    # only the positions are ordered; whole events are joined back by them
    rows = letters.join(numbered_rows(letters.select("seq"), ["seq"], "_number", **limits), "seq")
    entry = lambda status, code: F.struct(status.alias("status"), code.alias("reason_code"))
    first = F.array(entry(F.lit("pending"), F.col("reason_code")))
    if replayed:
        status, retries = F.col("replay"), F.lit(1)
        code = F.coalesce("replay_code", "reason_code")
        message = F.coalesce("replay_message", "error_message")
        history = F.array_append(first, entry(F.col("replay"), F.col("replay_code")))
    else:
        status, retries = F.lit("pending"), F.lit(0)
        code, message, history = F.col("reason_code"), F.col("error_message"), first
    return rows.select(
        "seq",
        numbered("DLQ-%05d", F.col("_number")).alias("dlq_id"),
        "event_id",
        "schema_version",
        code.alias("reason_code"),
        message.alias("error_message"),
        status.alias("status"),
        retries.alias("retry_count"),
        "event",
        history.alias("history"),
    )


def accepted(routed: DataFrame) -> DataFrame:
    """Canonical rows: first accepted in arrival order, then recovered in DLQ order (ING-09).

    The order is carried by (phase, seq), for the caller to sort by where it matters.
    """
    return routed.filter((F.col("outcome") == "accepted") | (F.col("replay") == "recovered")).select(
        F.when(F.col("outcome") == "accepted", 1).otherwise(2).alias("phase"), "seq", "canonical.*"
    )


def typed_customers(rows: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """Canonical fields are kept as text, so that a later coercion can count what it loses."""
    return rows.withColumns({c: F.col(c).try_cast("double") for c in numeric})


def ingest_counts(routed: DataFrame) -> DataFrame:
    """Counts of the outcomes by the schema version of what was taken (`_version`, null for the rest): they add up over batches."""
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    taken = F.count_if((F.col("outcome") == "accepted") | F.coalesce(F.col("replay") == "recovered", F.lit(False)))
    version = F.col("canonical.source_schema_version")
    return routed.groupBy(version.alias("_version")).agg(
        F.count(F.lit(1)).alias("received"),
        is_("outcome", "accepted").alias("accepted_initial"),
        is_("outcome", "dlq").alias("dlq_initial"),
        is_("replay", "recovered").alias("recovered"),
        is_("replay", "failed").alias("unresolved"),
        (is_("outcome", "duplicate") + is_("replay", "duplicate")).alias("duplicates"),
        taken.alias("accepted_total"),
    )


def summary_of_counts(per_version: DataFrame) -> DataFrame:
    """One row of counts from those per version (AGG-34, AGG-28)."""
    sums = [c for c in per_version.columns if c != "_version"]
    # at most one group per supported version and one for the rest
    versions = F.transform(
        F.filter(
            F.array_sort(F.collect_list(F.struct(F.col("_version").cast("string").alias("k"), F.col("accepted_total").alias("n")))),
            lambda e: e["k"].isNotNull(),
        ),
        lambda e: e,
    )
    return per_version.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.map_from_entries(versions).alias("accepted_schema_versions")
    )


def ingest_summary(routed: DataFrame) -> DataFrame:
    """One row of counts over the outcomes (AGG-34, AGG-28)."""
    return summary_of_counts(ingest_counts(routed))


def version_counts(rows: DataFrame) -> DataFrame:
    """Sorted map of rows per schema version in one row (AGG-28)."""
    n = rows.groupBy("source_schema_version").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(counts_map(F.col("source_schema_version"), F.col("n")).alias("versions"))
