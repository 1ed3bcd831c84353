"""Routing, repair and replay, against fixtures and against a sequential re-telling of the rules."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.config import CANONICAL_FIELDS
from tidegauge.operators import ingest as I


def frame(spark, n=12, period="current"):
    rows = [
        (i, f"C-{i}", "Female" if i % 2 == 0 else "Male", i % 2, i + 1, 50.0 + i, 500.0 + 10 * i, "Month-to-month" if i % 2 == 0 else "One year",
         "Card" if i % 2 == 0 else "Transfer", 2 + i % 2, i % 2, period)
        for i in range(n)
    ]
    types = "seq bigint, customer_id string, gender string, senior int, tenure_months int, monthly_charges double, total_charges double, contract string, payment_method string, num_services int, churn int, period string"
    return spark.createDataFrame(rows, types)


def mixed(spark, faults=False, duplicate=False):
    events = I.to_events(frame(spark), F.when(F.col("seq") % 2 == 1, 2).otherwise(1), order="seq")
    sent = {r.seq: json.loads(r.event) for r in events.collect()}
    if faults:
        sent[0]["schema_version"] = 99
        sent[1]["payload"]["monthly_charges"] = sent[1]["payload"]["billing"].pop("monthlyCharges")
        sent[2]["payload"]["customerId"] = sent[2]["payload"].pop("customer_id")
        del sent[3]["payload"]["customerId"]
    if duplicate:
        sent[len(sent)] = sent[4]
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in sent.items()], "seq bigint, event string")


def test_both_versions_read_the_same(spark):
    row = frame(spark, 1)
    both = I.to_events(row, F.lit(1), order="seq").union(I.to_events(row, F.lit(2), order="seq"))
    first, second = [r.canonical.asDict() for r in I.normalize(both).collect()]
    assert (first.pop("source_schema_version"), second.pop("source_schema_version")) == (1, 2)
    assert first == second


def test_faults_are_repaired_where_safe(spark):
    routed = I.route(mixed(spark, faults=True))
    s = I.ingest_summary(routed).first()
    assert (s.received, s.accepted_initial, s.dlq_initial, s.recovered, s.unresolved, s.accepted_total) == (12, 8, 4, 3, 1, 11)
    letters = I.dead_letters(routed).orderBy("seq").collect()
    assert [x.dlq_id for x in letters] == ["DLQ-00001", "DLQ-00002", "DLQ-00003", "DLQ-00004"]
    assert {x.status for x in letters} == {"recovered", "failed"} and all(x.retry_count == 1 for x in letters)
    assert [h.status for h in letters[3].history] == ["pending", "failed"]
    assert I.dead_letters(routed, replayed=False).filter("status = 'pending' and retry_count = 0").count() == 4
    order = [r.customer_id for r in I.accepted(routed).orderBy("phase", "seq").collect()]
    assert order[-3:] == ["C-0", "C-1", "C-2"]


def test_duplicate_is_ignored(spark):
    s = I.ingest_summary(I.route(mixed(spark, duplicate=True))).first()
    assert (s.duplicates, s.accepted_total, s.dlq_initial) == (1, 12, 0)
    assert s.accepted_schema_versions == {"1": 6, "2": 6}


def test_failure_codes(spark):
    good = json.loads(I.to_events(frame(spark, 1), F.lit(1), order="seq").first().event)
    nested = json.loads(I.to_events(frame(spark, 1), F.lit(2), order="seq").first().event)
    change = lambda base, **kw: {**base, **kw}
    cases = {
        "[1]": "invalid_event",
        json.dumps(change(good, event_id="  ")): "missing_event_id",
        json.dumps(change(good, event_id=None)): "missing_event_id",
        json.dumps(change(good, schema_version="1")): "unsupported_schema",
        json.dumps(change(good, schema_version=3)): "unsupported_schema",
        json.dumps(change(good, payload=[1])): "invalid_structure",
        json.dumps(change(nested, payload={**nested["payload"], "label": 3})): "invalid_structure",
        json.dumps(change(good, payload={**good["payload"], "gender": None, "contract": None})): "missing_required_field",
        json.dumps(change(good, payload={**good["payload"], "churn": 2})): "invalid_churn",
        json.dumps(change(good, payload={**good["payload"], "churn": "1"})): "invalid_churn",
        json.dumps(change(good, payload={**good["payload"], "total_charges": None, "gender": ""})): None,
        "{broken": "invalid_event",
    }
    df = spark.createDataFrame([(k,) for k in cases], "event string")
    got = {r.event: r for r in I.normalize(df).collect()}
    assert {k: r.reason_code for k, r in got.items()} == cases
    assert "missing fields: gender, contract" in {r.error_message for r in got.values()}


def tell(events):
    """One event after the other, with a set of accepted ids; then the letters once more."""
    def valid(e):
        return e["ok"]

    accepted, letters, out = set(), [], {}
    for e in events:
        if e["id"] in accepted:
            out[e["seq"]] = ("duplicate", None)
        elif valid(e):
            accepted.add(e["id"])
            out[e["seq"]] = ("accepted", None)
        else:
            letters.append(e)
    for e in letters:
        if e["id"] in accepted:
            out[e["seq"]] = ("dlq", "duplicate")
        elif e["mendable"]:
            accepted.add(e["id"])
            out[e["seq"]] = ("dlq", "recovered")
        else:
            out[e["seq"]] = ("dlq", "failed")
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_streams(spark, seed):
    """Ids repeat, one of them in a third of all events."""
    rng = random.Random(seed)
    base = json.loads(I.to_events(frame(spark, 1), F.lit(1), order="seq").first().event)
    events, texts = [], []
    for i in range(300):
        e = {"seq": i, "id": "hot" if rng.random() < 0.33 else f"e{rng.randint(0, 90)}", "ok": rng.random() < 0.4, "mendable": rng.random() < 0.5}
        payload = dict(base["payload"])
        if not e["ok"]:
            if e["mendable"]:
                payload["customerId"] = payload.pop("customer_id")
            else:
                payload["churn"] = 5
        events.append(e)
        texts.append((i, json.dumps({"event_id": e["id"], "schema_version": 1, "payload": payload})))
    df = spark.createDataFrame(texts, "seq bigint, event string").repartition(3)
    got = {r.seq: (r.outcome, r.replay) for r in I.route(df).collect()}
    assert got == tell(events)


def test_earlier_runs_count(spark):
    events = mixed(spark)
    known = spark.createDataFrame([("current:C-3",), ("other",)], "event_id string")
    assert I.route(events, known).filter("outcome = 'duplicate'").select("event_id").collect() == [("current:C-3",)]


def test_fields_are_complete(spark):
    row = I.accepted(I.route(mixed(spark))).first().asDict()
    assert set(CANONICAL_FIELDS) <= set(row)
