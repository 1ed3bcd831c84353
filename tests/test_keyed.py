"""Keyed state gives the batch result: over several micro-batches, after a restart, in any order."""

from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from test_ingest import frame, tell
from test_sample_attempts import TYPES, metrics, replay
from tidegauge.config import ConcurrencyConfig
from tidegauge.operators import ingest as I
from tidegauge.streaming import intake, keyed
from tidegauge.streaming.run import drain


def feed(spark, n=60, hot=0.33, seed=8):
    rng = random.Random(seed)
    base = json.loads(I.to_events(frame(spark, 1), F.lit(1), order="seq").first().event)
    told, texts = [], []
    for i in range(n):
        e = {"seq": i, "id": "hot" if rng.random() < hot else f"e{rng.randint(0, 15)}", "ok": rng.random() < 0.4, "mendable": rng.random() < 0.5}
        payload = dict(base["payload"])
        if not e["ok"] and e["mendable"]:
            payload["customerId"] = payload.pop("customer_id")
        elif not e["ok"]:
            payload["churn"] = 5
        told.append(e)
        texts.append((i, json.dumps({"event_id": e["id"], "schema_version": 1, "payload": payload})))
    return told, texts


def add(spark, folder, rows, kind):
    time.sleep(0.02)
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)


EVENT = "seq bigint, event string"


def read(spark, folder, kind):
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder)


def test_route_keyed_over_restarts(spark, tmp_path):
    told, texts = feed(spark)
    folder, check = f"{tmp_path}/out", f"{tmp_path}/check"

    def go():
        keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), folder, check).awaitTermination()

    for part in (texts[:20], texts[20:40]):
        add(spark, f"{tmp_path}/in", part, EVENT)
    go()
    add(spark, f"{tmp_path}/in", texts[40:], EVENT)
    go()  # a new query that finds the state of the first
    expected = tell(told)
    for name in ("accepted", "dlq", "duplicate"):
        got = [r.seq for r in spark.read.parquet(f"{folder}/{name}").collect()]
        assert sorted(got) == sorted(s for s, (o, _) in expected.items() if o == name)
    assert spark.read.parquet(f"{folder}/accepted").select("batch").distinct().count() > 1
    assert {r.seq: r.replay for r in keyed.replay_keyed(spark, folder).collect()} == {s: r for s, (o, r) in expected.items() if r}
    # recovered ids are known to the state: whatever comes with one is a duplicate
    mended = {s for s, (_, r) in expected.items() if r == "recovered"}
    assert mended
    again = [(1000 + s, t) for s, t in texts if s in mended]
    go()
    add(spark, f"{tmp_path}/in", again, EVENT)
    go()
    assert {r.seq for r in spark.read.parquet(f"{folder}/duplicate").collect()} >= {s for s, _ in again}


def test_route_keyed_equals_route(spark, tmp_path):
    _, texts = feed(spark, 90, 0.5, 9)
    texts += [(200, "not json"), (201, json.dumps({"schema_version": 1})), (202, None)]
    add(spark, f"{tmp_path}/in", texts, EVENT)
    keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    want = {(r.seq, r.outcome) for r in I.route(spark.createDataFrame(texts, EVENT)).collect()}
    got = {(r.seq, o) for o in ("accepted", "dlq", "duplicate") for r in spark.read.parquet(f"{tmp_path}/out/{o}").collect()}
    assert got == want


def test_failed_batch_runs_again_from_the_same_state(spark, tmp_path, monkeypatch):
    told, texts = feed(spark, 30)
    folder, check = f"{tmp_path}/out", f"{tmp_path}/check"
    add(spark, f"{tmp_path}/in", texts[:15], EVENT)
    keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), folder, check).awaitTermination()
    add(spark, f"{tmp_path}/in", texts[15:], EVENT)
    whole = keyed.write_routed

    def half(routed, to, n):
        whole(routed, to, n)
        raise RuntimeError("lost after writing")

    monkeypatch.setattr(keyed, "write_routed", half)
    with pytest.raises(Exception, match="lost after writing"):
        keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), folder, check).awaitTermination()
    monkeypatch.setattr(keyed, "write_routed", whole)
    keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), folder, check).awaitTermination()
    expected = tell(told)
    for name in ("accepted", "dlq", "duplicate"):
        got = [r.seq for r in spark.read.parquet(f"{folder}/{name}").collect()]
        assert sorted(got) == sorted(s for s, (o, _) in expected.items() if o == name)


def test_levels_of_batches_in_any_order(spark, tmp_path):
    config = ConcurrencyConfig(low=2, high=9, initial=8)
    rows = metrics(spark, 30)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("batch") * 60)
    timed = spark.createDataFrame(rows, TYPES).withColumn("ts", at)
    shuffled = [tuple(r) for r in timed.orderBy(F.xxhash64("run_id", "batch")).collect()]
    kind = timed.schema.simpleString()[7:-1].replace(":", " ")
    folder = f"{tmp_path}/m"
    for i in range(5):
        add(spark, folder, shuffled[i::5], kind)
    end = timed.limit(1).withColumns({"run_id": F.lit("~end"), "ts": F.timestamp_seconds(F.lit(1_800_000_000))})
    add(spark, folder, [tuple(r) for r in end.collect()], kind)
    live = keyed.ordered_levels(read(spark, folder, kind), config, lateness="1 day")
    with keyed.rocks_state(spark):
        got = drain(live, "ordered")
    assert {(r.run_id, r.batch): (r.before, r.after) for r in got.filter("run_id <> '~end'").collect()} == replay(rows, config)


def test_late_batches_and_idle_runs(spark, tmp_path):
    kind = "run_id string, batch bigint, failure_rate double, retry_rate double, p95_ms double, ts timestamp"
    at = lambda minute: __import__("datetime").datetime.fromtimestamp(1_700_000_000 + 60 * minute)
    row = lambda run, batch, bad, minute: (run, batch, float(bad), 0.0, 1.0, at(minute))
    config = ConcurrencyConfig(low=1, high=30, initial=8)
    parts = [
        [row("a", 2, 0, 20)], [row("a", 1, 1, 10)],  # in time though after the later one
        [row("b", 1, 0, 500)], [row("b", 2, 0, 510)], [row("a", 0, 1, 5)],  # an hour is long over: dropped
        [row("a", 3, 0, 5000)], [row("b", 3, 0, 100_000)], [row("a", 4, 0, 200_000)],  # a's level was forgotten before
        [row("z", 1, 0, 400_000)],
    ]
    for part in parts:
        add(spark, f"{tmp_path}/m", part, kind)
    live = keyed.ordered_levels(read(spark, f"{tmp_path}/m", kind), config, lateness="1 hour", idle_ms=20_000 * 60_000)
    with keyed.rocks_state(spark):
        got = {(r.run_id, r.batch): (r.before, r.after) for r in drain(live, "late-levels").collect()}
    assert got == {("a", 1): (8, 4), ("a", 2): (4, 6), ("a", 3): (6, 8), ("b", 1): (8, 10), ("b", 2): (10, 12), ("b", 3): (8, 10), ("a", 4): (8, 10)}


def test_events_of_one_file_are_dealt_before_they_are_judged(spark, tmp_path, monkeypatch):
    judged = keyed.judged_events
    task = F.spark_partition_id().cast("string")
    monkeypatch.setattr(keyed, "judged_events", lambda events: judged(events).withColumn("_s_message", task))
    rows = [(i, "no event") for i in range(400)]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{tmp_path}/in")
    keyed.route_keyed(read(spark, f"{tmp_path}/in", EVENT), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    letters = spark.read.parquet(f"{tmp_path}/out/dlq")
    assert letters.count() == 400
    assert letters.select("error_message").distinct().count() > 1
