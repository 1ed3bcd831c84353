"""Streams over several micro-batches give the batch result; the model survives saving."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from test_ingest import tell
from test_sample_attempts import TYPES, metrics, replay
from tidegauge.config import ConcurrencyConfig, MonitorConfig
from tidegauge.operators import model as M
from tidegauge.operators.compare import predictions_equal
from tidegauge.sources.readers import stream_csv
from tidegauge.streaming import adaptive, counters, intake, recurring
from tidegauge.streaming.run import drain


def written(spark, folder, df, parts, order):
    """`parts` files whose order is the arrival order."""
    import time

    n = df.count()
    for i in range(parts):
        size = -(-n // parts)
        part = df.filter((F.col(order) >= i * size) & (F.col(order) < (i + 1) * size))
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_forest_rows_are_dealt_over_tasks(spark, monkeypatch):
    """One input partition is trained on and scored in many tasks."""
    from tidegauge.operators import scale

    monkeypatch.setattr(scale, "COSTLY_ROWS", 50)
    staged = []
    monkeypatch.setattr(M, "stage", lambda df, tag: staged.append((tag, df.rdd.getNumPartitions())) or scale.stage(df, tag))
    config = MonitorConfig(numeric=("x",), categorical=("k",), first_target="x")
    df = spark.range(200, numPartitions=1).selectExpr("id", "cast(id % 17 as double) AS x", "cast(id % 3 as string) AS k", "cast(id % 17 > 8 as int) AS churn")
    model = M.train(df, config, trees=2, depth=3)
    scored = M.score(model, df, config)
    assert staged == [("training-rows", 4)] and scored.rdd.getNumPartitions() == 4 and scored.count() == 200


def test_route_over_batches(spark, tmp_path):
    import json
    import random

    from test_ingest import frame
    from tidegauge.operators import ingest as I

    rng = random.Random(8)
    base = json.loads(I.to_events(frame(spark, 1), F.lit(1), order="seq").first().event)
    events, texts = [], []
    for i in range(60):
        e = {"seq": i, "id": "hot" if rng.random() < 0.33 else f"e{rng.randint(0, 15)}", "ok": rng.random() < 0.4, "mendable": rng.random() < 0.5}
        payload = dict(base["payload"])
        if not e["ok"]:
            if e["mendable"]:
                payload["customerId"] = payload.pop("customer_id")
            else:
                payload["churn"] = 5
        events.append(e)
        texts.append((i, json.dumps({"event_id": e["id"], "schema_version": 1, "payload": payload})))
    df = spark.createDataFrame(texts, "seq bigint, event string")
    stream = written(spark, f"{tmp_path}/in", df, 3, "seq")
    folder = f"{tmp_path}/out"
    intake.route_stream(stream, folder, f"{tmp_path}/check").awaitTermination()
    expected = tell(events)
    for name in ("accepted", "dlq", "duplicate"):
        got = spark.read.parquet(f"{folder}/{name}")
        assert {r.seq for r in got.collect()} == {s for s, (o, _) in expected.items() if o == name}
    assert spark.read.parquet(f"{folder}/accepted").select("batch").distinct().count() > 1
    assert {r.seq: r.replay for r in intake.replay_letters(spark, folder).collect()} == {s: r for s, (o, r) in expected.items() if r}
    # recovered ids are accepted now, no letter is pending any more, and a repaired event sent again is a duplicate
    mended = {s for s, (o, r) in expected.items() if r == "recovered"}
    assert {r.seq for r in spark.read.parquet(f"{folder}/accepted").filter("batch < 0").collect()} == mended
    assert intake.replay_letters(spark, folder).count() == 0
    assert intake.replay_letters(spark, folder, 1).count() == sum(o == "dlq" for o, _ in expected.values())
    assert {r.seq for r in spark.read.parquet(f"{folder}/accepted").filter("batch < 0").collect()} == mended
    again = spark.createDataFrame([(1000 + s, t) for s, t in texts if s in mended], "seq bigint, event string")
    intake.route_batch(again, 99, folder)
    assert spark.read.parquet(f"{folder}/duplicate").filter("batch = 99").count() == len(mended)
    # the last batch once more changes nothing
    before = spark.read.parquet(f"{folder}/accepted").count()
    intake.route_batch(df.filter("seq >= 40"), 2, folder)
    assert spark.read.parquet(f"{folder}/accepted").count() == before


def test_adaptive_over_batches(spark, tmp_path):
    config = ConcurrencyConfig(low=2, high=9, initial=8)
    rows = metrics(spark, 30)
    stream = written(spark, f"{tmp_path}/m", spark.createDataFrame(rows, TYPES), 3, "batch")
    got = drain(adaptive.adaptive_levels(stream, config), "adaptive-test")
    assert {(r.run_id, r.batch): (r.before, r.after) for r in got.collect()} == replay(rows, config)


def test_counts_and_late_rows(spark, tmp_path):
    times = ["00:10", "05:00", "05:10", "00:20", "09:00"]
    rows = [(i, f"2024-01-01 {t}:00", "b" if i > 2 else "a") for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "i int, t string, k string").withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    stream = written(spark, f"{tmp_path}/c", df, 5, "i")
    got = {(r.window_start.hour, r.k): r.n for r in drain(counters.hourly_counts(stream, "ts", "k"), "late").collect()}
    assert got == {(0, "a"): 1, (5, "a"): 2}  # the 00:20 row came after the watermark, the last window is open
    again = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/c")
    assert {r.k: r.n for r in drain(counters.running_counts(again, "k"), "running", "complete").collect()} == {"a": 3, "b": 2}
    with pytest.raises(ValueError):
        drain(counters.running_counts(again, "k"), "running", "update")


def test_accept_once_over_batches(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", f"e{i % 4}") for i in range(12)]
    df = spark.createDataFrame(rows, "i int, t string, event_id string").withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    stream = written(spark, f"{tmp_path}/d", df, 3, "i")
    assert drain(intake.accept_once(stream, "ts"), "once-test").count() == 4


def test_failing_batch_does_not_stop_the_next(spark, tmp_path):
    df = spark.range(4).select(F.col("id").alias("i"))
    stream = written(spark, f"{tmp_path}/g", df, 4, "i")
    seen = []

    def task(batch, n):
        if n == 1:
            raise RuntimeError("broken")
        seen.append(n)

    recurring.recurring(stream, task, f"{tmp_path}/gc").awaitTermination()
    assert seen == [0, 2, 3]
    assert recurring.guarded(lambda b, n: "done", f"{tmp_path}/gf")(df, 0) == "done"
    with pytest.raises(ValueError):
        recurring.recurring(stream, task, f"{tmp_path}/gx", 0)


def test_failed_batch_is_worked_off_by_the_next_run(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("i"))
    stream = written(spark, f"{tmp_path}/h", df, 3, "i")
    seen, broken = [], [True]

    def task(batch, n):
        rows = [r.i for r in batch.collect()]
        if n == 1 and broken:
            raise RuntimeError("broken")
        seen.extend(rows)

    recurring.recurring(stream, task, f"{tmp_path}/hc").awaitTermination()
    assert sorted(seen) == [0, 2]
    recurring.recurring(stream, task, f"{tmp_path}/hc").awaitTermination()
    assert sorted(seen) == [0, 2]  # it failed again and is still kept
    broken.clear()
    recurring.recurring(stream, task, f"{tmp_path}/hc").awaitTermination()
    assert sorted(seen) == [0, 1, 2]
    recurring.recurring(stream, task, f"{tmp_path}/hc").awaitTermination()
    assert sorted(seen) == [0, 1, 2]


def test_a_broken_accepted_table_is_an_error(spark, tmp_path):
    (tmp_path / "accepted" / "batch=0").mkdir(parents=True)
    (tmp_path / "accepted" / "batch=0" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        intake.route_batch(spark.createDataFrame([(1, "{}")], "seq bigint, event string"), 1, str(tmp_path))


def test_csv_stream(spark, tmp_path):
    (tmp_path / "x.csv").write_text("ip,status\n1,200\n2,500\n")
    stream = stream_csv(spark, str(tmp_path), "ip string, status string", 1)
    assert drain(counters.running_counts(stream, "status"), "csv", "complete").count() == 2


CONFIG = MonitorConfig(numeric=("x", "z"), categorical=("c",), first_target="x", min_group_size=5)


def people(spark, n=400):
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 10 != 0, (F.col("id") % 50).cast("double")).alias("x"),
        (F.col("id") % 7).cast("double").alias("z"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"),
        ((F.col("id") % 50 > 35) | (F.col("id") % 13 == 0)).cast("int").alias("churn"),
    )


def test_model_saves_and_scores(spark, tmp_path):
    df = people(spark)
    model = M.train(df, CONFIG, trees=8, depth=4, leaf=3)
    again = M.save(model, f"{tmp_path}/model")
    odd = df.withColumn("c", F.when(F.col("id") < 5, "never seen").when(F.col("id") < 9, F.lit(None)).otherwise(F.col("c")))
    first, second = M.score(model, odd, CONFIG), M.score(again, odd, CONFIG)
    assert predictions_equal(first, second, "id", "risk_score").first().equal
    assert first.count() == 400 and first.filter("risk_score < 0 or risk_score > 1").isEmpty()
    assert M.auc(first, "churn", "risk_score").first().roc_auc > 0.8


def test_monitor(spark):
    metrics_, change, causes = M.monitor(people(spark), people(spark).withColumn("x", F.col("x") + 20), "id", CONFIG, trees=8, depth=4)
    by = {r.period: r for r in metrics_.collect()}
    assert by["current"].rows == 400 and by["reference"].rows == pytest.approx(120, abs=1)
    assert {r.metric: r.change for r in change.collect()}["average_risk"] > 0
    assert causes.first().direction == "increase"


def test_class_weights_and_empty_classes(spark):
    w = {r.churn: r.weight for r in M.balanced_weights(people(spark), "churn").select("churn", "weight").distinct().collect()}
    ones = people(spark).filter("churn = 1").count()
    assert w[1] == pytest.approx(400 / (2 * ones))
    none = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    report = {r["class"]: r for r in M.classification_report(none, "y", "p").collect()}
    assert report["1"].precision == 0 and report["0"].recall == 1 and report["accuracy"].f1 == 0.5
    assert {(r.actual, r.predicted): r.n for r in M.confusion(none, "y", "p").collect()} == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert M.auc(none.filter("y = 0"), "y", "p").first().roc_auc is None


def test_standardize(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 8.0)], "i int, x double")
    out = {r.i: r.x for r in M.standardize(df, ["x"]).collect()}
    assert sum(out.values()) == pytest.approx(0) and out[2] == out[3]
    constant = M.standardize(spark.createDataFrame([(1, 2.0), (2, 2.0)], "i int, x double"), ["x"])
    assert {r.x for r in constant.collect()} == {0.0}
