from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegauge.config import ConcurrencyConfig
from tidegauge.operators import attempts as A
from tidegauge.operators import sample as S

SMALL = {"one_task_rows": 10, "slice_rows": 100}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("s"))


def test_split_sizes_and_repeatability(rows):
    marked = S.stratified_split(rows, ["s"], "id", 0.3, 42)
    n = {r.s: (r.n, r.k) for r in marked.groupBy("s").agg(F.count("*").alias("n"), F.count_if("chosen").alias("k")).collect()}
    assert sum(v[0] for v in n.values()) == 1000
    for size, taken in n.values():
        assert taken == round(size * 0.3)
    again = S.stratified_split(rows.repartition(7), ["s"], "id", 0.3, 42)
    assert marked.exceptAll(again).isEmpty()
    assert not marked.exceptAll(S.stratified_split(rows, ["s"], "id", 0.3, 43)).isEmpty()


def test_split_by_two_keys_and_edges(rows):
    two = rows.withColumn("t", (F.col("id") % 2).cast("int"))
    for fraction, wanted in ((0.0, 0), (1.0, 1000)):
        assert S.stratified_split(two, ["s", "t"], "id", fraction, 1).filter("chosen").count() == wanted


def test_exact_subset(rows):
    assert S.exact_subset(rows, "id", 0.015, 3).filter("chosen").count() == 15
    assert S.exact_subset(rows, "id", 0.001, 3, at_least=10).filter("chosen").count() == 10
    assert S.exact_subset(rows, "id", 0.001, 3, at_least=5000).filter("chosen").count() == 1000
    changed = S.set_on_subset(rows, "id", 0.12, 3, "s", F.lit(None))
    assert changed.filter("s is null").count() == 120 and changed.count() == 1000


def test_weighted_resample(rows):
    weight = F.when(F.col("s") == "hot", 6.0).when(F.col("s") == "s1", 0.0).otherwise(1.0)
    out = S.weighted_resample(rows, "id", weight, 5, new_id="new")
    n = Counter(r.s for r in out.collect())
    assert sum(n.values()) == 1000 and n["s1"] == 0
    sizes = Counter(r.s for r in rows.collect())
    share = 6 * sizes["hot"] / (6 * sizes["hot"] + 1000 - sizes["hot"] - sizes["s1"])
    assert n["hot"] / 1000 == pytest.approx(share, abs=0.05)
    assert out.select("new").distinct().count() == 1000 and out.filter("new = 'CUR-00000'").count() == 1
    sliced = S.weighted_resample(rows, "id", weight, 5, new_id="new", **SMALL)
    assert out.exceptAll(sliced).isEmpty() and sliced.count() == 1000


def test_one_row_may_hold_most_of_the_weight(rows):
    weight = F.when(F.col("id") == 500, 1e6).otherwise(1.0)
    out = S.weighted_resample(rows, "id", weight, 5, **SMALL)
    assert out.count() == 1000 and out.filter("id = 500").count() >= 990


LOG = "run_id string, sequence bigint, event_type string, elapsed_ms double, item_id bigint, attempt int, detail string, phase string"


def attempt_log(spark, items=12, permanent=(2, 4), transient=(5,)):
    out, seq, t = [], 0, 0.0

    def add(kind, item, attempt, detail="{}", phase="extract"):
        nonlocal seq, t
        seq, t = seq + 1, t + 1.5
        out.append(("r", seq, kind, t, item, attempt, detail, phase))

    for start in range(1, items + 1, 5):
        ids = list(range(start, min(items + 1, start + 5)))
        add("batch_started", None, None, f'{{"concurrency": 5, "ids": {ids}}}', "control")
        for i in ids:
            for attempt in (1, 2, 3):
                add("request_started", i, attempt)
                if i in permanent or (i in transient and attempt == 1):
                    add("request_failed", i, attempt, '{"error": "down", "error_type": "ServiceError"}')
                    if attempt < 3:
                        add("retry_scheduled", i, attempt, f'{{"wait_ms": {5.0 * 2 ** (attempt - 1)}}}')
                    else:
                        add("dead_letter", i, 3, '{"error": "down", "error_type": "ServiceError"}')
                else:
                    add("request_succeeded", i, attempt)
                    break
    add("validation_failed", 3, None, '{"error_count": 1}', "transform")
    add("transform_completed", None, None, "{}", "transform")
    return spark.createDataFrame(out, LOG)


def test_outcomes_and_summary(spark):
    log = attempt_log(spark).filter("phase != 'transform'")
    done = A.outcomes(log)
    by = {r.item_id: r for r in done.collect()}
    assert len(by) == 12 and {i for i, r in by.items() if r.status == "dead_letter"} == {2, 4}
    assert (by[5].attempts, by[5].retries, by[1].retries, by[2].retries) == (2, 1, 0, 2)
    letters = A.dead_letter_table(done).collect()
    assert {(r.id, r.error, r.error_type, r.attempts) for r in letters} == {(2, "down", "ServiceError", 3), (4, "down", "ServiceError", 3)}
    s = A.run_summary(attempt_log(spark)).first()
    assert (s.requested, s.extracted, s.extract_failed, s.valid, s.transform_invalid, s.retries) == (12, 10, 2, 9, 1, 5)
    assert s.total_seconds > s.extract_seconds > 0 and s.event_count == attempt_log(spark).count()


def test_batches_and_backoff(spark):
    members = {r.item_id: (r.batch, r.concurrency) for r in A.batch_members(attempt_log(spark)).collect()}
    assert len(members) == 12 and members[1] == members[5] == (1, 5) and members[6][0] > 1
    check = {r.attempt: (r.n, r.off_schedule) for r in A.backoff_check(attempt_log(spark), 5.0).collect()}
    assert check == {1: (3, 0), 2: (2, 0)}
    assert A.backoff_check(attempt_log(spark), 6.0).agg(F.sum("off_schedule")).first()[0] == 5


@pytest.mark.parametrize("limits", [{}, {"one_task_rows": 10, "slice_rows": 15}])
def test_events_are_evaluated_once(spark, limits):
    """Numbering, its range cut and the runs' starts don't compute the events again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def marked(ts):
        seen.add(1)
        return ts

    raw = spark.range(60).selectExpr("id AS event_id", "timestamp_seconds(id * 37 % 60) AS t", "cast(id % 2 as string) AS run_id")
    log = A.sequenced(raw.withColumn("ts", marked.asNondeterministic()("t")), "run_id", "ts", "event_id", **limits)
    got = {(r.run_id, r.sequence): (r.event_id, r.elapsed_ms) for r in log.collect()}
    assert seen.value == 60
    for run in ("0", "1"):
        mine = sorted((i * 37 % 60, i) for i in range(60) if str(i % 2) == run)
        assert [got[run, n] for n in range(1, 31)] == [(i, (s - mine[0][0]) * 1000.0) for s, i in mine]


def test_every_event_has_its_batch(spark):
    from tidegauge.plans.catalogue import load

    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    members = load()["batch_members"].run(spark, folder)
    assert members.count() == 2 * events and members.select("run_id", "batch").distinct().count() == events


def metrics(spark, n, seed=1):
    rng = random.Random(seed)
    return [("r" if i % 3 else "q", i, rng.choice([0.0, 0.0, 0.0, 0.5]), rng.choice([0.0, 0.0, 0.3]), rng.choice([10.0, 80.0, 90.0, 200.0])) for i in range(n)]


def replay(rows, config):
    level, out = {}, {}
    for run, batch, failure, retry, p95 in rows:
        before = level.get(run, config.initial)
        if failure >= 0.2 or retry >= 0.2 or p95 > config.latency_limit_ms:
            after = max(config.low, before // 2)
        elif failure == 0 and p95 < 0.75 * config.latency_limit_ms:
            after = min(config.high, before + 2)
        else:
            after = before
        level[run] = after
        out[run, batch] = (before, after)
    return out


TYPES = "run_id string, batch bigint, failure_rate double, retry_rate double, p95_ms double"


@pytest.mark.parametrize("chunk, fan", [(2048, 256), (7, 256), (3, 2)])
def test_trace_in_chunks(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(A, "CHUNK", chunk)
    monkeypatch.setattr(A, "FAN", fan)
    config = ConcurrencyConfig(low=2, high=9, initial=10)
    rows = metrics(spark, 120)
    trace = A.concurrency_trace(spark.createDataFrame(rows, TYPES), config)
    assert {(r.run_id, int(r.batch)): (r.before, r.after) for r in trace.collect()} == replay(rows, config)
    assert A.level_changes(trace).filter("before = after").isEmpty()


def test_fixed_runs_keep_their_level(spark):
    config = ConcurrencyConfig(low=2, high=9, initial=10)
    rows = metrics(spark, 60)
    mixed = spark.createDataFrame(rows, TYPES).withColumn("mode", F.when(F.col("run_id") == "q", "fixed-30").otherwise("adaptive"))
    got = {(r.run_id, r.batch): (r.before, r.after) for r in A.concurrency_trace(mixed, config).collect()}
    expected = {k: v if k[0] == "r" else (30, 30) for k, v in replay(rows, config).items()}
    assert got == expected
    assert A.concurrency_trace(mixed.limit(0), config).count() == 0


def test_start_level_and_speed(spark):
    df = spark.createDataFrame([("adaptive", 4.0, 2.0), ("fixed-30", 1.0, 0.0)], "mode string, a double, b double")
    assert [r[0] for r in df.select(A.start_level(F.col("mode"), ConcurrencyConfig())).collect()] == [10, 30]
    assert [r.speed_up for r in A.speed_up(df, "a", "b").collect()] == [2.0, None]


def test_nothing_measured_counts_as_zero(spark):
    done = spark.createDataFrame([("r", 1, "success", 0, None)], "run_id string, batch int, status string, retries int, latency_ms double")
    assert A.congestion(done).first().p95_ms == 0.0
