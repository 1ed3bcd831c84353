from __future__ import annotations

import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import collections as J
from tidegauge.functions import dates as D
from tidegauge.functions import numeric as N
from tidegauge.functions import text as X
from tidegauge.operators.aggregate import error_rate, keyed_counts, summary, top_k
from tidegauge.operators.compare import compare
from tidegauge.sources import fetch as FE
from tidegauge.sources import readers as R
from tidegauge.sources import sinks as S

EVENTS = "event_id string,event_type string,amount double"


def events_csv(tmp_path):
    p = tmp_path / "events.csv"
    p.write_text("event_id,event_type,amount\nA,purchase,100\nB,purchase,50\nC,refund,20\nD,view,0\n")
    return str(p)


def test_one_query_three_ways(spark, tmp_path):
    """Frame, SQL over a file and SQL over a frame agree."""
    path = events_csv(tmp_path)
    df = R.read_csv(spark, path, EVENTS, required=["event_type", "amount"])
    frame = summary(df.filter("amount > 0"), ["event_type"], "amount").orderBy("event_type")
    assert [tuple(r) for r in frame.collect()] == [("purchase", 2, 2, 75.0, 150.0), ("refund", 1, 1, 20.0, 20.0)]
    text = "SELECT event_type, count(*) n_rows, count(amount) n_values, avg(amount) mean_value, sum(amount) sum_value FROM {} WHERE amount > 0 GROUP BY event_type"
    R.csv_view(spark, "file_events", path)
    R.view(df, "frame_events")
    values = ["n_rows", "n_values", "mean_value", "sum_value"]
    for name in ("file_events", "frame_events"):
        assert compare(frame, spark.sql(text.format(name)), ["event_type"], values).first().equal
    off = frame.withColumn("sum_value", F.col("sum_value") + 1e-3)
    r = compare(frame, off, ["event_type"], values).first()
    assert (r.cells_off, r.equal) == (2, False)
    assert compare(frame, off, ["event_type"], values, atol=1e-2).first().equal
    assert compare(frame.limit(1), frame, ["event_type"], values).first().only_second == 1


def test_column_gate_and_missing_texts(spark, tmp_path):
    with pytest.raises(ValueError, match="ip, status"):
        R.read_csv(spark, events_csv(tmp_path), EVENTS, required=["status", "ip"])
    df = spark.createDataFrame([("NA", 1), ("x", 2), ("null", 3)], "s string, n int")
    assert R.texts_to_null(df).filter("s is null").count() == 2


def test_log_rollup(spark):
    rows = [(1, "200", "/a"), (2, "500", "/b"), (3, "503", "/a"), (4, None, "/a")]
    df = spark.createDataFrame(rows, "pos int, status string, path string")
    got = {(r.dimension, r.key): (r.n, r.first_pos) for r in keyed_counts(df, ["status", "path"], "pos").collect()}
    assert got["total", None] == (4, 1) and got["path", "/a"] == (3, 1) and got["status", None] == (1, 4) and len(got) == 7
    assert tuple(error_rate(df, "status").first()) == (4, 2, 50.0)
    assert error_rate(df.filter("false"), "status").first().error_pct is None
    with pytest.raises(ValueError):
        top_k(df, 0, F.asc("pos"))


@pytest.mark.parametrize(
    "text,fault",
    [
        ('{"count": 1, "results": [', "line 1, column"),
        ("[1]", "top level"),
        ('{"count": 0}', "no results"),
        ('{"count": 1, "results": [1]}', "objects only"),
        ('{"count": 2, "results": [{}]}', "differs"),
        ('{"results": [{}]}', "differs"),
    ],
)
def test_faulty_envelopes(spark, tmp_path, text, fault):
    p = tmp_path / "e.json"
    p.write_text(text)
    with pytest.raises(ValueError, match=fault):
        R.read_envelopes(spark, str(p))


def test_envelope(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text(json.dumps({"status": "ok", "count": 2, "results": [{"id": 5}, {"id": 6}]}, indent=2))
    rows = R.read_envelopes(spark, str(p)).select("row", J.at(F.col("record"), "id", "int").alias("id")).orderBy("row").collect()
    assert [tuple(r) for r in rows] == [(1, 5), (2, 6)]


def service(item, attempt):
    import time

    if item == 3:
        time.sleep(0.5)
    if item == 4:
        raise KeyError("gone")
    if item == 5 and attempt == 1:
        raise TimeoutError("slow")
    return {"id": item, "name": "ü"}


def test_fetch(spark):
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    ids = spark.range(1, 8)
    got = FE.fetch(ids, service, max_concurrent=3, max_attempts=2, timeout_seconds=0.1, backoff_seconds=0.001)
    rows = {r.id: r for r in got.collect()}
    assert len(rows) == 7 and json.loads(rows[1].payload) == {"id": 1, "name": "ü"}
    assert (rows[5].attempts, rows[5].retries) == (2, 1)
    assert rows[3].payload is None and rows[3].attempts == 2 and "gave up after 2" in rows[3].error
    assert (rows[4].error_type, rows[4].attempts) == ("KeyError", 1)
    assert {r.id for r in FE.dead_letters(got).collect()} == {3, 4}
    assert tuple(FE.retry_metrics(got).first()) == (7, 5, 2, 2)
    assert {(r.id, r.retries) for r in FE.retries_by_id(got).collect()} == {(3, 1), (5, 1)}
    with pytest.raises(ValueError):
        FE.fetch(ids, service, max_concurrent=0)
    waits = spark.range(1, 4).select(FE.backoff(0.05, F.col("id")).alias("w")).collect()
    assert [r.w for r in waits] == [0.05, 0.1, 0.2]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", 1.5, None), (2, "b", None, "x")], "id int, s string, v double, n string")
    S.write_bundle({"a": (df, "csv"), "b": (df, "parquet"), "c": (df, "json")}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/b").schema == df.schema
    assert R.read_csv(spark, f"{tmp_path}/a", "id int, s string, v double, n string").exceptAll(df).isEmpty()
    text = "".join(open(f"{tmp_path}/c/{f}", encoding="utf-8").read() for f in os.listdir(f"{tmp_path}/c") if f.endswith(".json"))
    assert "é" in text and '"n":null' in text
    with pytest.raises(Exception, match="exists"):
        S.write_parquet(df, f"{tmp_path}/b")


def test_paths_never_collide(spark, tmp_path):
    at = datetime(2026, 7, 20, 1, 2, 3)
    paths = []
    for _ in range(3):
        p = S.fresh_path(spark, str(tmp_path), "report", at)
        os.mkdir(p)
        paths.append(os.path.basename(p))
    assert paths == ["report_20260720_010203", "report_20260720_010203_01", "report_20260720_010203_02"]


def test_event_log_is_in_order(spark, tmp_path):
    log = spark.range(500).select(F.lit("r").alias("run_id"), (499 - F.col("id")).alias("sequence"))
    S.write_event_log(log, f"{tmp_path}/log")
    for f in os.listdir(f"{tmp_path}/log"):
        if f.endswith(".json"):
            numbers = [json.loads(line)["sequence"] for line in open(f"{tmp_path}/log/{f}")]
            assert numbers == list(range(numbers[0], numbers[0] + len(numbers)))


def test_plan_shows_pushdown(spark):
    df = R.table(spark, "/root/testdata/sf0.001", "events").filter(F.col("value") > 10).groupBy("event_type").count()
    plan = S.plan_text(df)
    assert "GreaterThan(value,10.0)" in plan and "ReadSchema: struct<event_type:string,value:double>" in plan


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_scalar_edges(spark):
    lit = F.lit
    assert one(spark, X.strip(lit("\t a b \n")), X.is_email(lit("a@b.c")), X.is_email(lit("a b@c.d")), X.is_email(lit("a@b"))) == ("a b", True, False, False)
    assert one(spark, X.elided(F.array(*[lit(i) for i in range(1, 8)])), X.elided(F.array(lit(1), lit(2)))) == ("1→2→3→…→6→7", "1→2")
    assert one(spark, X.short_label(lit("abcdefghijklmno")), X.part_as_int(lit("fixed-10"), "-", 2), X.part_as_int(lit("adaptive"), "-", 2)) == ("abcdefghijkl…", 10, None)
    assert one(spark, X.percent(lit(0.1234)), X.signed(lit(-1.5)), X.thousands(lit(1234.5)), X.numbered("A-%03d", lit(7))) == ("12.3%", "-1.50", "1,234.50", "A-007")
    nan, none = lit(float("nan")), lit(None).cast("double")
    assert one(spark, N.to_number(lit("x")), N.to_number(lit("nan")), N.to_number(lit(" 1.5 ")), N.nan_to_null(nan), N.clip(none, 0.0, 1.0), N.clip(lit(5.0), 0.0, 1.0)) == (None, None, 1.5, None, None, 1.0)
    assert one(spark, N.half_even(lit(2.5)), N.half_even(lit(3.5)), N.positive_or_null(lit(-1))) == (2.0, 4.0, None)
    days = [D.mixed_timestamp(lit(t)) for t in ("2025-01-02", "2025/01/02", "01/02/2025", "20250102", "2025-01-02T03:04:05")]
    assert all(d.date().isoformat() == "2025-01-02" for d in one(spark, *days))
    assert one(spark, D.mixed_timestamp(lit("invalid")), D.mixed_timestamp(lit("2025-13-02")), D.iso_date(lit("20240702"))) == (None, None, None)
    u = one(spark, N.unit_value(1, lit("a")), N.unit_value(1, lit("a")), N.unit_value(2, lit("a")), N.jittered(lit(10.0), 0.5, 1, lit("a")))
    assert u[0] == u[1] != u[2] and 0 <= u[0] < 1 and 5 <= u[3] <= 15
    assert one(spark, J.all_present(F.array(lit("a"), lit(None))), J.missing_names({"x": none, "y": lit(1)})) == (False, ["x"])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_mixed_timestamps_are_cast_like_their_patterns(spark, zone):
    draw = random.Random(3)
    two, four = (lambda top: f"{draw.randrange(top):02d}"), (lambda: f"{draw.choice([0, 1, 1582, 1883, 1900, 2000, 2024, 2025, 9999]):04d}")
    forms = ["{y}-{m}-{d}", "{y}-{m}-{d} {h}:{n}:{s}", "{y}-{m}-{d}T{h}:{n}:{s}", "{y}/{m}/{d}", "{m}/{d}/{y}", "{y}{m}{d}", "{y}-{m}/{d}", "{y}.{m}.{d}"]
    texts = [
        f.format(y=four(), m=two(14), d=two(33), h=two(26), n=two(62), s=two(62)) for f in forms for _ in range(400)
    ] + [
        None, "", "unknown", " 2025-01-02", "2025-01-02 ", "2025-01-02\n", "2025-1-2", "2025-01-2 ", "2025-01-2T", "+025-01-02", "2025-01-02 3:04:05", "1/2/2025 ",
        "2025-01-02T03:04:05Z", "2025-03-09 02:30:00", "2025-11-02 01:30:00", "٢٠٢٥-01-02", "12/31/2024", "13/31/2024", "20250229", "20240229", "02/29/2023",
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
        by_pattern = D.mixed_timestamp(F.col("t"), {**D.MIXED_LAYOUTS, "dd.MM.yyyy": r"^\d{2}\.\d{2}\.\d{4}\z"})
        both = rows.select("t", D.micros(D.mixed_timestamp(F.col("t"))).alias("cast"), D.micros(by_pattern).alias("pattern"))
        found = both.collect()
        assert [tuple(r) for r in found if r["cast"] != r["pattern"]] == []
        assert sum(r["cast"] is not None for r in found) > 1000
        plan = rows.select(D.mixed_timestamp(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "gettimestamp" not in plan and "gettimestamp" in both._jdf.queryExecution().optimizedPlan().toString().lower()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_words_are_no_numbers_without_a_parse(spark):
    texts = [
        None, "", " ", "1", "-1", "+1", ".5", "-.5", "1.", "1e3", "1E-3", "1d", "1F", "0x1p3", " 1.5 ", "\t2\n", "n/a", "NaN", "nan", " nan", "+NaN", "inf", "Inf", "INF", "+inf",
        "-inf", "Infinity", "infinity", "-Infinity", " inf ", "information", "unknown", "1,000", "$5", ":5", "e5", "E5", "d", "x1", "١٢", "１", "\u00a01", "1\u00a0", "1 2", "--1", "\x7f1",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    found = rows.select("t", N.to_number(F.col("t")).alias("parsed"), N.text_to_number(F.col("t")).alias("quick")).collect()
    assert [tuple(r) for r in found if r.parsed != r.quick] == []
    assert {r.t for r in found if r.quick == float("inf")} >= {"inf", "Infinity", "+inf"}


def test_rounded_is_round(spark):
    draw = random.Random(5)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e300, 1e14, 1e10 + 0.00005, 123456789.00005, -2.00005, 5e-324, 1e-7, 0.00005, 2.5e-7]
    values += [draw.randrange(10**9) / 10**draw.randrange(9) for _ in range(4000)]
    values += [draw.randrange(10**8) / 10**4 + 0.00005 for _ in range(2000)] + [draw.randrange(10**8) / 10**6 + 0.0000005 for _ in range(2000)]
    values += [draw.uniform(-1, 1) * 10 ** draw.randrange(16) for _ in range(4000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    both = [(F.round("v", d).cast("string").alias(f"r{d}"), N.rounded(F.col("v"), d).cast("string").alias(f"q{d}")) for d in (0, 2, 4, 6)]
    found = rows.select("v", *[c for pair in both for c in pair]).collect()
    assert [r for r in found if any(r[f"r{d}"] != r[f"q{d}"] for d in (0, 2, 4, 6))] == []
