"""The end-to-end jobs on small inputs."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_clean import sales
from test_sources import EVENTS  # noqa: F401
from test_validate import USER
from tidegauge.config import MonitorConfig
from tidegauge.operators import ingest as I
from tidegauge.operators.scale import clear_staging, stage
from tidegauge.plans import jobs
from tidegauge.sources.readers import read_envelopes


def test_log_report(spark):
    rows = [("1.1.1.1", f"2025-03-01T0{i % 3}:00:0{i % 9}", "/a" if i % 2 else "/b", "500" if i == 4 else "200") for i in range(9)]
    out = jobs.log_report(spark.createDataFrame(rows, "ip string, timestamp string, path string, status string"))
    assert out["errors"].first().errors == 1 and out["top_ips"].first().n == 9
    assert [r.key for r in out["top_paths"].collect()] == ["/b", "/a"]
    with pytest.raises(ValueError, match="status"):
        jobs.log_report(spark.createDataFrame([("a",)], "ip string"))


def test_user_records(spark, tmp_path):
    users = [{**USER, "id": i} for i in range(1, 6)]
    users[2]["age"] = 200
    (tmp_path / "api.json").write_text(json.dumps({"status": "ok", "count": 5, "results": users}))
    s = jobs.user_records(read_envelopes(spark, str(tmp_path / "api.json")), f"{tmp_path}/out").first()
    assert (s.valid, s.invalid) == (4, 1)
    bad = spark.read.json(f"{tmp_path}/out/invalid_records").first()
    assert (bad.row, bad.id, bad.stage) == (3, "3", "transform")


def product(item, attempt):
    if item in (9,) and attempt == 1:
        raise TimeoutError("slow")
    price = -100.0 if item in (13, 29) else 8.5 + item
    return {"id": item, "name": f" Product {item} ", "category": " AI ", "price": price, "seller": {"seller_id": item % 7 + 1, "region": "Seoul"}}


def test_product_etl(spark, tmp_path):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    s = jobs.product_etl(spark.range(1, 31), product, f"{tmp_path}/out", max_concurrent=4, backoff_seconds=0.001).first()
    assert tuple(s) == (30, 30, 0, 28, 2, 2)
    saved = spark.read.parquet(f"{tmp_path}/out/products_parquet")
    assert saved.count() == 28 and saved.filter("id in (13, 29)").isEmpty() and dict(saved.dtypes)["price"] == "double"
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/products_csv").count() == 28
    assert {r.id for r in spark.read.json(f"{tmp_path}/out/invalid_records").collect()} == {13, 29}


def test_sales_jobs(spark, tmp_path):
    managers = spark.createDataFrame([("Food", "Ada"), ("Home", "Ben")], "category string, manager string")
    m = jobs.clean_sales_job(sales(spark), managers, ["Food", "Home"], f"{tmp_path}/a").first()
    assert (m.rows, m.missing_before, m.missing_after) == (4, 4, 0)
    with pytest.raises(ValueError, match="no manager"):
        jobs.clean_sales_job(sales(spark), managers.limit(1), ["Food", "Home"], f"{tmp_path}/b")
    at = datetime(2026, 1, 1)
    paths = [jobs.sales_report_job(spark, sales(spark), str(tmp_path), 2, at) for _ in range(2)]
    assert paths[1] == paths[0] + "_01" and spark.read.json(paths[0]).filter("section = 'kpi'").count() == 4


CONFIG = MonitorConfig(min_group_size=20)


def people(spark, rows=600, seed=7):
    rng = np.random.default_rng(seed)
    data = [
        (i, f"C-{i}", "Female" if i % 2 else "Male", i % 2, int(rng.integers(1, 73)), float(rng.normal(70, 12)), float(rng.normal(2500, 600)),
         "Month-to-month" if i % 2 else "Two year", "Electronic check" if i % 3 else "Credit card", int(rng.integers(1, 9)), int(rng.random() < (0.6 if i % 2 else 0.2)))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "seq bigint, customer_id string, gender string, senior int, tenure_months int, monthly_charges double, total_charges double, contract string, payment_method string, num_services int, churn int")


def test_churn_study(spark, tmp_path):
    out = jobs.churn_study(people(spark).drop("seq"), CONFIG, str(tmp_path), trees=8, depth=4)
    assert out["chi_square"].first().pvalue < 1e-6 and out["auc"].first().roc_auc > 0.5
    assert out["profile"].count() == 2 and out["rates"].first().contract == "Two year" and out["box_plot"].count() == 4
    assert out["report"].filter("class = 'accuracy'").first().support == 120


def test_monitor_periods(spark, tmp_path):
    now = people(spark).withColumn("monthly_charges", F.col("monthly_charges") + F.when(F.col("contract") == "Month-to-month", 45).otherwise(0))
    now = now.withColumn("total_charges", F.when(F.col("seq") % 8 != 0, F.col("total_charges")))
    feed = lambda df, period, version: I.to_events(df.withColumn("period", F.lit(period)), version, order="seq")
    old = feed(people(spark), "reference", F.lit(1))
    new = feed(now, "current", F.when(F.col("seq") % 2 == 1, 2).otherwise(1))
    new = new.withColumn("event", F.when(F.col("seq") < 10, F.regexp_replace("event", '"churn":[01]', '"churn":7')).otherwise(F.col("event")))
    out = jobs.monitor_periods(old, new, str(tmp_path / "m"), CONFIG, trees=8, depth=4)
    drift = {r.feature: r for r in out["drift_metrics"].collect()}
    assert drift["monthly_charges"].status == "danger" and drift["total_charges"].status == "danger"
    assert drift["total_charges"].missing_change_pp == pytest.approx(12.5, abs=0.5)
    causes = out["root_causes"].filter("target = 'monthly_charges'").collect()
    best = max(causes, key=lambda c: c.contribution)
    named = next(c for c in causes if c.segment == "Month-to-month")
    assert named.contribution == pytest.approx(best.contribution) and named.within_effect > 10
    h = out["health"].first()
    assert h.unresolved == 10 and h.overall == "danger" and h.health_score == 0
    assert spark.read.json(f"{tmp_path}/m/dlq_records").count() == 10 and out["model_change"].count() == 5


def test_staging_is_cleared(spark):
    staged = stage(spark.range(5))
    files = staged.inputFiles()
    assert staged.count() == 5 and files
    clear_staging(spark)
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
