"""End-to-end jobs: read, work, write. Each returns its summary row and leaves tables under `out`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CANONICAL_FIELDS, MonitorConfig
from ..operators import aggregate as A
from ..operators import clean as C
from ..operators import drift as D
from ..operators import ingest as I
from ..operators import model as M
from ..operators import stats as T
from ..operators import validate as V
from ..operators.attribution import root_cause_report
from ..operators.profile import quality_snapshot
from ..operators.scale import stage
from ..sources import fetch as FE
from ..sources.gates import require_binary_target, require_columns, require_rows
from ..sources.sinks import fresh_path, write_bundle
from .record_queries import PRODUCT_FIELDS, USER_FIELDS


def log_report(logs: DataFrame, top: int = 5) -> dict[str, DataFrame]:
    """Web-log roll-up: all counts in one pass, the 5xx rate, the busiest paths and addresses."""
    require_columns(logs, ("ip", "timestamp", "path", "status"))
    rows = logs.withColumn("hour", F.substring("timestamp", 12, 2))
    counts = stage(A.keyed_counts(rows, ["status", "path", "hour", "ip"], "timestamp"), "log-counts")
    best = lambda d: A.top_k(counts.filter(F.col("dimension") == d), top, F.desc("n"), F.asc("first_pos"), F.asc("key"))
    return {"counts": counts, "errors": A.error_rate(logs, "status"), "top_paths": best("path"), "top_ips": best("ip")}


def user_records(envelope: DataFrame, out: str) -> DataFrame:
    """Validate the records of an envelope; valid and invalid rows apart."""
    text = F.to_json("record")
    checked = stage(V.validate(envelope.withColumn("text", text), "record", USER_FIELDS).drop("record"), "checked-users")
    invalid = V.invalid_rows(checked, ["row"], "text").withColumn("id", F.get_json_object("data", "$.id"))
    write_bundle({"valid_records": (V.valid_rows(checked), "json"), "invalid_records": (invalid, "json")}, out)
    return V.split_counts(checked)


def product_etl(ids: DataFrame, call: Callable[[int, int], dict], out: str, **fetching) -> DataFrame:
    """Fetch, validate, flatten, write as CSV and Parquet; failures of both stages in one table."""
    fetched = stage(FE.fetch(ids, call, **fetching), "fetched")
    raw = fetched.filter(F.col("payload").isNotNull()).withColumn("record", F.try_parse_json("payload"))
    checked = stage(V.validate(raw, "record", PRODUCT_FIELDS).drop("record"), "checked-products")
    products = V.valid_rows(checked).orderBy("id")
    letters = FE.dead_letters(fetched).select("id", "stage", "error_type", "error")
    invalid = V.invalid_rows(checked, ["id"], "payload").unionByName(letters, allowMissingColumns=True)
    counts = FE.retry_metrics(fetched).select("requested", "collected", "failed").first()
    split = V.split_counts(checked)
    summary = split.select(
        F.lit(counts["requested"]).alias("requested"),
        "extracted",
        F.lit(counts["failed"]).alias("extract_failed"),
        "valid",
        F.col("invalid").alias("transform_invalid"),
        (F.col("invalid") + counts["failed"]).alias("invalid_total"),
    )
    write_bundle(
        {
            "products_csv": (products, "csv"),
            "products_parquet": (products, "parquet"),
            "invalid_records": (invalid, "json"),
            "summary": (summary, "json"),
        },
        out,
    )
    return summary


def clean_sales_job(raw: DataFrame, managers: DataFrame, categories: list[str], out: str) -> DataFrame:
    """Recipe A with summary, pivot, manager join and metrics; a broken join stops the job."""
    clean, bounds = C.clean_sales(raw)
    clean = stage(clean, "clean-sales")
    check = C.join_check(clean, managers, "category", "manager").first()
    if check["rows_before"] != check["rows_after"]:
        raise ValueError("the join changed the number of rows")
    if check["unmatched"]:
        raise ValueError(f"{check['unmatched']} rows have no manager")
    merged = C.join_dimension(clean, managers, "category", "manager").select("order_id", "category", "manager")
    metrics = C.sales_metrics(raw, clean, bounds)
    write_bundle(
        {
            "sales_clean": (clean, "csv"),
            "category_summary": (A.category_summary(clean), "csv"),
            "region_category_pivot": (A.pivot_sum(clean, "region", "category", "amount", categories), "csv"),
            "merge_sample": (A.top_k(merged, 50, F.asc("order_id")), "csv"),
            "metrics": (metrics, "json"),
        },
        out,
    )
    return metrics


def sales_report_job(spark: SparkSession, raw: DataFrame, out: str, top_n: int = 5, at: datetime | None = None) -> str:
    """Recipe B and the KPI table under a new time-stamped path."""
    clean = C.report_sales(raw)
    require_rows(clean)
    path = fresh_path(spark, out, "sales_report", at)
    A.sales_report(clean, top_n).write.mode("errorifexists").json(path)
    return path


def churn_study(rows: DataFrame, config: MonitorConfig, out: str, **forest) -> dict[str, DataFrame]:
    """Profile by class, box-plot data, Welch t, chi-square, a risk model on 80 % judged on the rest, saved and read back."""
    require_binary_target(require_rows(require_columns(rows, CANONICAL_FIELDS)), "customer_id", "churn")
    from ..operators.compare import predictions_equal
    from ..operators.sample import stratified_split

    split = stratified_split(rows, ["churn"], "customer_id", 0.8, config.seed, "_train")
    model = M.train(split.filter("_train"), config, **forest)
    held = split.filter(~F.col("_train")).drop("_train")
    again = M.save(model, f"{out}/churn_model")
    scored = stage(M.score(model, held, config), "scored")
    if not predictions_equal(scored, M.score(again, held, config), "customer_id", "risk_score").first()["equal"]:
        raise RuntimeError("the reloaded model predicts something else")
    profile = rows.groupBy("churn").agg(
        F.count(F.lit(1)).alias("customers"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("monthly_charges", "tenure_months", "total_charges")],
    )
    return {
        "profile": profile.orderBy("churn"),
        "box_plot": A.five_numbers(rows, ["churn", "contract"], "monthly_charges"),
        "rates": A.rate_by(rows, "contract", "churn"),
        "welch": T.welch_t(rows, "monthly_charges", F.col("churn") == 1, F.col("churn") == 0),
        "chi_square": T.chi_square(A.cross_tab(rows, "contract", "churn"), "contract", "churn"),
        "auc": M.auc(scored, "churn", "risk_score"),
        "report": M.classification_report(scored, "churn", "high_risk"),
        "confusion": M.confusion(scored, "churn", "high_risk"),
    }


def _clean(rows: DataFrame, config: MonitorConfig) -> DataFrame:
    return C.clean_customers(
        rows,
        required=CANONICAL_FIELDS,
        numeric=config.numeric,
        texts=("gender", "contract", "payment_method"),
        target="churn",
        grouped="total_charges",
        group="contract",
    )


def monitor_periods(
    reference_events: DataFrame, current_events: DataFrame, out: str, config: MonitorConfig = MonitorConfig(), **forest
) -> dict[str, DataFrame]:
    """Two periods of raw events -> intake, quality, drift, causes, model change, health; tables under `out`.

    Null rates are taken from the normalised rows before cleaning, so cleaning cannot hide a quality problem.
    """
    routed = {p: stage(I.route(e), f"routed-{p}") for p, e in ((D.REFERENCE, reference_events), (D.CURRENT, current_events))}
    # the replay belongs to the current period; a reference letter stays a letter
    routed[D.REFERENCE] = I.without_replay(routed[D.REFERENCE])
    raw = {p: I.accepted(r).select(*CANONICAL_FIELDS) for p, r in routed.items()}
    features = [*config.numeric, *config.categorical]
    missing = stage(D.missing_rates(D.two_periods(raw[D.REFERENCE], raw[D.CURRENT]), features), "missing")
    clean = {p: stage(_clean(r, config), f"clean-{p}") for p, r in raw.items()}
    both = stage(D.two_periods(clean[D.REFERENCE], clean[D.CURRENT]), "both")
    profile = D.DriftProfile(both, config)
    drift = stage(profile.table(missing), "drift")
    summaries = [I.ingest_summary(r).withColumn("period", F.lit(p)) for p, r in routed.items()]
    summary = stage(summaries[0].unionByName(summaries[1]), "intake")
    unresolved = summary.filter(F.col("period") == D.CURRENT).select("unresolved").scalar()
    quality = [quality_snapshot(r, "customer_id", [*config.numeric, "churn"]).withColumn("period", F.lit(p)) for p, r in raw.items()]
    metrics, change, risk_causes = M.monitor(clean[D.REFERENCE], clean[D.CURRENT], "customer_id", config, **forest)
    results = {
        "drift_metrics": drift,
        "health": D.health(drift, unresolved),
        "distributions": profile.distributions(),
        "root_causes": root_cause_report(both, drift, config),
        "dlq_records": I.dead_letters(routed[D.CURRENT]),
        "intake_summary": summary,
        "quality": quality[0].unionByName(quality[1]),
        "model_metrics": metrics,
        "model_change": change,
        "risk_causes": risk_causes,
    }
    write_bundle({name: (df.coalesce(1) if name == "drift_metrics" else df, "json") for name, df in results.items()}, out)
    return results
