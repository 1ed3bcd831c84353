"""Drift, attribution, tests, sampling and model monitoring on the shared tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import MonitorConfig
from ..operators import attribution as A
from ..operators import drift as D
from ..operators import model as M
from ..operators import report as R
from ..operators import sample as S
from ..operators import sketches as K
from ..operators import stats as T
from ..operators.aggregate import cross_tab
from ..operators.scale import own_folder, stage
from ..sources.readers import table
from .catalogue import query
from .tables import LINE_CONFIG, LINES_SQL, line_periods

NUMERIC = LINE_CONFIG.numeric
CATEGORICAL = LINE_CONFIG.categorical

LONG_SQL = f"""{LINES_SQL},
long AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, period, {f} AS value FROM lines WHERE {f} IS NOT NULL" for f in NUMERIC)}),
edges AS (SELECT feature, q, list_sort(list_distinct(q)) AS d FROM
          (SELECT feature, quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q
           FROM long WHERE period = 'reference' GROUP BY feature)),
inner_edges AS (SELECT feature, CASE WHEN len(d) = 1 THEN d WHEN len(d) < 3 THEN [q[6]] ELSE d[2:-2] END AS e FROM edges),
binned AS (SELECT feature, period, len(list_filter(e, lambda x: value > x)) AS bin FROM long JOIN inner_edges USING (feature)),
counted AS (SELECT feature, bin, count(*) FILTER (period = 'reference') AS r, count(*) FILTER (period = 'current') AS c FROM binned GROUP BY feature, bin),
cells AS (SELECT feature, unnest(range(len(e) + 1)) AS bin FROM inner_edges),
shares AS (SELECT feature, bin, coalesce(r, 0) / sum(coalesce(r, 0)::DOUBLE) OVER (PARTITION BY feature) AS r,
                  coalesce(c, 0) / sum(coalesce(c, 0)::DOUBLE) OVER (PARTITION BY feature) AS c
           FROM cells LEFT JOIN counted USING (feature, bin)),
terms AS (SELECT *, (c - r) * ln((c + 1e-6::DOUBLE) / (r + 1e-6::DOUBLE)) AS v FROM shares),
psi AS (SELECT feature, sum(v) AS psi FROM terms GROUP BY feature),
cdf AS (SELECT feature, value, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS fc
        FROM (SELECT feature, value, count(*) FILTER (period = 'reference')::DOUBLE AS r, count(*) FILTER (period = 'current')::DOUBLE AS c
              FROM long GROUP BY feature, value) WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, max(abs(fr - fc)) AS ks FROM cdf GROUP BY feature),
sizes AS (SELECT feature, count(*) FILTER (period = 'reference')::DOUBLE AS n, count(*) FILTER (period = 'current')::DOUBLE AS m,
                 avg(value) FILTER (period = 'reference') AS ref_mean, avg(value) FILTER (period = 'current') AS cur_mean,
                 median(value) FILTER (period = 'reference') AS ref_median, median(value) FILTER (period = 'current') AS cur_median
          FROM long GROUP BY feature),
texts AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, period, coalesce({f}, 'Unknown') AS value FROM lines" for f in CATEGORICAL)}),
kinds AS (SELECT feature, value, r, c, r / sum(r) OVER (PARTITION BY feature) AS sr, c / sum(c) OVER (PARTITION BY feature) AS sc FROM
          (SELECT feature, value, count(*) FILTER (period = 'reference')::DOUBLE AS r, count(*) FILTER (period = 'current')::DOUBLE AS c
           FROM texts GROUP BY feature, value)),
js_terms AS (SELECT *, CASE WHEN sr > 0 THEN sr * ln((sr + 1e-6::DOUBLE) / ((sr + sc) / 2 + 1e-6::DOUBLE)) ELSE 0 END
                    + CASE WHEN sc > 0 THEN sc * ln((sc + 1e-6::DOUBLE) / ((sr + sc) / 2 + 1e-6::DOUBLE)) ELSE 0 END AS kl FROM kinds),
js AS (SELECT feature, sum(kl) / 2 AS js, max(abs(round_even(sr, 6) - round_even(sc, 6))) AS gap, count(*) FILTER (r = 0 AND c > 0) AS n_new,
              arg_min(value, (-r, value)) AS ref_top, arg_min(value, (-c, value)) AS cur_top FROM js_terms GROUP BY feature)"""


def ordered(spark, sf):
    from ..operators.scale import stage_counted

    counts, rows = stage_counted(D.period_value_counts(line_periods(spark, sf), NUMERIC), "numeric-counts")
    return D.ordered_values(counts, rows=rows)


@query("psi", "STA-04 STA-05 JN-07 AGG-21", f"WITH {LONG_SQL} SELECT feature, round(psi, 8) AS psi FROM psi")
def psi(spark, sf):
    values = ordered(spark, sf)
    summary = stage(D.numeric_summary(values), "numeric-summary")
    return D.psi(D.psi_bins(values, summary)).withColumn("psi", F.round("psi", 8))


@query(
    "psi_bins", "STA-04 STA-05 JN-02 JN-07",
    f"WITH {LONG_SQL} SELECT feature, bin, round(r, 8) AS ref_share, round(c, 8) AS cur_share, round(v, 8) AS contribution FROM terms",
)
def psi_bins(spark, sf):
    values = ordered(spark, sf)
    bins = D.psi_bins(values, stage(D.numeric_summary(values), "numeric-summary"))
    return bins.select("feature", F.col("bin").cast("bigint").alias("bin"), *[F.round(x, 8).alias(x) for x in ("ref_share", "cur_share", "contribution")])


@query(
    "ks", "STA-03 WIN-04",
    f"""WITH {LONG_SQL}
        SELECT feature, round(ks, 10) AS ks_statistic, round(CASE WHEN lam < 0.02 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
                 (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * lam)) FROM range(1, 101) t(k)))) END, 8) AS ks_pvalue
        FROM (SELECT feature, ks, ks * ks * n * m / (n + m) AS lam FROM ks JOIN sizes USING (feature))""",
)
def ks(spark, sf):
    return D.numeric_summary(ordered(spark, sf)).select("feature", F.round("ks_statistic", 10).alias("ks_statistic"), F.round("ks_pvalue", 8).alias("ks_pvalue"))


@query(
    "js", "STA-06 STA-09 AGG-21 JN-02 SET-02",
    f"WITH {LONG_SQL} SELECT feature, round(js, 10) AS js, round(gap, 6) AS max_share_change, n_new, ref_top, cur_top FROM js",
)
def js(spark, sf):
    c = stage(D.period_value_counts(line_periods(spark, sf), CATEGORICAL, text=True), "category-counts")
    out = D.js(D.js_categories(c)).join(D.top_values(c), "feature")
    return out.withColumns({"js": F.round("js", 10), "max_share_change": F.round("max_share_change", 6)})


@query(
    "new_categories", "JN-03 SET-04",
    f"""WITH {LINES_SQL} SELECT DISTINCT l_linestatus FROM lines WHERE period = 'current'
        AND l_linestatus NOT IN (SELECT l_linestatus FROM lines WHERE period = 'reference')""",
)
def new_categories(spark, sf):
    both = line_periods(spark, sf)
    side = lambda p: both.filter(F.col("period") == p)
    return D.new_categories(side("reference"), side("current"), "l_linestatus")


TABLE_SQL = f"""{LONG_SQL},
missing AS ({" UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg(({f} IS NULL)::INT) FILTER (period = 'reference') AS rm, avg(({f} IS NULL)::INT) FILTER (period = 'current') AS cm FROM lines"
    for f in (*NUMERIC, *CATEGORICAL))}),
results AS (
  SELECT feature, 'numeric' AS kind, 'PSI' AS metric, psi AS score, round(cur_mean - ref_mean, 6) AS change,
         CASE WHEN psi >= 0.25 THEN 2 WHEN psi >= 0.10 THEN 1 ELSE 0 END AS severity, round(ref_median, 6) AS ref_median, round(cur_median, 6) AS cur_median
  FROM psi JOIN sizes USING (feature)
  UNION ALL SELECT feature, 'categorical', 'JS', js, round(gap, 6), CASE WHEN js >= 0.020 THEN 2 WHEN js >= 0.005 THEN 1 ELSE 0 END, NULL, NULL FROM js),
drift AS (
  SELECT feature, kind, metric, round(score, 8) AS score, change, ref_median, cur_median, round((cm - rm) * 100, 6) AS missing_change_pp,
         CASE greatest(severity, CASE WHEN (cm - rm) * 100 >= 4 THEN 2 WHEN (cm - rm) * 100 >= 2 THEN 1 ELSE 0 END)
           WHEN 2 THEN 'danger' WHEN 1 THEN 'warning' ELSE 'stable' END AS status
  FROM results JOIN missing USING (feature))"""


def profile(both):
    return D.DriftProfile(both, LINE_CONFIG)


@query("drift_table", "STA-07 STA-08 STA-09 AGG-22 ORD-05 SET-01", f"WITH {TABLE_SQL} SELECT * FROM drift")
def drift_table(spark, sf):
    both = line_periods(spark, sf)
    missing = stage(D.missing_rates(both, [*NUMERIC, *CATEGORICAL]), "missing")
    t = profile(both).table(missing)
    rounded = {"score": 8, "change": 6, "ref_median": 6, "cur_median": 6, "missing_change_pp": 6}
    return t.select("feature", "kind", "metric", "status", *[F.round(c, d).alias(c) for c, d in rounded.items()])


@query(
    "drift_health", "AGG-26 AGG-27",
    f"""WITH {TABLE_SQL}, n AS (SELECT count(*) FILTER (status = 'danger') AS danger, count(*) FILTER (status = 'warning') AS warning FROM drift)
        SELECT danger, warning, 2 AS unresolved, CAST(greatest(0, 100 - 18 * danger - 7 * warning - 24) AS INT) AS health_score,
               CASE WHEN danger > 0 THEN 'danger' ELSE 'warning' END AS overall FROM n""",
)
def drift_health(spark, sf):
    both = line_periods(spark, sf)
    missing = stage(D.missing_rates(both, [*NUMERIC, *CATEGORICAL]), "missing")
    return D.health(profile(both).table(missing), 2)


@query(
    "distributions", "REP-03",
    f"""WITH {LONG_SQL}
        SELECT feature, bin AS position, round(r, 6) AS ref_share, round(c, 6) AS cur_share, NULL::VARCHAR AS label FROM terms
        UNION ALL SELECT feature, NULL, round(sr, 6), round(sc, 6), value FROM kinds""",
)
def distributions(spark, sf):
    d = profile(line_periods(spark, sf)).distributions()
    return d.select(
        "feature", F.col("position").cast("bigint").alias("position"), "ref_share", "cur_share",
        F.when(F.col("position").isNull(), F.col("label")).alias("label"),
    )


def causes_sql(target: str, segments: tuple[str, ...], lines: str = LINES_SQL, categorical: tuple[str, ...] = CATEGORICAL) -> str:
    """Decomposition of a mean shift over segments, the same arithmetic in SQL; `lines` defines the table of that name."""
    quartiles = [s for s in segments if s not in categorical]
    label = "'(' || coalesce(CAST(e[i] AS VARCHAR), '-inf') || ', ' || coalesce(CAST(e[i + 1] AS VARCHAR), 'inf') || ']'"
    parts = [f"SELECT '{s}' AS segment_feature, coalesce({s}, 'Unknown') AS segment, period, {target} AS t FROM lines" for s in segments if s in categorical]
    parts += [
        f"""SELECT '{s}', {label}, period, t FROM (SELECT period, {target} AS t, e, len(list_filter(e, lambda x: {s} > x)) AS i
            FROM lines, (SELECT d[2:-2] AS e FROM (SELECT list_sort(list_distinct(quantile_cont({s}, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS d FROM lines)) WHERE {s} IS NOT NULL)"""
        for s in quartiles
    ]
    return f"""{lines},
w AS (SELECT count(*) FILTER (period = 'reference')::DOUBLE AS nr, count(*) FILTER (period = 'current')::DOUBLE AS nc,
             avg({target}) FILTER (period = 'current') - avg({target}) FILTER (period = 'reference') AS delta FROM lines),
g AS (SELECT segment_feature, segment, count(*) FILTER (period = 'reference') AS kr, count(*) FILTER (period = 'current') AS kc,
             avg(t) FILTER (period = 'reference') AS mr, avg(t) FILTER (period = 'current') AS mc FROM ({" UNION ALL ".join(parts)}) GROUP BY ALL),
e AS (SELECT segment_feature, segment, kr, kc, 0.5::DOUBLE * (kr / nr + kc / nc) * (mc - mr) AS within_effect,
             0.5::DOUBLE * (kr / nr + kc / nc) * ((mc - mr) - delta) AS centered, 0.5::DOUBLE * (mr + mc) * (kc / nc - kr / nr) AS mix_effect, delta
      FROM g, w WHERE kr >= 80 AND kc >= 80),
causes AS (SELECT *, abs(centered) + abs(mix_effect) AS score, (abs(centered) + abs(mix_effect)) / sum(abs(centered) + abs(mix_effect)) OVER () AS contribution FROM e)"""


SEGMENTS = (*CATEGORICAL, "l_quantity", "l_discount", "l_tax")


@query(
    "root_cause", "STA-10 STA-11 STA-12 FLT-05 WIN-02 ORD-06",
    f"""WITH {causes_sql('l_extendedprice', SEGMENTS)}
        SELECT segment_feature, kr AS reference_count, kc AS current_count, round(within_effect, 4) AS within_effect,
               round(mix_effect, 4) AS mix_effect, round(score, 4) AS explanation_score, round(contribution, 6) AS contribution,
               CASE WHEN delta > 0 THEN 'increase' WHEN delta < 0 THEN 'decrease' ELSE 'stable' END AS direction
        FROM causes ORDER BY round_even(contribution, 10) DESC, segment_feature, segment LIMIT 6""",
)
def root_cause(spark, sf):
    top = A.explain_shift(line_periods(spark, sf), "l_extendedprice", LINE_CONFIG, SEGMENTS)
    return top.select(
        "segment_feature", "reference_count", "current_count", F.round("within_effect", 4).alias("within_effect"),
        F.round("mix_effect", 4).alias("mix_effect"), F.round("explanation_score", 4).alias("explanation_score"),
        F.round("contribution", 6).alias("contribution"), "direction",
    )


TARGETS_SQL = """
named AS (SELECT coalesce(list(feature ORDER BY status = 'danger' DESC, score DESC, feature), []) AS f FROM drift WHERE kind = 'numeric' AND status IN ('danger', 'warning')),
targets AS (SELECT unnest(f) AS target, generate_subscripts(f, 1) AS place FROM
            (SELECT (CASE WHEN list_contains(f, 'l_extendedprice') THEN f ELSE list_prepend('l_extendedprice', f) END)[1:3] AS f FROM named)),
every AS (""" + " UNION ALL ".join(
    f"""SELECT '{t}' AS target, *, row_number() OVER (ORDER BY round_even(contribution, 10) DESC, segment_feature, segment) AS i
        FROM (WITH {causes_sql(t, (*CATEGORICAL, *(c for c in NUMERIC if c != t)))} SELECT * FROM causes)"""
    for t in NUMERIC
) + ")"


@query(
    "root_cause_report", "STA-13 ORD-07 FLT-04",
    f"""WITH {TABLE_SQL}, {TARGETS_SQL}
        SELECT target, segment_feature, kr AS reference_count, kc AS current_count, round(within_effect, 4) AS within_effect,
               round(mix_effect, 4) AS mix_effect, round(score, 4) AS explanation_score, round(contribution, 6) AS contribution,
               CASE WHEN delta > 0 THEN 'increase' WHEN delta < 0 THEN 'decrease' ELSE 'stable' END AS direction
        FROM every JOIN targets USING (target) WHERE i <= 6""",
)
def root_cause_report(spark, sf):
    both = line_periods(spark, sf)
    missing = stage(D.missing_rates(both, [*NUMERIC, *CATEGORICAL]), "missing")
    report = A.root_cause_report(both, stage(profile(both).table(missing), "drift"), LINE_CONFIG)
    return report.select(
        "target", "segment_feature", "reference_count", "current_count", F.round("within_effect", 4).alias("within_effect"),
        F.round("mix_effect", 4).alias("mix_effect"), F.round("explanation_score", 4).alias("explanation_score"),
        F.round("contribution", 6).alias("contribution"), "direction",
    )


@query(
    "drift_payload", "REP-02 AGG-26 AGG-27 ORD-06 STA-13",
    f"""WITH {TABLE_SQL}, {TARGETS_SQL},
        n AS (SELECT count(*) FILTER (status = 'danger') AS danger, count(*) FILTER (status = 'warning') AS warning FROM drift),
        top AS (SELECT feature || ':' || status AS t, row_number() OVER (ORDER BY CASE status WHEN 'danger' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END DESC, score DESC, feature) AS i FROM drift),
        first AS (SELECT every.* FROM every JOIN targets USING (target) WHERE place = 1 AND i = 1)
        SELECT danger, warning, 1 AS unresolved, CAST(greatest(0, 100 - 18 * danger - 7 * warning - 12) AS INT) AS health_score,
               CASE WHEN danger > 0 THEN 'danger' ELSE 'warning' END AS overall,
               (SELECT string_agg(t, ',' ORDER BY i) FROM top WHERE i <= 5) AS top_drift, target AS primary_target, segment_feature AS primary_feature,
               round(score, 4) AS primary_score, round(contribution, 6) AS primary_contribution FROM n, first""",
)
def drift_payload(spark, sf):
    both = line_periods(spark, sf)
    missing = stage(D.missing_rates(both, [*NUMERIC, *CATEGORICAL]), "missing")
    drift = stage(profile(both).table(missing), "drift")
    payload = R.report_payload(drift, A.root_cause_report(both, drift, LINE_CONFIG), 1)
    return payload.select(
        "danger", "warning", "unresolved", "health_score", "overall",
        F.array_join(F.transform("top_drift", lambda d: F.concat_ws(":", d["feature"], d["status"])), ",").alias("top_drift"),
        F.col("primary_cause.target").alias("primary_target"), F.col("primary_cause.segment_feature").alias("primary_feature"),
        F.round("primary_cause.explanation_score", 4).alias("primary_score"), F.round("primary_cause.contribution", 6).alias("primary_contribution"),
    )


RISKS_SQL = """
lines AS (SELECT CASE WHEN o_orderdate >= TIMESTAMP '1998-06-01' THEN 'current' ELSE 'reference' END AS period, o_orderpriority, strftime(o_orderdate, '%a') AS weekday,
                 o_totalprice, o_totalprice / (o_totalprice + CASE WHEN o_orderpriority LIKE '1%' AND o_orderdate >= TIMESTAMP '1998-06-01' THEN 60000.0::DOUBLE ELSE 200000.0 END) AS risk_score
          FROM orders)"""


@query(
    "risk_causes", "ML-08",
    f"""WITH {causes_sql('risk_score', ('o_orderpriority', 'weekday', 'o_totalprice'), RISKS_SQL, ('o_orderpriority', 'weekday'))}
        SELECT segment_feature, kr AS reference_count, kc AS current_count, round(within_effect, 6) AS within_effect, round(mix_effect, 6) AS mix_effect,
               round(contribution, 6) AS contribution, CASE WHEN delta > 0 THEN 'increase' WHEN delta < 0 THEN 'decrease' ELSE 'stable' END AS direction
        FROM causes ORDER BY round_even(contribution, 10) DESC, segment_feature, segment LIMIT 6""",
)
def risk_causes(spark, sf):
    """Why the mean of given scores rises: urgent orders are scored higher in the later period."""
    now = F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp_ntz")
    half = F.when(now & F.startswith("o_orderpriority", F.lit("1")), 60000.0).otherwise(200000.0)
    scored = table(spark, sf, "orders").select(
        F.when(now, "current").otherwise("reference").alias("period"), "o_orderpriority", F.date_format("o_orderdate", "E").alias("weekday"),
        "o_totalprice", (F.col("o_totalprice") / (F.col("o_totalprice") + half)).alias("risk_score"),
    )
    found = M.risk_causes(scored, MonitorConfig(numeric=("o_totalprice",), categorical=("o_orderpriority", "weekday")))
    return found.select(
        "segment_feature", "reference_count", "current_count", F.round("within_effect", 6).alias("within_effect"),
        F.round("mix_effect", 6).alias("mix_effect"), F.round("contribution", 6).alias("contribution"), "direction",
    )


@query(
    "segment_labels", "STA-10 JN-07",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(c_acctbal, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS d FROM customer)
       SELECT c_custkey, len(list_filter(d[2:-2], lambda x: c_acctbal > x)) AS quartile FROM customer, e""",
)
def segment_labels(spark, sf):
    customers = table(spark, sf, "customer")
    edges = A.quartile_edges(customers, ["c_acctbal"])
    inner = F.array(*[F.lit(e) for e in edges["c_acctbal"]])
    return customers.select("c_custkey", D.bin_of(F.col("c_acctbal"), inner).cast("bigint").alias("quartile"))


@query(
    "welch_t", "STA-01 FLT-03",
    """WITH s AS (SELECT count(*) FILTER (f = 'A')::DOUBLE AS n, count(*) FILTER (f = 'R')::DOUBLE AS m, avg(x) FILTER (f = 'A') AS a, avg(x) FILTER (f = 'R') AS b,
                         var_samp(x) FILTER (f = 'A') AS va, var_samp(x) FILTER (f = 'R') AS vb FROM (SELECT l_returnflag AS f, l_extendedprice AS x FROM lineitem)),
            t AS (SELECT *, (a - b) / sqrt(va / n + vb / m) AS t, pow(va / n + vb / m, 2) / (pow(va / n, 2) / (n - 1) + pow(vb / m, 2) / (m - 1)) AS df FROM s),
            area AS (SELECT sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(df + 1) / 2 * ln(1 + pow(abs(t) * i / 4000, 2) / df)))
                            * abs(any_value(t)) / 12000 * exp(lgamma((any_value(df) + 1) / 2) - lgamma(any_value(df) / 2)) / sqrt(pi() * any_value(df)) AS p
                     FROM t, range(4001) r(i))
       SELECT CAST(n AS BIGINT) AS n_first, CAST(m AS BIGINT) AS n_second, round(a, 4) AS mean_first, round(b, 4) AS mean_second, round(t, 6) AS statistic,
              round(df, 3) AS df, round(1 - 2 * p, 6) AS pvalue FROM t, area""",
)
def welch_t(spark, sf):
    flag = F.col("l_returnflag")
    out = T.welch_t(table(spark, sf, "lineitem"), "l_extendedprice", flag == "A", flag == "R")
    digits = {"mean_first": 4, "mean_second": 4, "statistic": 6, "df": 3, "pvalue": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "ks_by_nation", "STA-03",
    """WITH RECURSIVE v AS (SELECT c_nationkey AS k, c_acctbal AS x, count(*) FILTER (right(c_name, 1) < '5') AS a, count(*) FILTER (right(c_name, 1) >= '5') AS b
                            FROM customer GROUP BY ALL),
            r AS (SELECT k, sum(a) OVER w AS ra, sum(b) OVER w AS rb, sum(a) OVER (PARTITION BY k) AS n, sum(b) OVER (PARTITION BY k) AS m
                  FROM v WINDOW w AS (PARTITION BY k ORDER BY x)),
            d AS (SELECT k, n::BIGINT AS n, m::BIGINT AS m, max(abs(ra::DOUBLE / nullif(n, 0) - rb::DOUBLE / nullif(m, 0))) AS d FROM r GROUP BY ALL),
            lim AS (SELECT *, round(d * n * m)::BIGINT AS lim FROM d WHERE n > 0 AND m > 0),
            dp AS (SELECT k, n, m, lim, 0::BIGINT AS s, list_transform(range(n + 1), lambda i: CASE WHEN i = 0 AND lim > 0 THEN 1.0::DOUBLE ELSE 0.0 END) AS row FROM lim
                   UNION ALL SELECT k, n, m, lim, s + 1, list_transform(range(n + 1), lambda i: CASE WHEN s + 1 - i BETWEEN 0 AND m AND abs(i * m - (s + 1 - i) * n) < lim
                                    THEN coalesce(row[i], 0.0) + row[i + 1] ELSE 0.0 END) FROM dp WHERE s < n + m),
            p AS (SELECT dp.k, 1 - row[n + 1] / list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(1, n + 1), lambda i: (m + i) / i::DOUBLE)), lambda x, y: x * y) AS p
                  FROM dp WHERE s = n + m)
       SELECT d.k AS c_nationkey, n AS n_first, m AS n_second, round(d, 10) AS statistic,
              round(CASE WHEN n = 0 OR m = 0 THEN NULL WHEN n * m <= 40000 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p)) WHEN d * d * n * m / (n + m) < 0.02 THEN 1.0::DOUBLE
                    ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, (SELECT sum(CASE WHEN j % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * j * j * (d * d * n * m / (n + m)))) FROM range(1, 101) t(j)))) END, 8) AS pvalue
       FROM d LEFT JOIN p USING (k)""",
)
def ks_by_nation(spark, sf):
    """Balances of two groups of customers within each nation: samples small enough for the exact p-value."""
    low = F.right("c_name", F.lit(1)) < "5"
    out = T.ks_by_group(table(spark, sf, "customer"), ["c_nationkey"], "c_acctbal", low, ~low)
    return out.withColumns({"statistic": F.round("statistic", 10), "pvalue": F.round("pvalue", 8)})


@query(
    "chi_square", "STA-02 AGG-07",
    """WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*)::DOUBLE AS n FROM orders GROUP BY ALL),
            m AS (SELECT *, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e FROM c),
            s AS (SELECT sum(pow(n - e, 2) / e) AS x, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM m)
       SELECT round(x, 6) AS statistic, dof, round(exp(-x / 2) * (1 + x / 2 + pow(x / 2, 2) / 2 + pow(x / 2, 3) / 6), 6) AS pvalue FROM s""",
)
def chi_square(spark, sf):
    counts_ = cross_tab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    out = T.chi_square(counts_, "o_orderstatus", "o_orderpriority")
    return out.withColumns({"statistic": F.round("statistic", 6), "pvalue": F.round("pvalue", 6)})


@query(
    "stratified_split", "SMP-01",
    """WITH h AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:' || o_orderkey), o_orderkey) AS i,
                         count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
       SELECT o_orderkey, o_orderstatus, i <= round_even(n * 0.3::DOUBLE, 0) AS chosen FROM h""",
)
def stratified_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.stratified_split(orders, ["o_orderstatus"], "o_orderkey", 0.3, 42)


@query(
    "random_subset", "SMP-03",
    """WITH h AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY md5('7:' || c_custkey), c_custkey) AS i, count(*) OVER () AS n FROM customer)
       SELECT c_custkey, CASE WHEN i <= floor(n * 0.08::DOUBLE) THEN 'Mobile wallet' ELSE c_mktsegment END AS c_mktsegment FROM h""",
)
def random_subset(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return S.set_on_subset(customers, "c_custkey", 0.08, 7, "c_mktsegment", F.lit("Mobile wallet"))


@query(
    "weighted_resample", "SMP-02 PRJ-09",
    """WITH r AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 6.0::DOUBLE ELSE 1.0 END AS w FROM orders),
            axis AS (SELECT *, sum(w) OVER (ORDER BY o_orderkey) - w AS low FROM r),
            draws AS (SELECT i, ('0x' || substr(md5('43:' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE * (SELECT sum(w) FROM r) AS u
                      FROM range((SELECT count(*) FROM r)) t(i))
       SELECT i AS draw, o_orderkey, o_orderstatus, 'CUR-' || lpad(CAST(i AS VARCHAR), 5, '0') AS new_id FROM draws ASOF JOIN axis ON u >= low""",
)
def weighted_resample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    weight = F.when(F.col("o_orderstatus") == "F", 6.0).otherwise(1.0)
    return S.weighted_resample(orders, "o_orderkey", weight, 43, new_id="new_id")


@query(
    "poisson_resample", "SMP-02",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey = 1 THEN 5000.0::DOUBLE WHEN o_orderstatus = 'F' THEN 6.0 ELSE 1.0 END AS w FROM orders),
            m AS (SELECT o_orderkey, o_orderstatus, w * ((SELECT count(*) FROM r)::DOUBLE / (SELECT sum(w) FROM r)) AS mean,
                         greatest(ceil(w * ((SELECT count(*) FROM r)::DOUBLE / (SELECT sum(w) FROM r)) / 8.0::DOUBLE), 1)::BIGINT AS parts FROM r),
            p AS (SELECT o_orderkey, o_orderstatus, part, mean / parts AS lam,
                         ('0x' || substr(md5('44:' || o_orderkey || ':' || part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
                  FROM (SELECT *, unnest(range(parts)) AS part FROM m)),
            c AS (SELECT o_orderkey, o_orderstatus, part, k, u, sum(exp(-lam + k * ln(lam) - lgamma(k + 1))) OVER (PARTITION BY o_orderkey, part ORDER BY k) AS upto
                  FROM p, range({S.POISSON_TOP}) AS t(k)),
            t AS (SELECT o_orderkey, o_orderstatus, part, count(*) FILTER (u >= upto) AS times FROM c GROUP BY ALL)
        SELECT o_orderkey, o_orderstatus, part * {S.POISSON_TOP} + i AS copy FROM (SELECT *, unnest(range(times)) AS i FROM t)""",
)
def poisson_resample(spark, sf):
    """One order weighs as much as thousands."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    weight = F.when(F.col("o_orderkey") == 1, 5000.0).when(F.col("o_orderstatus") == "F", 6.0).otherwise(1.0)
    return S.poisson_resample(orders, "o_orderkey", weight, 44, chunk_draws=400)


@query(
    "distinct_of_spans", "AGG-09",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_exact, TRUE AS within FROM events
       WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY event_type""",
)
def distinct_of_spans(spark, sf):
    """Users of two weeks from daily sketches, held against the exact number: within four standard errors."""
    events = table(spark, sf, "events")
    folder = f"{own_folder(spark)}/sketches-{uuid.uuid4().hex}"
    K.store(K.summaries(events, F.to_date("ts"), ["event_type"], distinct="user_id"), folder)
    span = spark.read.parquet(folder).filter("period >= '2024-01-08' AND period < '2024-01-22'")
    found = K.estimates(K.merged(span, ["event_type"]))
    rows = events.filter("ts >= '2024-01-08' AND ts < '2024-01-22'")
    exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 4 * K.distinct_error() * F.col("n_exact") + 0.5
    return found.join(exact, "event_type").select("event_type", "n", "n_exact", off.alias("within"))


@query(
    "quantiles_of_spans", "AGG-19",
    """SELECT l_returnflag, p, count(*) AS n, TRUE AS within FROM lineitem, (VALUES (0.01::DOUBLE), (0.25), (0.5), (0.75), (0.99)) AS t(p)
       WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' GROUP BY ALL""",
)
def quantiles_of_spans(spark, sf):
    """Prices of three years from monthly sketches: the true rank of each estimate is off by the stated error at most."""
    lines = table(spark, sf, "lineitem")
    asked = (0.01, 0.25, 0.5, 0.75, 0.99)
    folder = f"{own_folder(spark)}/sketches-{uuid.uuid4().hex}"
    K.store(K.summaries(lines, F.date_format("l_shipdate", "yyyy-MM"), ["l_returnflag"], value="l_extendedprice"), folder)
    span = spark.read.schema("l_returnflag string, n bigint, value_sketch binary, period string").parquet(folder)
    span = span.filter("period >= '1996-01' AND period < '1999-01'")
    found = stage(K.estimates(K.merged(span, ["l_returnflag"]), asked), "estimates")
    pairs = found.select("l_returnflag", F.explode(F.arrays_zip(F.array(*map(F.lit, asked)).alias("p"), F.col("q").alias("q"))).alias("e"))
    pairs = pairs.select("l_returnflag", F.col("e.p").alias("p"), F.col("e.q").alias("q"))  # five rows per flag
    rows = lines.filter("l_shipdate >= '1996-01-01' AND l_shipdate < '1999-01-01'").select("l_returnflag", "l_extendedprice")
    ranks = rows.join(F.broadcast(pairs), "l_returnflag").groupBy("l_returnflag", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_extendedprice") < F.col("q")).alias("below"),
        F.count_if(F.col("l_extendedprice") <= F.col("q")).alias("upto"),
    )
    near = (F.col("below") <= (F.col("p") + K.rank_error()) * F.col("n") + 1) & (F.col("upto") >= (F.col("p") - K.rank_error()) * F.col("n") - 1)
    return ranks.select("l_returnflag", "p", "n", near.alias("within"))


def scored_documents(spark, sf):
    """Labelled documents with a score from their length, in two periods by source."""
    labels, documents = table(spark, sf, "labels"), table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "quality",
        (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("risk"),
        F.when(F.col("lang") == "en", "reference").otherwise("current").alias("period"),
    )


SCORED_SQL = """
scored AS (SELECT doc_id, quality, n_chars / (n_chars + 1000.0::DOUBLE) AS risk, CASE WHEN lang = 'en' THEN 'reference' ELSE 'current' END AS period
           FROM labels JOIN documents USING (doc_id)),
ranked AS (SELECT *, (rank() OVER (PARTITION BY period ORDER BY risk) + (count(*) OVER (PARTITION BY period, risk) - 1) / 2.0::DOUBLE) AS r FROM scored),
area AS (SELECT period, (sum(r) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE)
                        / (count(*) FILTER (quality = 1)::DOUBLE * count(*) FILTER (quality = 0)) AS auc FROM ranked GROUP BY period)"""


@query("auc_rank", "ML-04", f"WITH {SCORED_SQL} SELECT period, round(auc, 8) AS roc_auc FROM area")
def auc_rank(spark, sf):
    return M.auc(scored_documents(spark, sf), "quality", "risk", ["period"]).withColumn("roc_auc", F.round("roc_auc", 8))


METRICS_SQL = f"""{SCORED_SQL},
metrics AS (SELECT period, count(*) AS rows, avg(quality) AS churn_rate, avg(risk) AS average_risk, avg((risk >= 0.5)::INT) AS high_risk_rate,
                   avg(((risk >= 0.5) = (quality = 1))::INT) AS accuracy,
                   coalesce(count(*) FILTER (risk >= 0.5 AND quality = 1)::DOUBLE / nullif(count(*) FILTER (risk >= 0.5), 0), 0) AS precision,
                   coalesce(count(*) FILTER (risk >= 0.5 AND quality = 1)::DOUBLE / nullif(count(*) FILTER (quality = 1), 0), 0) AS recall,
                   any_value(auc) AS roc_auc FROM scored JOIN area USING (period) GROUP BY period)"""


@query(
    "period_metrics", "ML-06",
    f"""WITH {METRICS_SQL} SELECT period, rows, {", ".join(f"round({c}, 8) AS {c}" for c in ("churn_rate", "average_risk", "high_risk_rate", "accuracy", "precision", "recall", "roc_auc"))} FROM metrics""",
)
def period_metrics(spark, sf):
    m = M.period_metrics(stage(scored_documents(spark, sf), "scored"), "quality", "risk", 0.5, ["period"])
    return m.select("period", "rows", *[F.round(c, 8).alias(c) for c in m.columns if c not in ("period", "rows")])


@query(
    "metric_change", "ML-07",
    f"WITH {METRICS_SQL} " + " UNION ALL ".join(
        f"""SELECT '{k}' AS metric, round(max({k}) FILTER (period = 'reference'), 8) AS reference, round(max({k}) FILTER (period = 'current'), 8) AS current,
                   round(max({k}) FILTER (period = 'current') - max({k}) FILTER (period = 'reference'), 8) AS change FROM metrics"""
        for k in M.CHANGE_KEYS
    ),
)
def metric_change(spark, sf):
    m = M.period_metrics(stage(scored_documents(spark, sf), "scored"), "quality", "risk", 0.5, ["period"])
    return M.metric_change(m).select("metric", *[F.round(c, 8).alias(c) for c in ("reference", "current", "change")])


@query(
    "confusion", "ML-05",
    f"""WITH {SCORED_SQL} SELECT a AS actual, p AS predicted, count(doc_id) AS n
        FROM (SELECT * FROM range(2) x(a), range(2) y(p)) LEFT JOIN scored ON quality = a AND (risk >= 0.5)::INT = p GROUP BY ALL""",
)
def confusion(spark, sf):
    scored = scored_documents(spark, sf).withColumn("called", (F.col("risk") >= 0.5).cast("int"))
    return M.confusion(scored, "quality", "called").select(
        F.col("actual").cast("bigint").alias("actual"), F.col("predicted").cast("bigint").alias("predicted"), "n"
    )


@query(
    "classification_report", "ML-05",
    f"""WITH {SCORED_SQL}, k AS (SELECT unnest([0, 1]) AS c),
        s AS (SELECT c, count(*) FILTER (quality = c AND (risk >= 0.5)::INT = c)::DOUBLE AS hit, count(*) FILTER ((risk >= 0.5)::INT = c) AS called,
                     count(*) FILTER (quality = c) AS support FROM k, scored GROUP BY c),
        p AS (SELECT c, coalesce(hit / nullif(called, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall, support, hit FROM s),
        f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p)
        SELECT CAST(c AS VARCHAR) AS class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f
        UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8),
                         round(sum(f1 * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(spark, sf):
    scored = scored_documents(spark, sf).withColumn("called", (F.col("risk") >= 0.5).cast("int"))
    r = M.classification_report(scored, "quality", "called")
    return r.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    "standardized", "ML-01 ML-02",
    """WITH f AS (SELECT c_custkey, c_mktsegment, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, (SELECT median(c_acctbal) FROM customer WHERE c_acctbal > 0)) AS b FROM customer)
       SELECT c_custkey, round((b - (SELECT avg(b) FROM f)) / (SELECT stddev_pop(b) FROM f), 6) AS balance,
              (c_mktsegment = 'BUILDING')::INT AS "c_mktsegment_BUILDING", (c_mktsegment = 'MACHINERY')::INT AS "c_mktsegment_MACHINERY" FROM f""",
)
def standardized(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    scaled = M.standardize(customers, ["balance"]).withColumn("balance", F.round("balance", 6))
    return M.one_hot(scaled, "c_mktsegment", ["BUILDING", "MACHINERY"]).drop("c_mktsegment")


@query(
    "balanced_weights", "ML-03",
    """SELECT doc_id, round(count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY quality)), 8) AS weight FROM labels""",
)
def balanced_weights(spark, sf):
    return M.balanced_weights(table(spark, sf, "labels").select("doc_id", "quality"), "quality").select("doc_id", F.round("weight", 8).alias("weight"))


ORDER_MODEL = MonitorConfig(
    numeric=("o_totalprice", "month"), categorical=("o_orderpriority", "weekday"), first_target="o_totalprice"
)


@query("model_monitor", "ML-01 ML-02 ML-03 ML-07 ML-08 ML-09 SMP-01")
def model_monitor(spark, sf):
    """Is an order finished? Trained on the earlier orders, compared with the later ones."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), "o_orderpriority", F.date_format("o_orderdate", "E").alias("weekday"),
        (F.col("o_orderstatus") == "F").cast("int").alias("churn"), "o_orderdate",
    )
    now = F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp_ntz")
    reference, current = orders.filter(~now).drop("o_orderdate"), orders.filter(now).drop("o_orderdate")
    _, change, _ = M.monitor(reference, current, "o_orderkey", ORDER_MODEL, trees=120, depth=10)
    return change


@query(
    "model_reload", "SNK-05 ML-03 ML-09",
    "SELECT 0 AS only_first, 0 AS only_second, 0 AS cells_off, count(*) AS rows, true AS equal FROM orders",
)
def model_reload(spark, sf):
    """A saved and reloaded model predicts the same for every order."""
    from ..operators.compare import predictions_equal
    from ..operators.scale import own_folder

    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), "o_orderpriority", F.date_format("o_orderdate", "E").alias("weekday"),
        (F.col("o_orderstatus") == "F").cast("int").alias("churn"),
    )
    model = M.train(orders, ORDER_MODEL, trees=120, depth=10)
    again = M.save(model, f"{own_folder(spark)}/order-model")
    first, second = M.score(model, orders, ORDER_MODEL), M.score(again, orders, ORDER_MODEL)
    return predictions_equal(first, second, "o_orderkey", "risk_score")
