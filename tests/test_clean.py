from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.config import CANONICAL_FIELDS, NUMERIC_FEATURES
from tidegauge.operators import clean as C
from tidegauge.operators.aggregate import category_summary, kpi, pivot_sum, sales_report
from tidegauge.operators.profile import quality_snapshot
from tidegauge.plans.cleaning_queries import clean_customers
from tidegauge.sources.gates import require_binary_target

SALES = "order_id string, order_date string, region string, category string, quantity string, unit_price string, discount string"


def sales(spark, **first):
    rows = [
        ["A", "2025-01-01", "Seoul", "Food", "1", "1000", "0"],
        ["B", "2025-01-02", "Seoul", "Food", "2", None, ".1"],
        ["C", "2025-01-03", None, "Home", None, "2000", None],
        ["D", "2025-01-04", "Busan", "Home", "100", "3000", ".2"],
    ]
    names = [f.split()[0] for f in SALES.split(", ")]
    for k, v in first.items():
        rows[0][names.index(k)] = v
    return spark.createDataFrame(rows, SALES)


@pytest.mark.parametrize("limits", [{}, {"one_task_rows": 1, "slice_rows": 2}])
def test_recipe_a(spark, limits):
    clean, bounds = C.clean_sales(sales(spark), **limits)
    rows = {r.order_id: r for r in clean.collect()}
    assert len(rows) == 4 and not any(v is None for r in rows.values() for v in r)
    assert rows["B"].unit_price == 1000 and rows["C"].region == "Unknown" and rows["C"].quantity == 2
    assert rows["D"].quantity == pytest.approx(bounds["quantity_bounds"][1])
    assert dict(clean.dtypes)["order_date"] == "timestamp"


def test_recipe_a_bad_first_row(spark):
    clean, _ = C.clean_sales(sales(spark, order_date="invalid", category=None, unit_price=None))
    row = clean.filter("order_id = 'A'").first()
    assert row.category == "Unknown" and row.order_date.day == 3 and row.unit_price == 2500


def test_recipe_a_gates(spark):
    with pytest.raises(ValueError, match="category, discount"):
        C.clean_sales(spark.createDataFrame([("A",)], "order_id string"))
    with pytest.raises(ValueError, match="no data"):
        C.clean_sales(sales(spark).filter("false"))
    with pytest.raises(ValueError, match="order date"):
        C.clean_sales(sales(spark).withColumn("order_date", F.lit("never")))
    with pytest.raises(ValueError, match="price"):
        C.clean_sales(sales(spark).withColumn("unit_price", F.lit("-1")))


def test_recipes_do_not_run_their_input_for_a_look(spark, monkeypatch):
    """A look at the first row of a joined input is the whole join once it is shuffled."""
    raw, people = sales(spark), customers(spark)
    monkeypatch.setattr(type(raw), "isEmpty", lambda self: pytest.fail("the input was run to look at one row"))
    assert C.clean_sales(raw)[0].count() == C.report_sales(raw).count() == 4
    assert clean_customers(people).count() == 400
    for recipe in (C.clean_sales, C.report_sales):
        with pytest.raises(ValueError, match="no data"):
            recipe(raw.filter("false"))
    with pytest.raises(ValueError, match="no data"):
        clean_customers(people.filter("false"))


def test_recipe_a_takes_typed_columns(spark):
    """Numbers that are numbers already, and text that sorts by another collation."""
    want = sorted(tuple(r) for r in C.clean_sales(sales(spark))[0].collect())
    for kind in ("double", "string collate unicode_ci"):
        raw = sales(spark).withColumns({c: F.col(c).cast(kind) for c in ("quantity", "unit_price", "discount")})
        assert sorted(tuple(r) for r in C.clean_sales(raw)[0].collect()) == want


def test_post_fill_median_is_not_the_raw_one(spark):
    rows = [("a", "1"), ("a", None), ("a", None), ("b", "10"), ("b", None), ("c", None)]
    raw = spark.createDataFrame(rows, "category string, unit_price string").select(
        F.lit("x").alias("order_id"), "category", F.lit("r").alias("region"), "unit_price", F.lit("1").alias("quantity"), F.lit("0").alias("discount")
    )
    assert C.report_sales(raw).filter("category = 'c'").first().unit_price == 1.0


def test_winsorize(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,)], "v double")
    b = C.winsorize_bounds(df, ["v"]).first()
    assert (b.q1, b.q3, b.lower, b.upper) == (1.75, 27.25, -36.5, 65.5)
    assert C.winsorize(df, ["v"]).agg(F.max("v")).first()[0] == 65.5


def test_report(spark):
    raw = spark.createDataFrame(
        [("1", "Food", "S", "1000", "2", ".1"), ("2", "Food", "S", None, "1", None), ("3", "Home", "B", "2000", "3", ".2")],
        "order_id string, category string, region string, unit_price string, quantity string, discount string",
    )
    clean = C.report_sales(raw)
    assert [r.amount for r in clean.orderBy("order_id").collect()] == [1800.0, 1000.0, 4800.0]
    k = kpi(clean).first()
    assert (k.orders, k.net_sales, k.regions) == (3, 7600, 2)
    best = [r.label for r in sales_report(clean, 2).filter("section = 'category'").orderBy(F.desc("value")).collect()]
    assert best == ["Home", "Food"]
    with pytest.raises(ValueError):
        sales_report(clean, 0)


def test_mean_order_value_is_a_mean_of_sums(spark):
    df = spark.createDataFrame([(1, "r", 100.0), (1, "r", 100.0), (2, "r", 100.0)], "order_id int, region string, amount double")
    k = kpi(df).first()
    assert (k.orders, k.mean_order_value) == (2, 150)


def test_rows_without_an_order_id_are_no_order(spark):
    df = spark.createDataFrame(
        [(1, "r", "c", 100.0), (1, "r", "c", 100.0), (None, "q", "d", 50.0)], "order_id int, region string, category string, amount double"
    )
    k = kpi(df).first()
    assert (k.orders, k.net_sales, k.mean_order_value) == (1, 250, 200)
    rows = sorted((r.section, r["rank"], r.label, r.value) for r in sales_report(df, 1).collect())
    assert rows == [
        ("category", 1, "c", 200.0), ("kpi", 1, "orders", 1.0), ("kpi", 2, "net_sales", 250.0), ("kpi", 3, "mean_order_value", 200.0),
        ("kpi", 4, "regions", 2.0), ("region", 1, "r", 200.0), ("region", 2, "q", 50.0),
    ]


def test_summary_and_pivot(spark):
    clean, _ = C.clean_sales(sales(spark))
    assert {r.category: r.orders for r in category_summary(clean).collect()} == {"Food": 2, "Home": 2}
    cell = {r.region: r for r in pivot_sum(clean, "region", "category", "amount", ["Food", "Home"]).collect()}
    assert cell["Busan"].Food == 0.0


def test_join_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    assert tuple(C.join_check(df, dim, "k", "v").first()) == (4, 6, 2)


def customers(spark):
    rows = [
        (f"C-{i}", " F " if i % 2 else None, i % 2, str(i), float(i), None if i < 40 else 10.0 * i, "m" if i % 2 else "y", "card", i % 8, "x" if i == 7 else str(i % 2))
        for i in range(400)
    ]
    return spark.createDataFrame(
        rows,
        "customer_id string, gender string, senior int, tenure_months string, monthly_charges double, total_charges double, contract string, payment_method string, num_services int, churn string",
    )


def test_recipe_c_keeps_the_raw_figures(spark):
    raw = customers(spark)
    clean = clean_customers(raw)
    assert clean.filter("total_charges is null").isEmpty() and clean.count() == 400
    assert clean.filter("churn is null").count() == 1
    assert {r.gender for r in clean.select("gender").distinct().collect()} == {"F", "Unknown"}
    snap = quality_snapshot(raw, "customer_id", [*NUMERIC_FEATURES, "churn"]).first()
    assert (snap.rows, snap.duplicate_ids, snap.missing_cells, snap.numeric_coercions) == (400, 0, 240, 1)
    with pytest.raises(ValueError, match="churn"):
        clean_customers(raw.drop("churn"))
    assert set(CANONICAL_FIELDS) == set(raw.columns)


def test_target_gate(spark):
    good = spark.createDataFrame([("A", 0), ("B", 1)], "id string, churn int")
    assert require_binary_target(good, "id", "churn") is good
    for rows in ([("A", 0), ("A", 1)], [("A", 0), ("B", None)], [("A", 0), ("B", 0)], [("A", 0), ("B", 2)]):
        with pytest.raises(ValueError):
            require_binary_target(spark.createDataFrame(rows, "id string, churn int"), "id", "churn")
