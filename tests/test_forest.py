"""The forest of a large table: grown from counts of equal rows, passed once by rows that no tree tells apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from test_stream_model import CONFIG, people
from tidegauge.config import MonitorConfig
from tidegauge.operators import model as M
from tidegauge.operators import scale
from tidegauge.operators.compare import predictions_equal
from tidegauge.operators.sample import poisson_counts


@pytest.fixture
def staged(monkeypatch):
    """What the model operators write, by tag."""
    kept = {}
    keep = lambda write: lambda df, tag: kept.setdefault(tag, write(df, tag))
    monkeypatch.setattr(M, "stage", keep(scale.stage))
    monkeypatch.setattr(M, "stage_counted", keep(scale.stage_counted))
    return kept


def odd_people(spark, n=6000):
    """Gaps, NaN, numbers never seen in training and between its values, unknown and null categories."""
    i = F.col("id")
    x = F.when(i % 11 == 0, F.lit(float("nan"))).when(i % 7 == 0, i % 40 + 0.5).when(i % 501 == 0, 1e9).otherwise(F.col("x"))
    c = F.when(i % 97 == 0, "never seen").when(i % 89 == 0, F.lit(None)).otherwise(F.col("c"))
    return people(spark, n).withColumns({"x": x, "c": c})


@pytest.mark.parametrize("few_rows", [None, 0])
def test_kinds_score_as_rows_do(spark, staged, few_rows):
    model = M.train(people(spark, 4000), CONFIG, trees=8, depth=5, leaf=3, few_rows=few_rows)
    odd = odd_people(spark)
    by_row = M.score(model, odd, CONFIG)
    assert "kind-risks" not in staged
    by_kind = M.score(model, odd, CONFIG, few_rows=0)
    assert staged["kind-risks"].count() == staged["kinds"][1] < 1500
    assert by_kind.schema.names == by_row.schema.names and by_kind.dtypes == by_row.dtypes
    as_row = lambda df: {r.id: (r.risk_score, r.high_risk) for r in df.collect()}
    assert as_row(by_kind) == as_row(by_row) and by_kind.count() == 6000  # equal to the last bit
    # numbers exactly at a cut
    cut = M._cuts(model.stages[-1], 2)[0]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(cut)], "id int, v double")
    place = {r.id: r.p for r in frame.select("id", M._between(F.col("v"), cut, range(len(cut) + 1)).alias("p")).collect()}
    assert cut and place == {i: i for i in range(len(cut))}


def test_forest_grows_on_counts_not_rows(spark, staged):
    """Ten times the rows are ten times the counts, on as many instances."""
    given = []
    for times in (1, 10):
        df = people(spark, 3000).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(times))))
        model = M.train(df, CONFIG, trees=6, depth=4, leaf=3, few_rows=0)
        counted, kinds = staged.pop("equal-rows")
        assert counted.agg(F.sum("n")).first()[0] == 3000 * times  # no row is left out
        given.append((kinds, staged.pop("draws").count()))
        staged.clear()
        assert model.stages[-1].getNumTrees == 6 == len(model.stages[-1].trees)
    assert given[0] == given[1] and given[0][1] < 1000


def test_forest_of_counts_is_the_forest_of_rows(spark, staged, tmp_path):
    """Risks of both forests agree but for their random draws; the one of counts survives saving."""
    noisy = people(spark, 8000).withColumns({
        "x": F.when(F.col("id") % 10 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 100.0),
        "z": F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).cast("double"),
    }).withColumn("churn", (F.coalesce("x", F.lit(50.0)) + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(60)) > 85).cast("int"))
    rows = M.train(noisy, CONFIG, trees=40, depth=6, leaf=2)
    assert "draws" not in staged
    staged.clear()
    counts = M.train(noisy, CONFIG, trees=40, depth=6, leaf=2, few_rows=0)
    assert "draws" in staged
    a, b = (M.score(m, noisy, CONFIG) for m in (rows, counts))
    gap = a.join(b.select("id", F.col("risk_score").alias("other")), "id").agg(
        F.avg(F.abs(F.col("risk_score") - F.col("other"))).alias("gap"), F.avg("risk_score").alias("a"), F.avg("other").alias("b")
    ).first()
    assert gap.gap < 0.03 and gap.a == pytest.approx(gap.b, abs=0.01)
    assert M.auc(b, "churn", "risk_score").first()[0] == pytest.approx(M.auc(a, "churn", "risk_score").first()[0], abs=0.01)
    again = M.save(counts, f"{tmp_path}/model")
    assert again.stages[-1].getNumTrees == 40 and again.stages[-1].getMaxDepth() == 6
    found = predictions_equal(M.score(counts, noisy, CONFIG, few_rows=0), M.score(again, noisy, CONFIG, few_rows=0), "id", "risk_score")
    assert found.first().equal and found.first().rows == 8000


@pytest.mark.parametrize("leaf,nodes", [(5, 3), (100, 1)])
def test_leaf_size_counts_rows(spark, leaf, nodes):
    """30 equal rows may be a leaf of 5 rows, not one of 100, however few instances they are."""
    config = MonitorConfig(numeric=("x",), categorical=("k",), first_target="x")
    df = spark.range(5000).selectExpr("cast(id < 30 as double) AS x", "'k' AS k", "cast(id < 30 or id % 2 = 0 as int) AS churn")
    model = M.train(df, config, trees=3, depth=4, leaf=leaf, few_rows=0)
    assert [t.numNodes for t in model.stages[-1].trees] == [nodes] * 3


def test_many_kinds_take_the_way_of_rows(spark, staged):
    """Where hardly any rows are equal, counts save nothing: the forest takes the rows themselves."""
    df = people(spark, 300)
    model = M.train(df, CONFIG, trees=2, depth=3, leaf=3, few_rows=0)
    assert "draws" not in staged and model.stages[-1].getNumTrees == 2
    few = M.score(model, df.limit(3), CONFIG, few_rows=0)
    assert few.count() == 3 and "kind-risks" not in staged


def test_levels(spark):
    df = spark.range(1000).selectExpr("id % 32 AS a", "cast(id as double) AS b", "5.0D AS c", "if(id < 999, 0.0D, 1.0D) AS d")
    levels = M._levels(df, ["a", "b", "c", "d"])
    assert levels["a"] == list(range(32)) and levels["c"] == [5.0] and levels["d"] == [0.0, 1.0]  # rare values too
    assert len(levels["b"]) == M.BINS and all(abs(v - (i + 0.5) * 1000 / 32) < 3 for i, v in enumerate(levels["b"]))


def test_poisson_counts(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 400), (4, 10**9)], "k bigint, n bigint")
    draw = lambda seed, parts: {r.k: r.d for r in df.repartition(parts).select("k", poisson_counts(F.col("n"), F.col("k"), seed, 3000).alias("d")).collect()}
    first = draw(42, 1)
    assert first == draw(42, 3) and first != draw(43, 1) and first[1] != first[2]
    for k, n in ((1, 1), (3, 400), (4, 10**9)):
        mean = sum(first[k]) / 3000
        spread = sum((x - mean) ** 2 for x in first[k]) / 3000
        assert mean == pytest.approx(n, abs=5 * (n / 3000) ** 0.5) and spread == pytest.approx(n, rel=0.15)
