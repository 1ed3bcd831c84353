"""Risk model and its monitoring between periods (ML-01..09, SNK-05)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MonitorConfig
from .attribution import explain_shift
from .drift import CURRENT, REFERENCE
from .quantiles import quantiles_of_counts, stacked_values
from .sample import poisson_counts, stratified_split
from .scale import SLICE_ROWS, lookup, running_totals, spread, stage, stage_counted

# Rows up to which each row by itself grows the forest and passes it; beyond, equal rows are counted and do so once.
FOREST_ROWS = 500_000
# Values that stand for a number in a forest: Spark's cut a number at no more than BINS - 1 places (`maxBins`).
BINS = 32
# Nodes of a forest whose cuts the driver reads.
READ_NODES = 250_000


def standardize(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """Exact median fill and zero-mean, unit-deviation scaling (population deviation) of columns (ML-01)."""
    long = stacked_values(df, {c: F.col(c) for c in columns})
    counts = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    medians = {r["feature"]: r["q"][0] for r in quantiles_of_counts(counts, [0.5], ["feature"], **limits).collect()}
    if empty := [c for c in columns if c not in medians]:
        raise ValueError(f"columns without a value have no median: {', '.join(sorted(empty))}")
    filled = df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(medians[c])) for c in columns})
    moments = filled.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_dev") for c in columns]
        ).alias("m")
    ).scalar()
    return filled.withColumns(
        {c: (F.col(c) - moments[f"{c}_mean"]) / F.when(moments[f"{c}_dev"] == 0, 1.0).otherwise(moments[f"{c}_dev"]) for c in columns}
    )


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """0/1 columns per known category; an unknown or null value is 0 everywhere (ML-02)."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in categories})


def balanced_weights(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """n / (2 * n_class) per row (ML-03); the two class sizes are one scalar."""
    sizes = df.agg(
        F.struct(F.count(target).alias("n"), F.count_if(F.col(target) == 1).alias("ones")).alias("s")
    ).scalar()
    ones = sizes["ones"]
    in_class = F.when(F.col(target) == 1, ones).otherwise(sizes["n"] - ones)
    return df.withColumn(out, sizes["n"] / (in_class * 2))


def risk_pipeline(
    numeric: Sequence[str], categorical: Sequence[str], target: str, *, trees: int = 120, leaf: int = 4, depth: int = 30, seed: int = 42
) -> Pipeline:
    """Median fill, scaling, one-hot and a class-weighted random forest; by default as deep as Spark's forests go."""
    filled = [f"{c}_filled" for c in numeric]
    index = [f"{c}_index" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=list(numeric), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(withMean=True, inputCol="numbers", outputCol="scaled"),
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
            VectorAssembler(inputCols=["scaled", *hot], outputCol="features"),
            RandomForestClassifier(
                labelCol=target, featuresCol="features", weightCol="weight",
                numTrees=trees, minInstancesPerNode=leaf, maxDepth=depth, seed=seed,
            ),
        ]
    )


def _model_frame(df: DataFrame, config: MonitorConfig) -> DataFrame:
    return df.withColumns(
        {c: F.col(c).cast("double") for c in config.numeric} | {c: F.col(c).cast("string") for c in config.categorical}
    )


def train(df: DataFrame, config: MonitorConfig, target: str = "churn", *, few_rows: int | None = None, **forest) -> PipelineModel:
    """Fit the risk pipeline on all rows; above `few_rows` its forest grows on counts of equal rows (`_forest_of_counts`)."""
    used = _model_frame(df, config).select(target, *config.numeric, *config.categorical)
    # every stage of the pipeline reads the rows: written once, with the columns it uses, in files for many tasks
    rows = stage(spread(balanced_weights(used.withColumn(target, F.col(target).cast("double")), target)), "training-rows")
    pipeline = risk_pipeline(config.numeric, config.categorical, target, seed=config.seed, **forest)
    n = rows.count()
    if n <= (FOREST_ROWS if few_rows is None else few_rows):
        return pipeline.fit(rows)
    *steps, classifier = pipeline.getStages()
    prepared = Pipeline(stages=steps).fit(rows)
    counted, n_counted = stage_counted(_equal_rows(prepared.stages[0].transform(rows), config, target), "equal-rows")
    if 2 * n_counted * classifier.getMinInstancesPerNode() > n:  # counts would be no fewer
        return PipelineModel([*prepared.stages, classifier.fit(prepared.transform(rows))])
    return PipelineModel([*prepared.stages, _forest_of_counts(classifier, prepared.transform(counted), n_counted, config)])


def _levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """At most BINS values of each column, in order: all its values, or quantiles if it has more."""
    about = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if about[c] <= 2 * BINS]
    found = df.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {}
    many = [c for c in columns if c not in found or len(found[c]) > BINS]
    if many:
        found |= zip(many, df.approxQuantile(many, [(i + 0.5) / BINS for i in range(BINS)], 0.001))
    return {c: sorted(set(found[c])) for c in columns}


def _between(x: Column, cuts: Sequence[float], values: Sequence) -> Column:
    """The value whose place among the cuts x has; x equal to a cut lies below it, as in a tree."""
    out = F.lit(values[-1])
    if cuts:
        first, *rest = zip(cuts, values)
        chain = F.when(x <= first[0], first[1])
        for cut, value in rest:
            chain = chain.when(x <= cut, value)
        out = chain.otherwise(out)
    return out


def _equal_rows(filled: DataFrame, config: MonitorConfig, target: str) -> DataFrame:
    """How many rows have the same label, weight and categories and numbers nearest to the same level.

    A forest puts its cuts midway between the levels, so rows that are counted together are never on two sides of one.
    """
    levels = {c: v for c, v in zip(config.numeric, _levels(filled, [f"{c}_filled" for c in config.numeric]).values())}
    near = [
        _between(F.col(f"{c}_filled"), [(a + b) / 2 for a, b in zip(v, v[1:])], v).alias(c) for c, v in levels.items()
    ]
    return filled.groupBy(target, "weight", *near, *config.categorical).agg(F.count(F.lit(1)).alias("n"))


def _forest_of_counts(
    classifier: RandomForestClassifier, counted: DataFrame, rows: int, config: MonitorConfig
) -> RandomForestClassificationModel:
    """The forest of all rows, grown from `n` rows of each kind.

    A tree draws every row a Poisson(1) number of times, so n equal rows a Poisson(n) number of times in all. Those enter as up to
    `leaf` instances with the weight of all, so a node holds `leaf` instances exactly if it holds `leaf` drawn rows.
    """
    spark, target = counted.sparkSession, classifier.getLabelCol()
    trees, leaf = classifier.getNumTrees(), classifier.getMinInstancesPerNode()
    classes = int(counted.agg(F.max(target)).first()[0]) + 1
    labels = {"ml_attr": {"type": "nominal", "name": target, "vals": [str(i) for i in range(classes)]}}
    kind = F.xxhash64(target, *config.numeric, *config.categorical)
    tasks = -(-rows * leaf // SLICE_ROWS)
    dealt = counted.withColumn("_kind", kind).repartition(max(tasks, spark.sparkContext.defaultParallelism))
    draws = dealt.withColumn("_draws", poisson_counts(F.col("n"), F.col("_kind"), config.seed, trees)).select(
        F.col(target).alias(target, metadata=labels), "weight", "features", *[F.col("_draws")[i].alias(f"_{i}") for i in range(trees)]
    )
    draws = stage(draws, "draws")  # a tree reads its own column

    def grow(i: int) -> DecisionTreeClassificationModel:
        n = F.col(f"_{i}")
        pieces = F.least(n, F.lit(leaf))
        share = F.explode(F.array_repeat(F.col("weight") * n / pieces, pieces.cast("int"))).alias("weight")
        one = {
            classifier.numTrees: 1, classifier.bootstrap: False, classifier.seed: classifier.getSeed() + i,
            classifier.featureSubsetStrategy: "sqrt" if trees > 1 else "all",
        }
        return classifier.copy(one).fit(draws.filter(n > 0).select(target, "features", share).coalesce(tasks)).trees[0]

    # each call is wrapped by itself: a wrapper holds one copy of the caller's job properties
    calls = [inheritable_thread_target(spark)(partial(grow, i)) for i in range(trees)]
    with ThreadPool(min(trees, spark.sparkContext.defaultParallelism)) as pool:
        grown = pool.map(lambda call: call(), calls)
    jvm = spark.sparkContext._jvm.org.apache.spark.ml.classification
    array = spark.sparkContext._gateway.new_array(jvm.DecisionTreeClassificationModel, trees)
    for i, tree in enumerate(grown):
        array[i] = tree._java_obj
    model = jvm.RandomForestClassificationModel(classifier.uid, array, grown[0].numFeatures, grown[0].numClasses)
    forest = classifier._copyValues(RandomForestClassificationModel(model))
    forest._transfer_params_to_java()
    return forest


def save(model: PipelineModel, path: str) -> PipelineModel:
    """Save and read back (SNK-05)."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(
    model: PipelineModel, df: DataFrame, config: MonitorConfig, out: str = "risk_score", *, few_rows: int | None = None
) -> DataFrame:
    """Class-1 probability and the label at the threshold (ML-09); above `few_rows`, rows no tree tells apart pass the forest once."""
    rows = df.count()
    probability = vector_to_array(F.col("probability"))[1]
    dealt = _model_frame(spread(df, rows=rows), config)
    scored = None
    if rows > (FOREST_ROWS if few_rows is None else few_rows) and model.stages[-1].totalNumNodes <= READ_NODES:
        scored = _scored_by_kind(model, dealt, rows, config, probability)
    if scored is None:
        scored = model.transform(dealt).withColumn("_risk", probability)
    risk = F.col("_risk")
    return scored.select(*df.columns, risk.alias(out), (risk >= config.high_risk_threshold).cast("int").alias("high_risk"))


def _cuts(forest: RandomForestClassificationModel, numbers: int) -> list[list[float]]:
    """Where the trees cut each of the first `numbers` features."""
    cuts = [set() for _ in range(numbers)]
    for feature, cut in re.findall(r"If \(feature (\d+) <= ([^)]+)\)", forest.toDebugString):
        if int(feature) < numbers:
            cuts[int(feature)].add(float(cut))
    return [sorted(c) for c in cuts]


def _scored_by_kind(model: PipelineModel, df: DataFrame, rows: int, config: MonitorConfig, risk: Column) -> DataFrame | None:
    """Rows with `_risk`: those with the same categories and numbers between the same cuts reach the same leaves of every tree.

    None if the rows are of too many kinds for it.
    """
    scaled = PipelineModel(model.stages[:-1]).transform(df).withColumn("_scaled", vector_to_array("scaled"))
    cuts = _cuts(model.stages[-1], len(config.numeric))
    places = [_between(F.col("_scaled")[i], c, range(len(c) + 1)).alias(f"_place{i}") for i, c in enumerate(cuts)]
    placed = stage(scaled.select(*df.columns, *places), "placed")
    kind = [*[f"_place{i}" for i in range(len(cuts))], *config.categorical]
    # any numbers of a kind will do, each by itself: the least needs no sort
    kinds, n = stage_counted(placed.groupBy(*kind).agg(*[F.min(c).alias(c) for c in config.numeric]), "kinds")
    if 2 * n > rows:
        return None
    passed = model.transform(spread(kinds, rows=n)).select(*kind, risk.alias("_risk"))
    return lookup(placed, stage(passed, "kind-risks"), kind, table_rows=n)


def auc(scored: DataFrame, label: str, value: str, keys: Sequence[str] = (), **limits) -> DataFrame:
    """Exact ROC-AUC, ties counted half (ML-04), from counts per distinct score and a distributed running total."""
    counts = scored.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    placed = running_totals(counts, keys, ["value"], ["pos", "neg"], **limits)
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)
    out = placed.groupBy(*keys).agg(
        F.sum(won).alias("_won"), F.max("pos_total").alias("_p"), F.max("neg_total").alias("_q")
    )
    return out.select(*keys, F.try_divide(F.col("_won"), F.col("_p").cast("double") * F.col("_q")).alias("roc_auc"))


def period_metrics(scored: DataFrame, label: str, value: str, threshold: float, keys: Sequence[str] = (), **limits) -> DataFrame:
    """Rows, rates, AUC, accuracy, precision, recall at a threshold (ML-06); one aggregate besides the AUC."""
    y, p = F.col(label) == 1, F.col(value) >= threshold
    tp, called, actual = F.count_if(y & p), F.count_if(p), F.count_if(y)
    base = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(y.cast("double")).alias("churn_rate"),
        F.avg(value).alias("average_risk"),
        F.avg(p.cast("double")).alias("high_risk_rate"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(tp, called), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, actual), F.lit(0.0)).alias("recall"),
    )
    area = auc(scored, label, value, keys, **limits)
    if keys:
        return base.join(area, list(keys))
    return base.withColumn("roc_auc", area.scalar())


# The figures whose change between periods is reported.
CHANGE_KEYS = ("churn_rate", "average_risk", "high_risk_rate", "roc_auc", "recall")


def metric_change(metrics: DataFrame) -> DataFrame:
    """(metric, reference, current, change) for the reported figures (ML-07)."""
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("v")) for k in CHANGE_KEYS])
    long = metrics.select("period", F.explode(pairs).alias("p")).select("period", "p.metric", "p.v")
    side = lambda p: F.max(F.when(F.col("period") == p, F.col("v")))
    return (
        long.groupBy("metric")
        .agg(side(REFERENCE).alias("reference"), side(CURRENT).alias("current"))
        .withColumn("change", F.col("current") - F.col("reference"))
    )


def confusion(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, n), all four cells (ML-05)."""
    cell = lambda a, p: F.count_if((F.col(label) == a) & (F.col(prediction) == p))
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n"))
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    return scored.agg(*[cell(a, p).alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)]).select(F.inline(cells))


def classification_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted means, accuracy (ML-05)."""
    c = {(r["actual"], r["predicted"]): F.col(f"c{r['actual']}{r['predicted']}") for r in ({"actual": a, "predicted": p} for a in (0, 1) for p in (0, 1))}
    cell = lambda a, p: F.count_if((F.col(label) == a) & (F.col(prediction) == p))
    one = scored.agg(*[cell(a, p).alias(f"c{a}{p}") for a, p in c])
    ratio = lambda n, d: F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))
    lines, total = [], c[0, 0] + c[0, 1] + c[1, 0] + c[1, 1]
    per = {}
    for k in (0, 1):
        precision, recall = ratio(c[k, k], c[0, k] + c[1, k]), ratio(c[k, k], c[k, 0] + c[k, 1])
        f1 = ratio(2 * precision * recall, precision + recall)
        per[k] = (precision, recall, f1, c[k, 0] + c[k, 1])
        lines.append((str(k), *per[k]))
    lines.append(("macro avg", *[(per[0][i] + per[1][i]) / 2 for i in range(3)], total))
    weighted = [ratio(per[0][i] * per[0][3] + per[1][i] * per[1][3], total) for i in range(3)]
    lines.append(("weighted avg", *weighted, total))
    right = ratio(c[0, 0] + c[1, 1], total)
    lines.append(("accuracy", right, right, right, total))
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.cast("bigint").alias("support")
            )
            for name, p, r, f, s in lines
        ]
    )
    return one.select(F.inline(table))


def monitor(
    reference: DataFrame, current: DataFrame, key: str, config: MonitorConfig = MonitorConfig(), target: str = "churn", **forest
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train on 70 % of the reference, compare the other 30 % with the current period (ML-07, ML-08).

    Returns (metrics per period, metric changes, causes of the risk shift).
    """
    split = stratified_split(reference, [target], key, 0.7, config.seed, "_train")
    model = train(split.filter("_train").drop("_train"), config, target, **forest)
    held_out = split.filter(~F.col("_train")).drop("_train")
    both = (
        score(model, held_out, config).withColumn("period", F.lit(REFERENCE))
        .unionByName(score(model, current, config).withColumn("period", F.lit(CURRENT)))
    )
    both = stage(both, "scored")
    metrics = period_metrics(both, target, "risk_score", config.high_risk_threshold, ["period"])
    return metrics, metric_change(metrics), risk_causes(both, config)


def risk_causes(scored: DataFrame, config: MonitorConfig = MonitorConfig(), **limits) -> DataFrame:
    """Causes of the shift of the mean risk between the periods of scored rows, over all features (ML-08)."""
    return explain_shift(scored, "risk_score", config, [*config.categorical, *config.numeric], **limits)
