"""Training and comparing recovery models with MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.clean import impute_numeric, numeric_columns
from arrearium.operators.evaluate import score_report
from arrearium.operators.features import checked_labels, feature_matrix, feature_names
from arrearium.operators.stats import hash_folds
from arrearium.operators.trees import can_grow, grow
from arrearium.session import shared_dir, side_by_side

CLASSIFIERS = ("logistic", "random_forest", "gbt_depth4", "gbt_depth5")

# Tables of fewer rows stay in the partitions they come in; a partition of a larger one takes MOST_ROWS at most.
LEAST_BALANCED = 100_000
MOST_ROWS = 2_000_000


def modelling_table(master: DataFrame, key: str = "loan_id") -> DataFrame:
    """Delinquent accounts with the model inputs and the two-state label; only those columns."""
    late = master.where(F.col("overdue_days") > 30)
    return late.select(key, *fv.MODEL_NUMERIC, *fv.MODEL_CATEGORICAL, X.recovery_label("recovery_status").alias("label"))


def class_sizes(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """Rows of class 0 and 1; a table with one class only cannot train a classifier."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    if not row["neg"] or not row["pos"]:
        raise ValueError(f"column {label!r} holds one class only: {row['neg']} x 0, {row['pos']} x 1")
    return row["neg"], row["pos"]


def balanced(df: DataFrame, rows: int) -> DataFrame:
    """The rows dealt evenly, to as many partitions as there are slots or, by MOST_ROWS, a multiple of that.

    Trees are trained in a thousand passes. Each waits for its largest partition and pays for every task, while file splits are uneven and
    grow in number with the width of the table they are read from.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if rows < LEAST_BALANCED else df.repartition(slots * -(-rows // (slots * MOST_ROWS)))


def classifier(name: str, neg: int, pos: int, label: str = "label", seed: int = 42) -> Estimator:
    """An unfitted classifier. Balanced weights sum to the row count, so C = 1 is regParam = 1/rows.

    The forest keeps each row's node in each tree: with so many deep trees, finding it again from the root takes more than the counting.
    """
    common = {"labelCol": label, "featuresCol": "features", "weightCol": "weight"}
    if name == "logistic":
        return LogisticRegression(maxIter=1000, regParam=1.0 / (neg + pos), standardization=False, **common)
    if name == "random_forest":
        return RandomForestClassifier(numTrees=200, maxDepth=8, seed=seed, cacheNodeIds=True, **common)
    if name in ("gbt_depth4", "gbt_depth5"):
        return GBTClassifier(maxIter=200, maxDepth=int(name[-1]), stepSize=0.05, seed=seed, **common)
    raise ValueError(f"unknown classifier {name!r}")


def row_weights(df: DataFrame, name: str, neg: int, pos: int, label: str = "label") -> DataFrame:
    """Balanced weights; the depth-4 booster instead weighs positives by negatives/positives."""
    if name == "gbt_depth4":
        w = F.when(F.col(label) == 1, round(neg / max(1, pos), 2)).otherwise(1.0)
    else:
        w = F.when(F.col(label) == 1, (neg + pos) / (2.0 * pos)).otherwise((neg + pos) / (2.0 * neg))
    return df.withColumn("weight", w)


def train_classifier(train: DataFrame, name: str, label: str = "label", seed: int = 42,
                     numeric: Sequence[str] = tuple(fv.MODEL_NUMERIC),
                     categorical: Sequence[str] = tuple(fv.MODEL_CATEGORICAL),
                     estimator: Estimator | None = None) -> PipelineModel:
    """Fit encoding and classifier as one pipeline; the encoded table is held for the iterations, unless the classifier holds rows of its own.

    Trees of tables of LEAST_BALANCED rows and more are grown from codes (`trees.grow`): MLlib counts every entry of a row in each pass, and its forest
    holds the draws and nodes of each row in all trees.
    """
    shared_dir(train.sparkSession)  # boosted trees cut their lineage there
    neg, pos = class_sizes(train, label)
    checked_labels(train, categorical)
    stages = feature_matrix(numeric, categorical, scale=name == "logistic")
    encoder = stages.fit(train)
    estimator = estimator or classifier(name, neg, pos, label, seed)
    encoded = row_weights(encoder.transform(train), name, neg, pos, label).select("features", label, "weight")
    if neg + pos >= LEAST_BALANCED and can_grow(encoded, estimator):
        return PipelineModel(stages=[*encoder.stages, grow(encoded, estimator, neg + pos)])
    if isinstance(estimator, LogisticRegression):
        return PipelineModel(stages=[*encoder.stages, estimator.fit(encoded)])
    ready = balanced(encoded, neg + pos).persist()
    try:
        fitted = estimator.fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*encoder.stages, fitted])


def predict(model: PipelineModel, df: DataFrame, p: str = "p") -> DataFrame:
    """Add the recovery probability; helper vectors are dropped."""
    out = model.transform(df)
    return out.withColumn(p, vector_to_array("probability")[1]).drop(
        *[c for c in out.columns if c not in df.columns])


def benchmark_models(train: DataFrame, test: DataFrame, names: Sequence[str] = CLASSIFIERS, metric: str = "roc_auc",
                     champion: str | None = None, fitted: Mapping[str, PipelineModel] | None = None,
                     parallelism: int = 4) -> DataFrame:
    """One metric row per model; the champion is the best by `metric` unless named."""
    fitted = dict(fitted or {})
    missing = [n for n in names if n not in fitted]
    fitted.update(zip(missing, side_by_side(
        train.sparkSession, [lambda n=n: train_classifier(train, n) for n in missing], parallelism)))
    out = None
    for n in names:
        row = score_report(predict(fitted[n], test)).select(F.lit(n).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    if champion is not None:
        return out.withColumn("is_champion", (F.col("model") == champion).cast("int"))
    best = out.agg(F.max_by("model", F.struct(metric, "model"))).scalar()
    return out.withColumn("is_champion", (F.col("model") == best).cast("int"))


def numeric_model_table(df: DataFrame, target: str, extra_exclude: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Numeric columns minus identifiers, leakage and targets, gaps filled by medians."""
    drop = {*fv.NON_FEATURE_COLUMNS, *fv.TARGET_COLUMNS, "recovery_target_binary", target, *extra_exclude}
    columns = [c for c in numeric_columns(df) if c not in drop]
    kept = df.select(*columns, F.col(target).cast("double").alias(target))
    return impute_numeric(kept, "median", columns, now=True), columns


def train_regressor(df: DataFrame, name: str, columns: Sequence[str], target: str = "recovered_amount",
                    seed: int = 42) -> PipelineModel:
    vec = VectorAssembler(inputCols=list(columns), outputCol="features")
    if name == "linear":
        est = LinearRegression(labelCol=target, featuresCol="features")
    elif name == "random_forest":
        est = RandomForestRegressor(labelCol=target, featuresCol="features", numTrees=50, maxDepth=6,
                                    featureSubsetStrategy="all", seed=seed)
    else:
        raise ValueError(f"unknown regressor {name!r}")
    ready = vec.transform(df).select("features", target).persist()
    try:
        return PipelineModel(stages=[vec, est.fit(ready)])
    finally:
        ready.unpersist()


def grid_search_cv(df: DataFrame, columns: Sequence[str], target: str, objective: str = "classification",
                   trees: Sequence[int] = (30, 60), depths: Sequence[int] = (4, 8), folds: int = 3,
                   seed: int = 42, parallelism: int = 4, key: str | None = None) -> DataFrame:
    """Mean and spread of the cross-validated score per (trees, depth); AUC or R². The best one is marked.

    With a key the folds are exact and repeatable: a class (or, for amounts, the table) is cut into folds that differ by one row at most.
    """
    if objective == "classification":
        rows = sum(class_sizes(df, target))
        est = RandomForestClassifier(labelCol=target, featuresCol="features", seed=seed, cacheNodeIds=True)
        judge = BinaryClassificationEvaluator(labelCol=target, metricName="areaUnderROC")
    else:
        rows = df.count()
        est = RandomForestRegressor(labelCol=target, featuresCol="features", featureSubsetStrategy="all", seed=seed, cacheNodeIds=True)
        judge = RegressionEvaluator(labelCol=target, metricName="r2")
    grid = ParamGridBuilder().addGrid(est.numTrees, list(trees)).addGrid(est.maxDepth, list(depths)).build()
    if key is not None:
        df = hash_folds(df, key, folds, [target] if objective == "classification" else [])
    kept = ["features", target] + (["fold"] if key is not None else [])
    ready = balanced(VectorAssembler(inputCols=list(columns), outputCol="features").transform(df).select(*kept), rows).persist()
    try:
        cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=seed,
                            parallelism=parallelism, foldCol="fold" if key is not None else "").fit(ready)
    finally:
        ready.unpersist()
    best = max(range(len(grid)), key=lambda k: cv.avgMetrics[k])
    marks = [(int(g[est.numTrees]), int(g[est.maxDepth]), float(m), float(s), int(k == best))
            for k, (g, m, s) in enumerate(zip(grid, cv.avgMetrics, cv.stdMetrics))]
    return df.sparkSession.createDataFrame(marks, "num_trees INT, max_depth INT, score DOUBLE, score_std DOUBLE, is_best INT")


def feature_importance(spark, model: PipelineModel, names: Sequence[str] | None = None, k: int = 15) -> DataFrame:
    """The k most important features of a fitted tree ensemble, with expanded names."""
    names = feature_names(model) if names is None else list(names)
    values = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature STRING, importance DOUBLE")
    return table.orderBy(F.desc("importance"), "feature").limit(k)
