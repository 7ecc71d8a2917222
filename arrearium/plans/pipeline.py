"""From any loan table to a fitted, measured and stored model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.operators import clean, features
from arrearium.operators.evaluate import optimal_threshold, score_report, threshold_sweep
from arrearium.operators.models import predict, train_classifier
from arrearium.operators.standardize import standardize_dataset
from arrearium.session import stored
from arrearium.sources import writers


@dataclass
class PipelineResult:
    model: PipelineModel
    metrics: DataFrame
    features: list[str]
    table: DataFrame
    scores: DataFrame


def run_metadata(scores: DataFrame, model_name: str, numeric: list[str], categorical: list[str],
                 n_train: int) -> DataFrame:
    """One nested row: sizes, metrics at 0.5, the tuned threshold, and the features."""
    default = F.struct(*[c for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")])
    tuned = optimal_threshold(threshold_sweep(scores)).select(F.struct("*").alias("t")).scalar()
    return score_report(scores).select(
        F.lit(model_name).alias("model_name"), F.lit(n_train).alias("training_rows"), F.col("n").alias("test_rows"),
        default.alias("metrics_default_threshold"), tuned.alias("metrics_optimal_threshold"),
        F.struct(F.array(*[F.lit(c) for c in numeric]).alias("numeric"),
                 F.array(*[F.lit(c) for c in categorical]).cast("array<string>").alias("categorical")).alias("features"))


def run_pipeline(df: DataFrame, key: str, folder: str | None = None, test_pct: int = 20, trees: int = 50,
                 depth: int = 6, seed: int = 42) -> PipelineResult:
    """Standardise, de-duplicate, fill gaps, split, train a forest, measure, and store if asked.

    The prepared table feeds the statistics, the training and the scoring, so it is stored once in
    the shared folder instead of being derived three times; so are the scores, which several measures read.
    """
    table = stored(clean.drop_duplicates(standardize_dataset(df, key, now=True)), "prepared")
    skip = {*fv.NON_FEATURE_COLUMNS, *fv.TARGET_COLUMNS, "recovery_target_binary", key}
    columns = [c for c in clean.numeric_columns(table) if c not in skip]
    filled = clean.impute_numeric(table, "median", columns, now=True)
    split = features.random_split(filled, key, test_pct).withColumnRenamed("recovery_status_binary", "label")
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
    model = train_classifier(train, "forest", numeric=columns, categorical=[], estimator=forest)
    scores = stored(predict(model, test).select(key, "label", "p"), "scores")
    metrics = score_report(scores)
    if folder:
        writers.save_model(model, f"{folder}/model")
        writers.write_run_metadata(run_metadata(scores, "Random Forest", columns, [], train.count()), f"{folder}/metadata")
        writers.export_top_n(table, f"{folder}/sample", 5000, [key])
    return PipelineResult(model, metrics, columns, table, scores)
