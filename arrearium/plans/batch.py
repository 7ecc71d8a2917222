"""The whole run from raw tables to models, threshold, drivers and metadata, in stages that are stored and never run twice."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.operators import evaluate, explain, features, models, profile, reports, segments
from arrearium.plans.master import build_master
from arrearium.session import exists
from arrearium.sources import writers

RAW = ("customers", "loans", "repayments", "recovery_activities")


@dataclass
class BatchRun:
    """What a run has stored: every artefact by name, below folder; `ran` lists the stages that this call had to do."""

    spark: SparkSession
    folder: str
    ran: list[str] = field(default_factory=list)

    def path(self, artefact: str) -> str:
        return f"{self.folder}/{artefact}"

    def table(self, artefact: str) -> DataFrame:
        return self.spark.read.parquet(self.path(artefact))

    def model(self, name: str) -> PipelineModel:
        return writers.load_model(self.spark, self.path(f"models/{name}"))

    def metadata(self) -> DataFrame:
        return self.table("metadata")


def _print(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _done(run: BatchRun, stage: str) -> str | None:
    path = run.path(f"_manifest/{stage}")
    return run.spark.read.parquet(path).first()["fingerprint"] if exists(run.spark, path) else None


def _stage(run: BatchRun, name: str, after: Sequence[str], parameters: Mapping, work: Callable[[], None], prints: dict[str, str]) -> None:
    """Do the work unless the manifest says that it was done with these parameters, on stages with the same fingerprints.

    The manifest's entry is written last, so a stage that was cut off is done again, over what it left behind.
    """
    prints[name] = _print(name, [prints[a] for a in after], parameters)
    if _done(run, name) == prints[name]:
        return
    work()
    run.spark.createDataFrame([(prints[name],)], "fingerprint string").coalesce(1).write.mode("overwrite").parquet(run.path(f"_manifest/{name}"))
    run.ran.append(name)


def run_batch(raw: Mapping[str, DataFrame], folder: str, names: Sequence[str] = models.CLASSIFIERS, test_share: float = 0.2, clusters: int = 4,
              starts: int = 15, drivers: int = 15, metric: str = "roc_auc", version: str = "",
              fit: Callable[[DataFrame, str], PipelineModel] = models.train_classifier) -> BatchRun:
    """Clean and join, explore, segment, split, fit every model, compare, tune the threshold, explain the best tree model, describe.

    Each stage writes its tables below folder and then its entry in the manifest; called again on the same folder the run
    goes on at the first stage that is not finished. version names the state of the raw tables: another one runs all again.
    fit trains one model by name. Read results from the BatchRun; nothing but single rows comes to the driver.
    """
    spark = raw["loans"].sparkSession
    run, prints = BatchRun(spark, folder), {}

    def write(df: DataFrame, artefact: str) -> None:
        df.write.mode("overwrite").parquet(run.path(artefact))

    def master() -> None:
        writers.write_master(build_master(*[raw[t] for t in RAW]), folder, rebalance=True)

    def explore() -> None:
        table = run.table("master")
        write(profile.correlation_matrix(table), "explore/correlation")
        write(reports.default_rate_by(table), "explore/default_rate_by_type")
        write(profile.missing_profile(table), "explore/missing")

    def segment() -> None:
        vectors = segments.scaled_features(run.table("master").select("loan_id", *fv.SEGMENT_FEATURES, "default_flag", "recovered_amount"))
        writers.write_segments(segments.persona_rules(segments.kmeans_segments(vectors, clusters, starts)).drop("features"), run.path("segments"))

    def split() -> None:
        write(features.stratified_split(models.modelling_table(run.table("master")), "loan_id", "label", test_share), "split")

    def part(is_test: int) -> DataFrame:
        return run.table("split").where(F.col("is_test") == is_test).drop("is_test")

    def compare() -> None:
        write(models.benchmark_models(part(0), part(1), names, metric, fitted={n: run.model(n) for n in names}).coalesce(1), "benchmark")

    def champion() -> str:
        return run.table("benchmark").where("is_champion = 1").first()["model"]

    def threshold() -> None:
        write(models.predict(run.model(champion()), part(1)).select("loan_id", "label", "p"), "scores")
        write(evaluate.threshold_sweep(run.table("scores")), "thresholds")

    def driven() -> None:
        trees = [n for n in names if n != "logistic"]
        if not trees:
            write(spark.createDataFrame([], "feature string, mean_abs double, model string"), "drivers")
            return
        best = run.table("benchmark").where(F.col("model").isin(trees)).orderBy(F.desc(metric), F.desc("model")).first()["model"]
        found = explain.attribution_tree(run.model(best), part(1), "loan_id")
        write(explain.global_attribution(found, "loan_id", drivers).withColumn("model", F.lit(best)), "drivers")

    def describe() -> None:
        write(full_metadata(run, champion(), names).coalesce(1), "metadata")
        writers.write_run_metadata(run.metadata(), run.path("metadata_json"))

    _stage(run, "master", [], {"version": version, "schema": [raw[t].schema.json() for t in RAW]}, master, prints)
    _stage(run, "explore", ["master"], {}, explore, prints)
    _stage(run, "segments", ["master"], {"clusters": clusters, "starts": starts}, segment, prints)
    _stage(run, "split", ["master"], {"test_share": test_share}, split, prints)
    for name in names:
        _stage(run, f"model-{name}", ["split"], {"fit": fit.__qualname__}, lambda name=name: writers.save_model(fit(part(0), name), run.path(f"models/{name}")), prints)
    _stage(run, "benchmark", [f"model-{n}" for n in names], {"metric": metric}, compare, prints)
    _stage(run, "threshold", ["benchmark"], {}, threshold, prints)
    _stage(run, "drivers", ["benchmark"], {"drivers": drivers}, driven, prints)
    _stage(run, "metadata", ["threshold", "drivers"], {}, describe, prints)
    return run


def full_metadata(run: BatchRun, champion: str, names: Sequence[str]) -> DataFrame:
    """One nested row: sizes, the champion's scores at 0.5 and at the tuned threshold, every model's scores, features, drivers."""
    scores = F.struct("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    benchmark = run.table("benchmark")
    all_scores = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("model"), scores.alias("scores"))))).alias("m")  # a few models
    best = F.max(F.when(F.col("model") == champion, scores)).alias("best")
    sizes = run.table("split").agg(F.count_if(F.col("is_test") == 0).alias("train"), F.count_if(F.col("is_test") == 1).alias("test"))
    tuned = evaluate.optimal_threshold(run.table("thresholds")).select("threshold", "recall", "precision", F.col("f1").alias("f1_score"))
    drivers = run.table("drivers").orderBy(F.desc("mean_abs"), "feature").limit(5).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("mean_abs")).alias("order"), "feature"))).alias("d"), F.max("model").alias("model"))
    width = len(features.feature_names(run.model(champion)))
    joined = benchmark.agg(all_scores, best)
    for one in (sizes, tuned.select(F.struct("*").alias("t")), drivers):  # one row each
        joined = joined.select("*", *[one.select(F.col(c)).scalar().alias(c) for c in one.columns])
    return joined.select(
        F.lit(champion).alias("model_name"), F.lit("Loan Recovery Probability Estimation").alias("task"), F.col("train").alias("training_sample_size"),
        F.col("test").alias("test_sample_size"), F.col("best").alias("metrics_default_threshold"),
        F.struct("t.*", F.col("best.roc_auc").alias("roc_auc")).alias("metrics_optimal_threshold"), F.col("m").alias("benchmark_comparison"),
        F.struct(F.array(*map(F.lit, fv.MODEL_NUMERIC)).alias("numeric"), F.array(*map(F.lit, fv.MODEL_CATEGORICAL)).alias("categorical"),
                 F.lit(width).alias("total_transformed_features")).alias("features"),
        F.col("t.threshold").alias("optimal_recovery_threshold"),
        F.struct(F.lit("Shapley values").alias("framework"), F.col("model").alias("explained_model"),
                 F.transform("d", lambda x: x["feature"]).alias("top_drivers")).alias("explainable_ai"))
