"""Invariants of fitted models on a label that can be learnt."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators import evaluate, explain, features, models, segments
from arrearium.plans import pipeline
from arrearium.sources import writers
from catalog.registry import Inputs

NUMERIC = ["credit_score", "overdue_days", "loan_amount", "age"]
CATEGORICAL = ["loan_type", "city_tier"]


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    book = Inputs(spark, sf_dir).book
    rows = book.select("loan_id", *NUMERIC, *CATEGORICAL, X.logistic_recovery_rule("credit_score", "overdue_days").alias("label"))
    return rows.persist()


@pytest.fixture(scope="module")
def split(table):
    marked = features.stratified_split(table, "loan_id", "label", 0.25).persist()
    return marked.where("is_test = 0"), marked.where("is_test = 1")


def fit(train, estimator):
    return models.train_classifier(train, "custom", numeric=NUMERIC, categorical=CATEGORICAL, estimator=estimator)


@pytest.fixture(scope="module")
def booster(split):
    return fit(split[0], GBTClassifier(maxIter=8, maxDepth=3, seed=1, labelCol="label", weightCol="weight"))


def test_split_keeps_class_shares(table, split):
    want = {r["label"]: int(0.25 * r["count"]) for r in table.groupBy("label").count().collect()}
    assert {r["label"]: r["count"] for r in split[1].groupBy("label").count().collect()} == want


def test_models_learn_and_the_champion_is_the_best(spark, split):
    train, test = split
    names = ["logistic", "random_forest"]
    fitted = {"logistic": models.train_classifier(train, "logistic", numeric=NUMERIC, categorical=CATEGORICAL),
              "random_forest": fit(train, RandomForestClassifier(numTrees=10, maxDepth=5, seed=1, labelCol="label"))}
    rows = models.benchmark_models(train, test, names, fitted=fitted).collect()
    assert all(r["roc_auc"] > 0.9 for r in rows)
    assert [r["model"] for r in rows if r["is_champion"]] == [max(rows, key=lambda r: r["roc_auc"])["model"]]
    named = models.benchmark_models(train, test, names, champion="random_forest", fitted=fitted)
    assert named.where("is_champion = 1").first()["model"] == "random_forest"


def test_saved_model_scores_alike_and_seeds_repeat(spark, split, booster, tmp_path):
    train, test = split
    writers.save_model(booster, f"{tmp_path}/m")
    scores = {n: m for n, m in (("loaded", writers.load_model(spark, f"{tmp_path}/m")), ("again", fit(train, GBTClassifier(
        maxIter=8, maxDepth=3, seed=1, labelCol="label", weightCol="weight"))))}
    want = {r["loan_id"]: r["p"] for r in models.predict(booster, test).collect()}
    for m in scores.values():
        assert {r["loan_id"]: r["p"] for r in models.predict(m, test).collect()} == pytest.approx(want)


def test_one_class_is_an_error(split):
    with pytest.raises(ValueError, match="one class"):
        models.train_classifier(split[0].where("label = 1"), "logistic", numeric=NUMERIC, categorical=CATEGORICAL)


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_contributions_add_up_to_the_score(split, booster, kind):
    train, test = split
    model = booster if kind == "boosted" else fit(train, RandomForestClassifier(
        numTrees=7, maxDepth=4, seed=1, labelCol="label", weightCol="weight"))
    p = vector_to_array("probability")[1]
    target = F.ln(p / (1 - p)) if kind == "boosted" else p  # log-odds, or the probability itself
    want = {r["loan_id"]: r["m"] for r in model.transform(test).select("loan_id", target.alias("m")).collect()}
    got = explain.attribution_tree(model, test, "loan_id").collect()
    assert {r["loan_id"]: r["base"] + sum(c["contribution"] for c in r["contributions"]) for r in got} == pytest.approx(want)
    names = features.feature_names(model)
    assert names[:4] == NUMERIC and names == [c["feature"] for c in got[0]["contributions"]]


def test_batch_scoring_with_a_model(table, booster):
    from arrearium.plans.scoring import batch_score

    accounts = table.withColumns({"outstanding_principal": F.lit(100.0), "settlement_discount_pct": F.lit(10.0)})
    rows = batch_score(accounts, booster).select("p", "recoverable_std", "grade", "expected_yield").collect()
    assert len(rows) == table.count()
    for r in rows:
        assert r["recoverable_std"] == int(r["p"] >= 0.5) and r["expected_yield"] == pytest.approx(90.0 * r["p"])
        assert (r["grade"] == "A") == (r["p"] >= 0.75)


def test_feature_importance_names(spark, booster):
    names = features.feature_names(booster)
    top = models.feature_importance(spark, booster, names, 3).collect()
    assert {r["feature"] for r in top} >= {"credit_score", "overdue_days"}


def test_regressors_and_grid_search(table):
    rows = table.select("credit_score", "overdue_days", "label", (F.col("credit_score") * 2.0 + 1).alias("recovered_amount"))
    linear = models.train_regressor(rows, "linear", ["credit_score", "overdue_days"])
    preds = linear.transform(rows).select(F.col("recovered_amount").alias("actual"), F.col("prediction").alias("predicted"))
    assert evaluate.regression_metrics(preds).first()["r2"] == pytest.approx(1.0)
    grid = models.grid_search_cv(rows, ["credit_score", "overdue_days"], "label", trees=(3, 5), depths=(2, 4)).collect()
    assert len(grid) == 4 and sum(r["is_best"] for r in grid) == 1
    assert max(grid, key=lambda r: r["score"])["is_best"] == 1


def test_segments_and_components(spark, sf_dir):
    rows = Inputs(spark, sf_dir).master.select("loan_id", *fv.SEGMENT_FEATURES, "default_flag", "recovered_amount")
    vectors = segments.scaled_features(rows).persist()
    scan = segments.kmeans_scan(vectors, ks=(2, 4), starts=2).orderBy("k").collect()
    assert scan[0]["inertia"] > scan[1]["inertia"] and all(-1 <= r["silhouette"] <= 1 for r in scan)
    named = segments.persona_rules(segments.kmeans_segments(vectors, starts=2))
    assert named.where("segment_name IS NULL").count() == 0
    pca = segments.pca_fit(vectors)
    axes = pca.pc.toArray()
    np.testing.assert_allclose(axes.T @ axes, np.eye(2), atol=1e-9)
    assert segments.pca_2d(vectors, pca).count() == vectors.count()


def test_batch_run_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier

    from arrearium.plans import batch

    i = Inputs(spark, sf_dir)
    raw = {"customers": i.customers, "loans": i.loans, "repayments": i.repayments, "recovery_activities": i.recovery}
    calls, broken = [], ["gbt_depth4"]

    def fit(train, name):
        calls.append(name)
        if name in broken:
            raise RuntimeError("executor lost")
        small = {"random_forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=1, labelCol="label", weightCol="weight"),
                 "gbt_depth4": GBTClassifier(maxIter=3, maxDepth=3, seed=1, labelCol="label", weightCol="weight")}
        return models.train_classifier(train, name, estimator=small.get(name))

    names = ("logistic", "random_forest", "gbt_depth4")
    with pytest.raises(RuntimeError, match="lost"):
        batch.run_batch(raw, str(tmp_path), names, starts=1, fit=fit)
    broken.clear()
    run = batch.run_batch(raw, str(tmp_path), names, starts=1, fit=fit)
    assert run.ran == ["model-gbt_depth4", "benchmark", "threshold", "drivers", "metadata"]
    assert calls == ["logistic", "random_forest", "gbt_depth4", "gbt_depth4"]
    assert batch.run_batch(raw, str(tmp_path), names, starts=1, fit=fit).ran == []
    assert batch.run_batch(raw, str(tmp_path), names, starts=1, drivers=3, fit=fit).ran == ["drivers", "metadata"]
    meta = run.metadata().first()
    split = run.table("split")
    assert meta["training_sample_size"] + meta["test_sample_size"] == split.count() == run.table("master").where("overdue_days > 30").count()
    assert set(meta["benchmark_comparison"]) == set(names) and meta["metrics_default_threshold"] == meta["benchmark_comparison"][meta["model_name"]]
    assert meta["metrics_default_threshold"]["roc_auc"] == max(m["roc_auc"] for m in meta["benchmark_comparison"].values())
    assert meta["optimal_recovery_threshold"] == evaluate.optimal_threshold(run.table("thresholds")).first()["threshold"]
    assert len(meta["explainable_ai"]["top_drivers"]) == 3 and meta["features"]["total_transformed_features"] > len(meta["features"]["numeric"])
    assert run.table("segments").count() == run.table("master").count()


def test_whole_pipeline(spark, sf_dir, tmp_path):
    book = Inputs(spark, sf_dir).book.select("loan_id", *NUMERIC, "loan_type")
    result = pipeline.run_pipeline(book.unionByName(book), "loan_id", str(tmp_path), trees=5, depth=4)
    assert result.table.count() == book.count()
    assert result.metrics.first()["roc_auc"] > 0.9
    meta = spark.read.json(f"{tmp_path}/metadata").first()
    assert meta["features"]["numeric"] == result.features and meta["metrics_optimal_threshold"]["recall"] >= 0.8
    assert spark.read.option("header", True).csv(f"{tmp_path}/sample").count() == min(5000, book.count())


def test_the_benchmark_trains_its_models_at_the_same_time(spark, sf_dir, monkeypatch):
    from threading import Barrier

    from catalog import model_runs

    together, i = Barrier(len(models.CLASSIFIERS), timeout=30), Inputs(spark, sf_dir)
    monkeypatch.setattr(model_runs, "_FITTED", {})
    monkeypatch.setattr(model_runs, "_split", lambda i: ("train", "test"))
    monkeypatch.setattr(models, "train_classifier", lambda train, name: (together.wait(), f"{name} of {train}")[1])
    monkeypatch.setattr(models, "benchmark_models", lambda train, test, fitted: fitted)
    assert model_runs.benchmark_models(i) == {n: f"{n} of train" for n in models.CLASSIFIERS}
    assert model_runs._models(i, "other") == {n: f"{n} of train" for n in models.CLASSIFIERS}  # fitted once


def test_the_split_is_found_once(spark, sf_dir, monkeypatch):
    from catalog import model_runs

    calls, find = [], features.stratified_split
    monkeypatch.setattr(model_runs, "_FITTED", {})
    monkeypatch.setattr(features, "stratified_split", lambda *a: (calls.append(a), find(*a))[1])
    i = Inputs(spark, sf_dir)
    train, test = model_runs._split(i)
    again = model_runs._split(i)
    assert len(calls) == 1 and (again[0].count(), again[1].count()) == (train.count(), test.count())


def test_forests_keep_the_nodes_of_rows_and_stay_the_same(split):
    forest = models.classifier("random_forest", 1, 1)
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 200
    kept = [fit(split[0], RandomForestClassifier(numTrees=6, maxDepth=5, seed=3, labelCol="label", weightCol="weight", cacheNodeIds=c)) for c in (True, False)]
    assert len({"\n".join(m.stages[-1].toDebugString.split("\n")[1:]) for m in kept}) == 1


def test_the_grid_search_keeps_the_nodes_of_rows(table, monkeypatch):
    seen, validator = [], models.CrossValidator
    monkeypatch.setattr(models, "CrossValidator", lambda **of: (seen.append(of["estimator"].getCacheNodeIds()), validator(**of))[1])
    rows = table.select("loan_id", "credit_score", "overdue_days", "label")
    models.grid_search_cv(rows, ["credit_score", "overdue_days"], "label", trees=(2,), depths=(2,), folds=2, key="loan_id")
    assert seen == [True]


def test_training_rows_are_dealt_evenly_over_the_slots(spark, split, monkeypatch):
    slots, seen = spark.sparkContext.defaultParallelism, []

    class Forest(RandomForestClassifier):
        def fit(self, rows):
            seen.append([r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()])
            return super().fit(rows)

    forest = Forest(numTrees=2, maxDepth=2, seed=1, labelCol="label")
    uneven = split[0].repartition(3 * slots + 1).persist()
    n = uneven.count()
    fit(uneven, forest)  # a small table stays as it is
    monkeypatch.setattr(models, "LEAST_BALANCED", 10)
    fit(uneven, forest)
    monkeypatch.setattr(models, "MOST_ROWS", n // slots)
    fit(uneven, forest)
    parts = [slots, slots if n % slots == 0 else 2 * slots]
    assert len(seen[0]) == 3 * slots + 1 and [len(s) for s in seen[1:]] == parts
    assert all(sum(s) == n for s in seen) and all(max(s) - min(s) <= slots for s in seen[1:])


def test_the_grid_search_deals_its_rows_evenly(spark, table, monkeypatch):
    seen, validator = [], models.CrossValidator

    class Watched(validator):
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return super().fit(rows)

    monkeypatch.setattr(models, "LEAST_BALANCED", 10)
    monkeypatch.setattr(models, "CrossValidator", Watched)
    rows = table.select("loan_id", "credit_score", "overdue_days", "label").repartition(17)
    models.grid_search_cv(rows, ["credit_score", "overdue_days"], "label", trees=(2,), depths=(2,), folds=2, key="loan_id")
    assert seen == [spark.sparkContext.defaultParallelism]
