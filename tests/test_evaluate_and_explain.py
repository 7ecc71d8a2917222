"""Metrics against brute force, and contributions against Shapley values by enumeration."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from arrearium.operators import evaluate, explain

SCORED = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20).map(lambda k: k / 20)), min_size=2, max_size=40)


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, p double")


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    if not pos or not neg:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total = sum(y for y, _ in rows)
    if not total:
        return None
    out = last = 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp = sum(y for y, p in rows if p >= t)
        out += (tp / total - last) * tp / sum(p >= t for _, p in rows)
        last = tp / total
    return out


@settings(max_examples=6, deadline=None)
@given(rows=SCORED)
def test_auc_and_average_precision(spark, rows):
    df = frame(spark, rows)
    auc, ap = evaluate.roc_auc(df).first()[0], evaluate.pr_auc(df).first()[0]
    assert auc == (None if brute_auc(rows) is None else pytest.approx(brute_auc(rows)))
    assert ap == (None if brute_ap(rows) is None else pytest.approx(brute_ap(rows)))
    report = evaluate.score_report(df).first()
    plain = evaluate.classification_metrics(df).first()
    assert report["roc_auc"] == auc and report["pr_auc"] == ap
    for m in ("n", "accuracy", "precision", "recall", "f1"):
        assert report[m] == pytest.approx(plain[m])


def test_auc_of_the_opposite_score_and_mllib(spark):
    rng = np.random.default_rng(1)
    rows = [(int(y), float(p)) for y, p in zip(rng.integers(0, 2, 500), np.round(rng.random(500), 2))]
    df = frame(spark, rows)
    auc = evaluate.roc_auc(df).first()[0]
    assert evaluate.roc_auc(df.withColumn("p", 1 - F.col("p"))).first()[0] == pytest.approx(1 - auc)
    raw = df.select("label", array_to_vector(F.array(1 - F.col("p"), "p")).alias("rawPrediction"))
    assert BinaryClassificationEvaluator(labelCol="label").evaluate(raw) == pytest.approx(auc)


def test_sweep_falls_and_optimum(spark):
    rows = [(1, 0.9), (1, 0.6), (1, 0.3), (0, 0.7), (0, 0.2), (0, 0.1)]
    sweep = evaluate.threshold_sweep(frame(spark, rows)).orderBy("threshold").collect()
    assert len(sweep) == 33 and sweep[0]["threshold"] == 0.1 and sweep[-1]["threshold"] == 0.9
    recalls = [r["recall"] for r in sweep]
    assert recalls == sorted(recalls, reverse=True)
    best = evaluate.optimal_threshold(evaluate.threshold_sweep(frame(spark, rows))).first()
    assert best["recall"] == 1.0 and best["threshold"] == 0.225


def test_undefined_metrics_are_zero(spark):
    row = evaluate.classification_metrics(frame(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0), (None, 1.0)], "actual double, predicted double")
    row = evaluate.regression_metrics(df).first()
    assert row["mae"] == pytest.approx(5 / 3) and row["r2"] == pytest.approx(1 - 17 / 8)


def test_linear_contributions_add_up(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 1.0)], "k int, a double, b double")
    got = explain.attribution_linear(df, {"a": 3.0, "b": -1.0}, "k").collect()
    for r in got:
        total = sum(c["contribution"] for c in r["contributions"])
        x = {c["feature"]: c["value"] for c in r["contributions"]}
        assert total == pytest.approx(3 * x["a"] - x["b"] - (3 * 3.0 - 3.0))


# --- trees -------------------------------------------------------------------------------------

def random_tree(rng, n_features, depth):
    nodes = []

    def grow(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == 0 or (level < depth and rng.random() < 0.2):
            nodes[at] = (-1, -1, cover, rng.normal(), -1, np.array([]), False)
            return at
        share = rng.uniform(0.2, 0.8)
        left, right = grow(level - 1, cover * share), grow(level - 1, cover * (1 - share))
        nominal = bool(rng.random() < 0.3)
        cut = np.array([0.0]) if nominal else np.array([rng.normal()])
        nodes[at] = (left, right, cover, 0.0, int(rng.integers(n_features)), cut, nominal)
        return at

    grow(depth, 100.0)
    left, right, cover, value, feature, cut, nominal = zip(*nodes)
    return {"left": np.array(left), "right": np.array(right), "cover": np.array(cover), "value": np.array(value),
            "feature": np.array(feature), "cut": list(cut), "nominal": np.array(nominal)}


def expectation(t, x, known, at=0):
    if t["left"][at] < 0:
        return t["value"][at]
    f, left, right = t["feature"][at], t["left"][at], t["right"][at]
    if f in known:
        go = x[f] in t["cut"][at] if t["nominal"][at] else x[f] <= t["cut"][at][0]
        return expectation(t, x, known, left if go else right)
    c = t["cover"]
    return (expectation(t, x, known, left) * c[left] + expectation(t, x, known, right) * c[right]) / c[at]


def brute_shapley(t, x):
    n = len(x)
    out = np.zeros(n)
    for j in range(n):
        rest = [k for k in range(n) if k != j]
        for size in range(n):
            w = factorial(size) * factorial(n - size - 1) / factorial(n)
            for s in combinations(rest, size):
                out[j] += w * (expectation(t, x, {*s, j}) - expectation(t, x, set(s)))
    return out


def test_tree_contributions_are_shapley_values():
    rng = np.random.default_rng(5)
    for _ in range(6):
        trees = [random_tree(rng, 5, 4) for _ in range(2)]
        x = np.round(rng.normal(size=(4, 5)), 0)
        base, got = explain.base_value(trees), explain.tree_contributions(x, trees)
        for row, phi in zip(x, got):
            np.testing.assert_allclose(phi, sum(brute_shapley(t, row) for t in trees), atol=1e-12)
            np.testing.assert_allclose(base + phi.sum(), sum(expectation(t, row, set(range(5))) for t in trees))


def test_deep_ensembles_stay_additive():
    """200 trees of depth 12: polynomial in the depth, where patterns of met features would be 4096 for each leaf."""
    rng = np.random.default_rng(6)
    trees = []
    while len(trees) < 200:
        t = random_tree(rng, 15, 12)
        if len(t["left"]) > 40:
            trees.append({**t, "value": t["value"] / 100})
        if len(trees) > 20:
            trees += [{**t, "value": rng.normal(size=len(t["value"])) / 100} for t in trees[:20]]
    trees = trees[:200]
    x = np.round(rng.normal(size=(16, 15)), 0)
    phi = explain.tree_contributions(x, trees)
    want = [sum(expectation(t, row, set(range(15))) for t in trees) for row in x]
    np.testing.assert_allclose(explain.base_value(trees) + phi.sum(axis=1), want, atol=1e-9)


def test_tree_of_one_leaf_gives_nothing():
    t = {"left": np.array([-1]), "right": np.array([-1]), "cover": np.array([5.0]), "value": np.array([2.5]), "feature": np.array([-1]),
         "cut": [np.array([])], "nominal": np.array([False])}
    assert explain.base_value([t]) == 2.5 and not explain.tree_contributions(np.ones((3, 2)), [t]).any()
