"""Queries: clustering, training, scoring and explanation. Models have no oracle; rule scores do."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.operators import explain, features, models, segments
from arrearium.plans import batch, pipeline, scoring
from arrearium.session import scratch_path, side_by_side
from arrearium.sources import writers
from catalog.registry import query, rounded

# Fitted models of this process by (application, data folder, name): several queries look at one model.
_FITTED: dict = {}


def _split(i):
    key = (i.spark.sparkContext.applicationId, i.sf_dir, "split")
    if key not in _FITTED:  # the split finds its cuts by jobs of its own
        table = features.stratified_split(models.modelling_table(i.stored_master), "loan_id", "label", 0.2)
        path = scratch_path(i.spark, "split")
        table.write.parquet(path)
        _FITTED[key] = path
    stored = i.spark.read.parquet(_FITTED[key])
    return stored.where("is_test = 0").drop("is_test"), stored.where("is_test = 1").drop("is_test")


def _model(i, name, train=None) -> PipelineModel:
    key = (i.spark.sparkContext.applicationId, i.sf_dir, name)
    if key not in _FITTED:
        _FITTED[key] = models.train_classifier(_split(i)[0] if train is None else train, name)
    return _FITTED[key]


def _models(i, train=None) -> dict[str, PipelineModel]:
    """All classifiers; those that are missing are trained side by side, as boosting alone leaves most slots idle."""
    train = _split(i)[0] if train is None else train
    fitted = side_by_side(i.spark, [lambda n=n: _model(i, n, train) for n in models.CLASSIFIERS], len(models.CLASSIFIERS))
    return dict(zip(models.CLASSIFIERS, fitted))


def _train_query(key, name):
    @query(key)
    def run(i):
        """Test rows with the fitted model's probability."""
        return models.predict(_model(i, name), _split(i)[1]).select("loan_id", "label", "p")


_train_query("train_logistic", "logistic")
_train_query("train_random_forest", "random_forest")
_train_query("train_gbt_depth4", "gbt_depth4")
_train_query("train_gbt_depth5", "gbt_depth5")


@query("benchmark_models")
def benchmark_models(i):
    train, test = _split(i)
    return models.benchmark_models(train, test, fitted=_models(i))


def _regression(name):
    def run(i):
        rows, columns = models.numeric_model_table(i.delinquent, "recovered_amount")
        out = models.train_regressor(rows, name, columns).transform(rows)
        return out.select(F.col("recovered_amount").alias("actual"), F.col("prediction").alias("predicted"))
    return run


query("train_linear_regression")(_regression("linear"))
query("train_rf_regressor")(_regression("random_forest"))


@query("linear_fit_single_feature", ["late_book"], """
SELECT round(regr_slope(recovered_amount, outstanding_principal), 6) AS slope,
  round(regr_intercept(recovered_amount, outstanding_principal), 2) AS intercept FROM late_book""")
def linear_fit_single_feature(i):
    """The one-feature form of the least-squares fit, which SQL can check."""
    return rounded(i.late_book.agg(F.regr_slope("recovered_amount", "outstanding_principal").alias("slope"),
                                   F.regr_intercept("recovered_amount", "outstanding_principal").alias("intercept")), 6, intercept=2)


@query("grid_search_cv")
def grid_search_cv(i):
    columns = fv.MODEL_NUMERIC
    rows = models.modelling_table(i.stored_master).select("loan_id", *columns, "label")
    return models.grid_search_cv(rows, columns, "label", key="loan_id")


@query("feature_importance")
def feature_importance(i):
    return models.feature_importance(i.spark, _model(i, "gbt_depth5"))


def _vectors(i):
    return segments.scaled_features(i.stored_master.select("loan_id", *fv.SEGMENT_FEATURES, "default_flag", "recovered_amount"))


@query("kmeans_scan")
def kmeans_scan(i):
    return segments.kmeans_scan(_vectors(i), parallelism=8)


@query("kmeans_segments")
def kmeans_segments(i):
    return segments.kmeans_segments(_vectors(i)).select("loan_id", "cluster_id")


@query("write_segments")
def write_segments(i):
    named = segments.persona_rules(segments.kmeans_segments(_vectors(i)))
    path = scratch_path(i.spark, "segments")
    writers.write_segments(named.drop("features"), path)
    return i.spark.read.parquet(path).groupBy("cluster_id", "segment_name").agg(F.count("*").alias("n"))


@query("pca_2d")
def pca_2d(i):
    return segments.pca_2d(_vectors(i)).select("loan_id", "pca_dim1", "pca_dim2", "var_share1", "var_share2")


def _stored_model(i):
    path = scratch_path(i.spark, "model")
    writers.save_model(_model(i, "logistic"), path)
    return writers.load_model(i.spark, path)


def _difference(i, rows):
    """How far a model's score of each row moves by a round trip through storage, and whether it is a probability."""
    again = models.predict(_stored_model(i), rows).select("loan_id", F.col("p").alias("p_loaded"))
    both = models.predict(_model(i, "logistic"), rows).select("loan_id", "p").join(again, "loan_id")
    return both.select("loan_id", (F.col("p") - F.col("p_loaded")).alias("difference"), F.col("p").between(0, 1).alias("is_probability"))


@query("save_model", ["scores"], """
SELECT loan_id, 0e0 AS difference, TRUE AS is_probability FROM (
  SELECT loan_id, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id) AS rn,
    COUNT(*) OVER (PARTITION BY label) AS n FROM scores) WHERE rn <= floor(0.2e0*n + 1e-9)""")
def save_model(i):
    """The test rows' scores before and after a model was stored: no difference."""
    return _difference(i, _split(i)[1])


@query("load_model", ["delinquent"], "SELECT loan_id, 0e0 AS difference, TRUE AS is_probability FROM delinquent")
def load_model(i):
    """Every delinquent account scored by a model read from storage, next to the model as it was fitted."""
    return _difference(i, models.modelling_table(i.stored_master))


@query("write_run_metadata")
def write_run_metadata(i):
    train, test = _split(i)
    scores = models.predict(_model(i, "logistic"), test)
    meta = pipeline.run_metadata(scores, "Logistic Regression", fv.MODEL_NUMERIC, fv.MODEL_CATEGORICAL, train.count())
    path = scratch_path(i.spark, "metadata")
    writers.write_run_metadata(meta, path)
    return i.spark.read.schema(meta.schema).json(path)


@query("run_pipeline")
def run_pipeline(i):
    return pipeline.run_pipeline(i.book, "loan_id", scratch_path(i.spark, "run")).metrics


def _batch(i):
    """The whole run on the raw tables; its models, trained on its own training rows, are those that other queries look at too."""
    key = (i.spark.sparkContext.applicationId, i.sf_dir, "batch")
    if key not in _FITTED:
        raw = {"customers": i.customers, "loans": i.loans, "repayments": i.repayments, "recovery_activities": i.recovery}
        _FITTED[key] = batch.run_batch(raw, scratch_path(i.spark, "batch"), starts=3, fit=lambda train, name: _models(i, train)[name])
    return _FITTED[key]


@query("batch_pipeline", ["master", "scores"], """
SELECT (SELECT COUNT(*) FROM master) AS master_rows, (SELECT COUNT(*) FROM master WHERE overdue_days > 30) AS late_rows,
  CAST(SUM(n - t) AS BIGINT) AS training_rows, CAST(SUM(t) AS BIGINT) AS test_rows, CAST(SUM(t) AS BIGINT) AS scored_rows, CAST(33 AS BIGINT) AS thresholds,
  CAST(4 AS BIGINT) AS models
FROM (SELECT label, COUNT(*) AS n, floor(0.2e0*COUNT(*) + 1e-9) AS t FROM scores GROUP BY label)""")
def batch_pipeline(i):
    """What the stored stages of a whole run hold."""
    run = _batch(i)

    def rows(artefact, **by):
        df = run.table(artefact)
        for c, v in by.items():
            df = df.where(F.col(c) == v)
        return df.agg(F.count("*").alias("n")).scalar()

    return run.metadata().select(
        rows("master").alias("master_rows"), rows("delinquent").alias("late_rows"), rows("split", is_test=0).alias("training_rows"),
        rows("split", is_test=1).alias("test_rows"), rows("scores").alias("scored_rows"), rows("thresholds").alias("thresholds"),
        F.size("benchmark_comparison").cast("long").alias("models"))


@query("batch_metadata")
def batch_metadata(i):
    """The description of the run: sizes, scores of all models, threshold, features, drivers."""
    return _batch(i).metadata()


_SCORED_SQL = """
SELECT {key}, round(p, 6) AS p, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS recoverable_std,
  CASE WHEN p >= 0.175e0 THEN 1 ELSE 0 END AS recoverable_opt, round(least(greatest((1e0 - p)*100e0, 1e0), 99e0), 4) AS risk_pct,
  round(outstanding_principal*(1e0 - settlement_discount_pct/100e0)*p, 2) AS expected_yield,
  CASE WHEN p >= 0.75e0 THEN 'A' WHEN p >= 0.5e0 THEN 'B' WHEN p >= 0.175e0 THEN 'C' ELSE 'D' END AS grade,
  CASE WHEN p >= 0.75e0 THEN 'Digital Automation & Self-Curative AI Links' WHEN p >= 0.5e0 THEN 'Tele-Counseling & Term Restructuring'
    WHEN p >= 0.175e0 THEN 'Field Visit & Standardized Haircut'
    ELSE 'Immediate Legal Escalation / Debt Recovery Tribunal' END AS strategy FROM {source}"""
_SCORED = ["p", "recoverable_std", "recoverable_opt", "risk_pct", "expected_yield", "grade", "strategy"]


@query("batch_score", ["scores"], _SCORED_SQL.format(key="loan_id", source="scores"))
def batch_score(i):
    return rounded(scoring.batch_score(i.late_book).select("loan_id", *_SCORED), 6, risk_pct=4, expected_yield=2)


@query("score_scenarios", ["scores"], _SCORED_SQL.format(key="scenario", source="cases"), extra={"cases": """
SELECT CAST(loan_id AS VARCHAR) AS scenario, p, outstanding_principal, settlement_discount_pct FROM scores
UNION ALL SELECT scenario, least(greatest(0.45e0 + (s - 600)*0.0012e0 - (d - 40)*0.001e0 + k*0.25e0, 0.05e0), 0.95e0), b, h
FROM (VALUES ('A', 740, 32, 1, 21000e0, 5e0), ('B', 635, 68, 0, 16200e0, 15e0), ('C', 490, 180, 0, 17800e0, 25e0))
  AS v(scenario, s, d, k, b, h)"""})
def score_scenarios(i):
    """The three reference borrowers scored together with the whole delinquent book."""
    book = i.late_book.select(F.col("loan_id").cast("string").alias("scenario"), "credit_score", "overdue_days",
                              "promise_to_pay_kept", "outstanding_principal", "settlement_discount_pct")
    return rounded(scoring.score_scenarios(book).select("scenario", *_SCORED), 6, risk_pct=4, expected_yield=2)


# Fixed coefficients of a linear score, for the explanation queries.
COEFFICIENTS = {"credit_score": 0.0012, "overdue_days": -0.001, "promise_to_pay_kept": 0.25, "contact_attempts": -0.004,
                "interest_rate": -0.003, "age": 0.001, "existing_debts_count": -0.01}


def _explained(i):
    return explain.attribution_linear(i.late_book, COEFFICIENTS, "loan_id")


_LONG = {"long": "\nUNION ALL\n".join(
    f"SELECT loan_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {w}e0*({c} - (SELECT AVG({c}) FROM late_book)) AS contribution FROM late_book"
    for c, w in COEFFICIENTS.items())}


@query("attribution_linear", ["late_book"], """
SELECT loan_id, feature, round(value, 4) AS value, round(contribution, 6) AS contribution FROM long""", extra=_LONG)
def attribution_linear(i):
    return rounded(explain.long_form(_explained(i), "loan_id"), 6, value=4)


@query("global_attribution", ["late_book"], """
SELECT feature, round(AVG(abs(contribution)), 6) AS mean_abs FROM long GROUP BY feature ORDER BY AVG(abs(contribution)) DESC LIMIT 15""",
       extra=_LONG)
def global_attribution(i):
    return rounded(explain.global_attribution(_explained(i), "loan_id"), 6)


_RANKED = {**_LONG, "ranked": """
SELECT loan_id, feature, contribution, CASE WHEN contribution > 0 THEN 'positive' ELSE 'negative' END AS direction,
  row_number() OVER (PARTITION BY loan_id, contribution > 0 ORDER BY abs(contribution) DESC, feature) AS rank
FROM long WHERE contribution <> 0"""}


@query("local_drivers", ["late_book"], """
SELECT loan_id, direction, CAST(rank AS INT) AS rank, feature, round(contribution, 6) AS contribution FROM ranked WHERE rank <= 5""",
       extra=_RANKED)
def local_drivers(i):
    return rounded(explain.local_drivers(_explained(i), "loan_id"), 6)


@query("attribution_points", ["late_book"], """
SELECT loan_id, feature, round(value, 4) AS value, round(contribution, 6) AS contribution FROM long WHERE feature IN (
  SELECT feature FROM long GROUP BY feature ORDER BY AVG(abs(contribution)) DESC LIMIT 4)""", extra=_LONG)
def attribution_points(i):
    """All points of the four strongest features."""
    return rounded(explain.attribution_points(_explained(i), "loan_id", 4), 6, value=4)


@query("adverse_action_reasons", ["late_book", "scores"], """
SELECT r.loan_id, CAST(r.rank AS INT) AS reason_no, r.feature, CASE r.feature
  WHEN 'overdue_days' THEN 'Number of consecutive days past due' WHEN 'promise_to_pay_kept' THEN 'Broken promise-to-pay commitments'
  WHEN 'credit_score' THEN 'Low bureau credit score' WHEN 'contact_attempts' THEN 'Repeated unsuccessful contact attempts'
  ELSE r.feature END AS reason
FROM ranked r JOIN scores s ON s.loan_id = r.loan_id WHERE s.p < 0.175e0 AND r.direction = 'negative' AND r.rank <= 3""", extra=_RANKED)
def adverse_action_reasons(i):
    return explain.adverse_action_reasons(_explained(i), i.scores, "loan_id")


@query("attribution_tree")
def attribution_tree(i):
    """Long-form contributions of the depth-5 booster for every test account."""
    out = explain.attribution_tree(_model(i, "gbt_depth5"), _split(i)[1], "loan_id")
    return explain.long_form(out, "loan_id")
