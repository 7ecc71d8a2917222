"""Queries: metrics and curves over the rule score of every delinquent account."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.operators import evaluate
from catalog.registry import query, rounded

TP, FP = "COUNT(*) FILTER (p >= {t} AND label = 1)", "COUNT(*) FILTER (p >= {t} AND label = 0)"


@query("confusion_matrix", ["scores"], """
SELECT a.v AS actual, q.v AS predicted, COUNT(s.loan_id) AS n
FROM (VALUES (0), (1)) AS a(v) CROSS JOIN (VALUES (0), (1)) AS q(v)
LEFT JOIN scores s ON s.label = a.v AND (CASE WHEN s.p >= 0.5e0 THEN 1 ELSE 0 END) = q.v GROUP BY a.v, q.v""")
def confusion_matrix(i):
    return evaluate.confusion_matrix(i.scores)


@query("classification_metrics", ["scores"], """
SELECT n, round((tp + tn)/n, 6) AS accuracy, round(tp/(tp + fp), 6) AS "precision", round(tp/(tp + fn), 6) AS recall,
  round(2e0*tp/(2e0*tp + fp + fn), 6) AS f1
FROM (SELECT COUNT(*) AS n, CAST(COUNT(*) FILTER (p >= 0.5e0 AND label = 1) AS DOUBLE) AS tp,
  COUNT(*) FILTER (p >= 0.5e0 AND label = 0) AS fp, COUNT(*) FILTER (p < 0.5e0 AND label = 1) AS fn,
  CAST(COUNT(*) FILTER (p < 0.5e0 AND label = 0) AS DOUBLE) AS tn FROM scores)""")
def classification_metrics(i):
    return rounded(evaluate.classification_metrics(i.scores), 6)


_CUM = {"g": """
SELECT p, CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS pos, CAST(COUNT(*) FILTER (label = 0) AS DOUBLE) AS neg
FROM scores GROUP BY p""", "c": """
SELECT *, SUM(pos) OVER (ORDER BY p DESC) AS cp, SUM(neg) OVER (ORDER BY p DESC) AS cn,
  SUM(pos) OVER () AS tp, SUM(neg) OVER () AS tn FROM g"""}


@query("roc_auc", ["scores"], "SELECT round(SUM(neg*(cp - pos + pos/2e0))/(MIN(tp)*MIN(tn)), 8) AS roc_auc FROM c", extra=_CUM)
def roc_auc(i):
    return rounded(evaluate.roc_auc(i.scores), 8)


@query("pr_auc", ["scores"], "SELECT round(SUM(pos*(cp/(cp + cn)))/MIN(tp), 8) AS pr_auc FROM c", extra=_CUM)
def pr_auc(i):
    return rounded(evaluate.pr_auc(i.scores), 8)


@query("roc_pr_curves", ["scores"], """
SELECT round(p, 8) AS threshold, round(cn/tn, 8) AS fpr, round(cp/tp, 8) AS tpr, round(cp/(cp + cn), 8) AS "precision" FROM c""",
       extra=_CUM)
def roc_pr_curves(i):
    return rounded(evaluate.roc_pr_curves(i.scores), 8)


_SWEEP = {"sweep": """
SELECT t AS threshold, CASE WHEN pos = 0 THEN 0e0 ELSE tp/pos END AS recall,
  CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp/(tp + fp) END AS prec
FROM (SELECT t, CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS pos, CAST(COUNT(*) FILTER (p >= t AND label = 1) AS DOUBLE) AS tp,
  CAST(COUNT(*) FILTER (p >= t AND label = 0) AS DOUBLE) AS fp
  FROM scores, (SELECT (4 + unnest(range(33)))/40e0 AS t) GROUP BY t)""", "swept": """
SELECT threshold, recall, prec, CASE WHEN prec + recall = 0 THEN 0e0 ELSE 2e0*prec*recall/(prec + recall) END AS f1 FROM sweep"""}


@query("threshold_sweep", ["scores"], """
SELECT threshold, round(recall, 6) AS recall, round(prec, 6) AS "precision", round(f1, 6) AS f1 FROM swept""", extra=_SWEEP)
def threshold_sweep(i):
    return rounded(evaluate.threshold_sweep(i.scores), 6)


@query("optimal_threshold", ["scores"], """
SELECT threshold, round(recall, 6) AS recall, round(prec, 6) AS "precision", round(f1, 6) AS f1 FROM swept
ORDER BY CASE WHEN recall >= 0.8e0 THEN 0 ELSE 1 END, f1 DESC, threshold LIMIT 1""", extra=_SWEEP)
def optimal_threshold(i):
    return rounded(evaluate.optimal_threshold(evaluate.threshold_sweep(i.scores)), 6)


def _preds(i):
    """Recovered amount against the expected yield as its prediction."""
    guess = F.col("outstanding_principal") * F.col("p")
    return i.scores.join(i.recovery.select("loan_id", "recovered_amount"), "loan_id").select(
        "loan_id", F.col("recovered_amount").alias("actual"), guess.alias("predicted"))


_PREDS = {"preds": """
SELECT s.loan_id, v.recovered_amount AS actual, s.outstanding_principal*s.p AS predicted
FROM scores s JOIN recovery_activities v ON v.loan_id = s.loan_id"""}


@query("regression_metrics", ["scores"], """
SELECT round(AVG(abs(actual - predicted)), 4) AS mae,
  round(1e0 - SUM(pow(actual - predicted, 2))/(SELECT SUM(pow(actual - m, 2)) FROM preds, (SELECT AVG(actual) AS m FROM preds)), 6) AS r2
FROM preds""", extra=_PREDS)
def regression_metrics(i):
    return rounded(evaluate.regression_metrics(_preds(i)), 6, mae=4)


@query("predicted_vs_actual", ["scores"], """
SELECT loan_id, round(actual, 2) AS actual, round(predicted, 2) AS predicted FROM preds
ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id LIMIT 500""", extra=_PREDS)
def predicted_vs_actual(i):
    return rounded(evaluate.predicted_vs_actual(_preds(i), 500, "loan_id"), 2)


@query("risk_band_counts", ["scores"], """
SELECT CASE WHEN (1 - p)*100e0 <= 30 THEN '🟢 Low Risk (Grade A)' WHEN (1 - p)*100e0 <= 55 THEN '🟡 Moderate Risk (Grade B)'
  WHEN (1 - p)*100e0 <= 75 THEN '🟠 High Risk (Grade C)' ELSE '🔴 Critical / NPA (Grade D)' END AS risk_band,
  COUNT(*) AS n_accounts FROM scores GROUP BY 1""")
def risk_band_counts(i):
    return evaluate.risk_band_counts(i.scores)
