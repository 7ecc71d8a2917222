"""Metrics over a (label, p) table of any size.

Everything that needs an order works on one row per distinct score, never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.functions import expressions as X
from arrearium.operators.reports import sample_rows
from arrearium.operators.stats import running_totals


def confusion_matrix(scores: DataFrame, threshold: float = 0.5, label: str = "label", p: str = "p") -> DataFrame:
    """Four rows (actual, predicted, n), empty cells included."""
    hit = F.col(p) >= threshold
    cells = [(a, q, f"n_{a}{q}") for a in (0, 1) for q in (0, 1)]
    stats = scores.agg(*[F.count_if((F.col(label) == a) & (hit if q else ~hit)).alias(n) for a, q, n in cells])
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(q).alias("predicted"), F.col(n).alias("n"))
            for a, q, n in cells]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and zero where undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2.0 * precision * recall, precision + recall)


def metric_columns(label: Column, predicted: Column) -> list[Column]:
    """Aggregates n, accuracy, precision, recall, f1 for one boolean prediction."""
    tp = F.count_if(predicted & (label == 1))
    fp = F.count_if(predicted & (label == 0))
    fn = F.count_if(~predicted & (label == 1))
    tn = F.count_if(~predicted & (label == 0))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    n = tp + fp + fn + tn
    return [n.alias("n"), _ratio(tp + tn, n).alias("accuracy"), precision.alias("precision"),
            recall.alias("recall"), _f1(precision, recall).alias("f1")]


def classification_metrics(scores: DataFrame, threshold: float = 0.5, label: str = "label", p: str = "p") -> DataFrame:
    return scores.agg(*metric_columns(F.col(label), F.col(p) >= threshold))


def score_counts(scores: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Positives and negatives per distinct score: counted map-side, so a common score is no hot key."""
    known = scores.where(F.col(p).isNotNull() & F.col(label).isNotNull())
    # count(when(..)) rather than count_if, whose plan gets a new column name each time it is built
    # into a query: with equal names the several uses of these counts share one exchange.
    return known.groupBy(F.col(p).alias("p")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))


def _ranked(scores: DataFrame, label: str, p: str) -> DataFrame:
    return running_totals(score_counts(scores, label, p), "p", ["pos", "neg"])


def roc_auc(scores: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half; NULL for one class."""
    r = _ranked(scores, label, p)
    above = F.col("upto_pos") - F.col("pos")
    won = F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return r.agg(F.when(pairs > 0, won / pairs).alias("roc_auc"))


def pr_auc(scores: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """Average precision: precision at each score, weighted by the recall gained there."""
    r = _ranked(scores, label, p)
    precision = F.col("upto_pos") / (F.col("upto_pos") + F.col("upto_neg"))
    total = F.sum("pos")
    return r.agg(F.when(total > 0, F.sum(precision * F.col("pos")) / total).alias("pr_auc"))


def score_report(scores: DataFrame, threshold: float = 0.5, label: str = "label", p: str = "p") -> DataFrame:
    """One row with every classification measure, from one table of counts per distinct score."""
    r = _ranked(scores, label, p)
    hit = F.col("p") >= threshold
    tp = F.sum(F.when(hit, F.col("pos")).otherwise(0))
    fp = F.sum(F.when(hit, F.col("neg")).otherwise(0))
    pos, neg = F.sum("pos"), F.sum("neg")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, pos)
    above = F.col("upto_pos") - F.col("pos")
    won = F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos") / 2.0))
    gained = F.sum(F.col("upto_pos") / (F.col("upto_pos") + F.col("upto_neg")) * F.col("pos"))
    return r.agg(
        (pos + neg).alias("n"), _ratio(tp + neg - fp, pos + neg).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), _f1(precision, recall).alias("f1"),
        F.try_divide(won, pos.cast("double") * neg.cast("double")).alias("roc_auc"),
        F.try_divide(gained, pos).alias("pr_auc"))


def roc_pr_curves(scores: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """One point per distinct score: threshold, fpr, tpr (= recall), precision."""
    r = _ranked(scores, label, p)
    return r.select(
        F.col("p").alias("threshold"),
        F.try_divide(F.col("upto_neg"), F.col("total_neg")).alias("fpr"),
        F.try_divide(F.col("upto_pos"), F.col("total_pos")).alias("tpr"),
        (F.col("upto_pos") / (F.col("upto_pos") + F.col("upto_neg"))).alias("precision"))


def threshold_sweep(scores: DataFrame, label: str = "label", p: str = "p") -> DataFrame:
    """recall, precision and f1 at the 33 thresholds 0.100 ... 0.900.

    Rows are reduced to counts per number of thresholds passed (at most 34), so one pass serves
    all thresholds.
    """
    steps = [(4 + i) / 40.0 for i in range(33)]
    passed = F.lit(0)
    for t in steps:
        passed = passed + (F.col(p) >= t).cast("int")
    cells = scores.where(F.col(p).isNotNull() & F.col(label).isNotNull()).groupBy(passed.alias("passed")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    aggs = [F.sum("pos").alias("total_pos")]
    for i in range(33):
        hit = F.col("passed") > i
        aggs += [F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                 F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    rows = [F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                     F.col("total_pos")) for i, t in enumerate(steps)]
    flat = cells.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    recall, precision = _ratio(F.col("tp"), F.col("total_pos")), _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return flat.select("threshold", recall.alias("recall"), precision.alias("precision"),
                       _f1(precision, recall).alias("f1"))


def optimal_threshold(sweep: DataFrame, min_recall: float = 0.80) -> DataFrame:
    """Best f1 among thresholds with enough recall, else best f1; lowest threshold on ties."""
    fits = (F.col("recall") >= min_recall).cast("int")
    return sweep.orderBy(fits.desc(), F.desc("f1"), "threshold").limit(1)


def regression_metrics(preds: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Mean absolute error and R² = 1 - SSE/SST; SST comes from the population variance."""
    a, q = F.col(actual).cast("double"), F.col(predicted).cast("double")
    known = preds.where(a.isNotNull() & q.isNotNull())
    error = F.avg((a - q) * (a - q))
    return known.agg(F.avg(F.abs(a - q)).alias("mae"), (1 - F.try_divide(error, F.var_pop(a))).alias("r2"))


def predicted_vs_actual(preds: DataFrame, n: int, key: str) -> DataFrame:
    return sample_rows(preds, n, key)


def risk_band_counts(scores: DataFrame, p: str = "p") -> DataFrame:
    banded = scores.select(X.risk_score_band(p).alias("risk_band")).where(F.col("risk_band").isNotNull())
    return banded.groupBy("risk_band").agg(F.count("*").alias("n_accounts"))
