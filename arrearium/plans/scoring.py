"""Scoring whole tables of accounts, and the reference borrowers alongside them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.models import predict


def with_probability(accounts: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """p from the model, or by rule where no model is given."""
    if model is not None:
        return predict(model, accounts)
    return accounts.withColumn("p", X.rule_score("credit_score", "overdue_days", "promise_to_pay_kept"))


def batch_score(accounts: DataFrame, model: PipelineModel | None = None, threshold: float = fv.OPTIMAL_THRESHOLD,
                balance: str = "outstanding_principal", discount: str = "settlement_discount_pct") -> DataFrame:
    """Probability, both decisions, risk, expected yield, grade and strategy for every account."""
    scored = with_probability(accounts, model)
    return scored.withColumns({
        "recoverable_std": (F.col("p") >= 0.5).cast("int"),
        "recoverable_opt": (F.col("p") >= threshold).cast("int"),
        "risk_pct": X.risk_pct("p"),
        "expected_yield": X.expected_yield(balance, discount, "p"),
        "_g": X.risk_grade("p", threshold),
    }).withColumns({"grade": F.col("_g.grade"), "strategy": F.col("_g.strategy")}).drop("_g")


def scenario_accounts(spark) -> DataFrame:
    """The three reference borrowers as a table with all model inputs."""
    rows = spark.createDataFrame(fv.SCENARIOS, fv.SCENARIO_COLUMNS)
    rows = rows.withColumns({c: F.lit(v) for c, v in fv.SCENARIO_COMMON.items()})
    # the severity that models are trained on, not the 0-1 index of the entry form
    return rows.withColumn("delinquency_severity_score", X.round_to(
        X.delinquency_severity("overdue_days", "credit_score"), 2))


def score_scenarios(accounts: DataFrame, model: PipelineModel | None = None,
                    threshold: float = fv.OPTIMAL_THRESHOLD) -> DataFrame:
    """Score the three borrowers in one pass with the accounts they are to be compared with.

    accounts carries its key as text in `scenario`; other columns only as far as scoring needs them.
    """
    cases = scenario_accounts(accounts.sparkSession)
    columns = accounts.columns
    cast = cases.select(*[F.col(c).cast(accounts.schema[c].dataType).alias(c) for c in columns])
    return batch_score(accounts.unionByName(cast), model, threshold)
