"""The 57-column analytical table, one row per loan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearium.functions import expressions as X
from arrearium.operators import clean
from arrearium.operators.joins import loan_book


def clean_customers(customers: DataFrame, method: str = "exact") -> DataFrame:
    out = clean.impute_group_median(customers, "employment_length_years", ["employment_status"], 3, method)
    out = clean.impute_mode(out, ["housing_status"])
    return clean.cap_outliers_by_group(out, "annual_income", ["city_tier"], method=method)


def clean_loans(loans: DataFrame) -> DataFrame:
    out = loans
    if dict(loans.dtypes)["disbursement_date"] == "string":
        out = out.withColumn("disbursement_date", X.parse_date("disbursement_date"))
    return out.withColumns({
        "collateral_value": F.coalesce("collateral_value", F.lit(0.0)),
        "vintage_year": X.vintage_year("disbursement_date"),
        "vintage_quarter": X.vintage_quarter("disbursement_date"),
    })


def clean_repayments(repayments: DataFrame) -> DataFrame:
    kinds = dict(repayments.dtypes)
    return repayments.withColumns({
        c: X.parse_date(c) for c in ("last_payment_date", "default_date") if kinds[c] == "string"})


def derived_columns(book: DataFrame) -> DataFrame:
    """The nine engineered columns; money and scores carry 2 places, ratios 4."""
    book = book.withColumn("monthly_emi", X.round_to(
        X.monthly_emi("loan_amount", "interest_rate", "loan_term_months"), 2))
    book = book.withColumns({
        "dti_ratio": X.round_to(X.dti_ratio("monthly_emi", "annual_income"), 4),
        "is_secured": X.is_secured("collateral_type"),
    })
    return book.withColumns({
        "ltv_ratio": X.round_to(X.ltv_ratio("loan_amount", "collateral_value", "is_secured"), 4),
        "credit_risk_tier": X.credit_risk_tier("credit_score"),
        "delinquency_severity_score": X.round_to(X.delinquency_severity("overdue_days", "credit_score"), 2),
        "net_recovery_amount": X.round_to(X.net_recovery("recovered_amount", "recovery_cost"), 2),
        "recovery_rate_pct": X.round_to(X.recovery_rate_pct("recovered_amount", "outstanding_principal"), 2),
        "recovery_target_binary": X.recovery_target("recovery_status"),
    })


def build_master(customers: DataFrame, loans: DataFrame, repayments: DataFrame, recovery: DataFrame,
                 method: str = "exact") -> DataFrame:
    """Clean the four tables, join them and add the derived columns."""
    book = loan_book(clean_customers(customers, method), clean_loans(loans),
                     clean_repayments(repayments), recovery)
    return derived_columns(book)


def filter_delinquent(df: DataFrame, min_days: int = 30) -> DataFrame:
    return df.where(F.col("overdue_days") > min_days)
