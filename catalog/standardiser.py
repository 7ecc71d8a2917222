"""Queries: tables under foreign column names through the standardiser."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.operators import standardize as S
from arrearium.functions import expressions as X
from catalog.registry import query, rounded


def _u1(i):
    """Foreign names, blanks in a name, salary as text that is sometimes unreadable."""
    salary = F.when(F.col("employment_length_years").isNull(), "n/a").otherwise(
        X.round_to("annual_income", 2).cast("string"))
    return i.book.select("loan_id", F.col("loan_amount").alias("loan_amt"), F.col("credit_score").alias("FICO_Score"),
                         F.col("overdue_days").alias(" DPD "), salary.alias("salary"))


@query("standardize_columns", ["book"], """
SELECT loan_id, round(loan_amount, 2) AS loan_amount, credit_score, overdue_days,
  CASE WHEN employment_length_years IS NULL THEN 1 ELSE 0 END AS unreadable FROM book""")
def standardize_columns(i):
    out = S.standardize_columns(_u1(i))
    return rounded(out.select("loan_id", "loan_amount", "credit_score", "overdue_days",
                              (F.col("annual_income") == "n/a").cast("int").alias("unreadable")), 2)


@query("coerce_numeric", ["book"], """
SELECT loan_id, CASE WHEN employment_length_years IS NULL THEN 60000e0 ELSE round(annual_income, 2) END AS annual_income,
  overdue_days FROM book""")
def coerce_numeric(i):
    return S.coerce_numeric(S.standardize_columns(_u1(i))).select("loan_id", "annual_income", "overdue_days")


@query("default_missing_columns", ["loans"], """
SELECT loan_id, loan_type, loan_amount, 60000e0 AS annual_income, 0 AS overdue_days, 0e0 AS recovery_cost,
  'General' AS region, 'Tele-Calling & Counseling' AS primary_channel FROM loans""")
def default_missing_columns(i):
    out = S.default_missing_columns(i.loans)
    return out.select("loan_id", "loan_type", "loan_amount", "annual_income", "overdue_days", "recovery_cost",
                      "region", "primary_channel")


@query("annualize_income", ["customers"], """
SELECT customer_id, round(CASE WHEN (SELECT quantile_cont(annual_income/12e0, 0.5) FROM customers) > 500
    AND (SELECT quantile_cont(annual_income/12e0, 0.5) FROM customers) < 12000
  THEN annual_income/12e0*12e0 ELSE annual_income/12e0 END, 2) AS annual_income FROM customers""")
def annualize_income(i):
    monthly = i.customers.select("customer_id", (F.col("annual_income") / 12.0).alias("annual_income"))
    return rounded(S.annualize_income(monthly), 2)


@query("synthesize_credit_score", ["repayments"], """
SELECT loan_id, round(least(greatest(720 - overdue_days*1.2e0, 350e0), 850e0), 0) AS credit_score FROM repayments""")
def synthesize_credit_score(i):
    return S.synthesize_credit_score(i.repayments).select("loan_id", "credit_score")


def _flag_query(key, needs, sql, project):
    @query(key, needs, sql)
    def run(i):
        return S.derive_recovery_flag(project(i)).select("loan_id", "recovery_status_binary")


_STATUS_SQL = """
SELECT loan_id, CASE WHEN lower(recovery_status) LIKE '%fully%' OR lower(recovery_status) LIKE '%partially%'
  OR lower(recovery_status) LIKE '%recovered%' OR lower(recovery_status) LIKE '%resolved%'
  OR lower(recovery_status) LIKE '%paid%' OR lower(recovery_status) LIKE '%closed%'
  OR lower(recovery_status) LIKE '%settled%' THEN 1 ELSE 0 END AS recovery_status_binary FROM book"""
_flag_query("derive_recovery_flag", ["book"], _STATUS_SQL, lambda i: i.book.select("loan_id", "recovery_status"))
_flag_query("derive_recovery_flag_target_binary", ["book"], """
SELECT loan_id, CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1 ELSE 0 END
  AS recovery_status_binary FROM book""",
            lambda i: i.book.select("loan_id", "recovery_status",
                                    X.recovery_target("recovery_status").alias("recovery_target_binary")))
_flag_query("derive_recovery_flag_target", ["book"], """
SELECT loan_id, CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1 ELSE 0 END
  AS recovery_status_binary FROM book""",
            lambda i: i.book.select("loan_id", X.recovery_label("recovery_status").cast("string").alias("recovery_target")))
_flag_query("derive_recovery_flag_history", ["book"], """
SELECT loan_id, CASE WHEN overdue_days <= 60 THEN 1 ELSE 0 END AS recovery_status_binary FROM book""",
            lambda i: i.book.select("loan_id", F.when(F.col("overdue_days") == 0, "Good standing")
                                    .when(F.col("overdue_days") <= 30, "On-Time mostly")
                                    .when(F.col("overdue_days") <= 60, "RESOLVED late")
                                    .when(F.col("overdue_days") > 90, "bad").alias("repayment_history")))
_flag_query("derive_recovery_flag_response", ["book"], """
SELECT loan_id, CASE WHEN promise_to_pay_kept = 1 OR overdue_days <= 30 THEN 1 ELSE 0 END
  AS recovery_status_binary FROM book""",
            lambda i: i.book.select("loan_id", F.when(F.col("promise_to_pay_kept") == 1, "Promised and kept")
                                    .when(F.col("overdue_days") <= 30, "cooperative").otherwise("silent")
                                    .alias("customer_response")))
_flag_query("derive_recovery_flag_default", ["repayments"],
            "SELECT loan_id, 1 - default_flag AS recovery_status_binary FROM repayments",
            lambda i: i.repayments.select("loan_id", "default_flag"))
_flag_query("derive_recovery_flag_loyal", ["book"], """
SELECT loan_id, CASE WHEN employment_length_years IS NULL THEN 1 WHEN employment_length_years > 8 THEN 1 ELSE 0 END
  AS recovery_status_binary FROM book""",
            lambda i: i.book.select("loan_id", (F.col("employment_length_years") > 8).cast("int").alias("loyal_customer")))


@query("logistic_recovery_rule", ["book"], """
SELECT loan_id, CASE WHEN 1e0/(1e0 + exp(-((credit_score - 620)/60e0 - (overdue_days - 30)/45e0))) >= 0.5e0
  THEN 1 ELSE 0 END AS recovery_status_binary FROM book""")
def logistic_recovery_rule(i):
    return S.derive_recovery_flag(i.book.select("loan_id", "credit_score", "overdue_days")).select(
        "loan_id", "recovery_status_binary")


@query("derive_recovered_amount", ["book"], """
SELECT loan_id, round(CASE WHEN default_flag = 0 THEN loan_amount * (0.6e0 + 0.35e0 *
  (CAST('0x' || substr(md5(CAST(loan_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0)) ELSE 0e0 END, 2)
  AS recovered_amount FROM book""")
def derive_recovered_amount(i):
    flagged = S.derive_recovery_flag(i.book.select("loan_id", "loan_amount", "default_flag"))
    return S.derive_recovered_amount(flagged, "loan_id").select("loan_id", "recovered_amount")


@query("derive_recovered_amount_spending", ["customers"], """
SELECT customer_id, CASE WHEN housing_status IS NULL THEN 0e0 ELSE round(annual_income/100e0, 2) END AS recovered_amount
FROM customers""")
def derive_recovered_amount_spending(i):
    spend = i.customers.select("customer_id", F.when(F.col("housing_status").isNotNull(), X.round_to(
        F.col("annual_income") / 100.0, 2)).alias("monthly_spending"))
    return S.derive_recovered_amount(spend).select("customer_id", "recovered_amount")


@query("derive_default_flag", ["repayments"], """
SELECT loan_id, CASE WHEN overdue_days > 90 THEN 1 ELSE 0 END AS default_flag FROM repayments""")
def derive_default_flag(i):
    return S.derive_default_flag(i.repayments.select("loan_id", "delinquency_bucket")).select("loan_id", "default_flag")


@query("derive_default_flag_days", ["repayments"], """
SELECT loan_id, CASE WHEN overdue_days > 90 THEN 1 ELSE 0 END AS default_flag FROM repayments""")
def derive_default_flag_days(i):
    return S.derive_default_flag(i.repayments.select("loan_id", "overdue_days")).select("loan_id", "default_flag")


@query("standardize_dataset", ["book"], """
SELECT loan_id, round(loan_amount, 2) AS loan_amount,
  CASE WHEN employment_length_years IS NULL THEN 60000e0 ELSE round(annual_income, 2) END AS annual_income,
  CAST(credit_score AS DOUBLE) AS credit_score, overdue_days, 12.5e0 AS interest_rate, 36 AS loan_term_months,
  CASE WHEN 1e0/(1e0 + exp(-((credit_score - 620)/60e0 - (overdue_days - 30)/45e0))) >= 0.5e0 THEN 1 ELSE 0 END
    AS recovery_status_binary,
  round(CASE WHEN 1e0/(1e0 + exp(-((credit_score - 620)/60e0 - (overdue_days - 30)/45e0))) >= 0.5e0
    THEN loan_amount * (0.6e0 + 0.35e0 * (CAST('0x' || substr(md5(CAST(loan_id AS VARCHAR)), 1, 8) AS BIGINT)
      / 4294967296e0)) ELSE 0e0 END, 2) AS recovered_amount,
  CASE WHEN overdue_days > 90 THEN 1 ELSE 0 END AS default_flag, 0e0 AS recovery_cost,
  round(loan_amount, 2) AS outstanding_principal, 'Personal Loan' AS loan_type, 'General' AS region,
  'Tele-Calling & Counseling' AS primary_channel FROM book""")
def standardize_dataset(i):
    return rounded(S.standardize_dataset(_u1(i), key="loan_id"), 2)


@query("standardize_dataset_churn", ["customers"], """
SELECT customer_id, age, gender, round(annual_income, 2) AS annual_income, 25000e0 AS loan_amount,
  680e0 AS credit_score, 12.5e0 AS interest_rate, 36 AS loan_term_months, 0 AS overdue_days, 0e0 AS recovery_cost,
  CASE WHEN employment_length_years IS NULL THEN 1 WHEN employment_length_years > 8 THEN 1 ELSE 0 END
    AS recovery_status_binary,
  CASE WHEN housing_status IS NULL THEN 0e0 ELSE round(annual_income/100e0, 2) END AS recovered_amount,
  0 AS default_flag, 25000e0 AS outstanding_principal, 'Personal Loan' AS loan_type, region,
  'Tele-Calling & Counseling' AS primary_channel FROM customers""")
def standardize_dataset_churn(i):
    """A customer table without loans: city becomes region, spending the recovered amount."""
    up = i.customers.select(
        "customer_id", "age", "gender", F.col("region").alias("city"), X.round_to("annual_income", 2).alias("annual_income"),
        F.when(F.col("housing_status").isNotNull(), X.round_to(F.col("annual_income") / 100.0, 2)).alias("monthly_spending"),
        (F.col("employment_length_years") > 8).cast("int").alias("loyal_customer"))
    return S.standardize_dataset(up).drop("monthly_spending", "loyal_customer")
