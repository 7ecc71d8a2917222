"""Queries: filters, projections and scalar rules, row by row over the whole book."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators import clean, reports
from arrearium.plans.master import filter_delinquent
from catalog.registry import query, rounded


@query("filter_delinquent", ["repayments"], "SELECT loan_id, overdue_days FROM repayments WHERE overdue_days > 30")
def filter_delinquent_(i):
    return filter_delinquent(i.repayments.select("loan_id", "overdue_days"))


@query("portfolio_filter", ["book"], """
SELECT loan_id, loan_type, overdue_days FROM book
WHERE loan_type IN ('Auto Loan', 'Home Loan') AND overdue_days <= 120
  AND (CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1 ELSE 0 END) = 1""")
def portfolio_filter(i):
    book = i.book.withColumn("recovery_status_binary", X.recovery_label("recovery_status"))
    out = reports.portfolio_filter(book, ["Auto Loan", "Home Loan"], 120, 1)
    return out.select("loan_id", "loan_type", "overdue_days")


@query("select_by_dtype", ["repayments"], """
SELECT total_installments_due, installments_paid, total_amount_paid, principal_paid, interest_paid, overdue_days
FROM repayments""")
def select_by_dtype(i):
    exclude = fv.NON_FEATURE_COLUMNS + fv.TARGET_COLUMNS
    return clean.select_by_dtype(i.repayments, "numeric", exclude)


@query("filter_settled", ["late_book"], """
SELECT loan_id, round(settlement_discount_pct, 4) AS settlement_discount_pct FROM late_book
WHERE settlement_discount_pct > 0""")
def filter_settled(i):
    return rounded(reports.filter_settled(i.late_book).select("loan_id", "settlement_discount_pct"))


@query("impute_constants", ["loan_rows"], """
SELECT loan_id, recovery_status, primary_channel, recovery_officer_id, officer_name, officer_designation,
  contact_attempts, promise_to_pay_kept, settlement_discount_pct, recovered_amount, recovery_cost FROM loan_rows""")
def impute_constants(i):
    out = i.loans.select("loan_id").join(i.repayments.select("loan_id"), "loan_id")
    out = out.join(i.recovery.drop("customer_id"), "loan_id", "left")
    return clean.impute_constants(out).select("loan_id", *fv.NO_RECOVERY_DEFAULTS)


@query("parse_dates", ["loans", "repayments"], """
SELECT l.loan_id, l.disbursement_date, p.last_payment_date, p.default_date
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id""")
def parse_dates(i):
    """Dates go out as text, some of it unreadable, and come back parsed."""
    text = i.loans.select("loan_id", F.col("disbursement_date").cast("string")).join(i.repayments.select(
        "loan_id", F.col("last_payment_date").cast("string"),
        F.coalesce(F.col("default_date").cast("string"), F.lit("n/a")).alias("default_date")), "loan_id")
    return text.withColumns({c: X.parse_date(c) for c in ("disbursement_date", "last_payment_date", "default_date")})


@query("vintage_cohort", ["loans"], """
SELECT loan_id, CAST(year(disbursement_date) AS INT) AS vintage_year,
  CAST(year(disbursement_date) AS VARCHAR) || 'Q' || CAST(quarter(disbursement_date) AS VARCHAR) AS vintage_quarter
FROM loans""")
def vintage_cohort(i):
    return i.loans.select("loan_id", X.vintage_year("disbursement_date").alias("vintage_year"),
                          X.vintage_quarter("disbursement_date").alias("vintage_quarter"))


@query("outstanding_principal", ["loan_rows"], "SELECT loan_id, outstanding_principal FROM loan_rows")
def outstanding_principal(i):
    return i.loans.join(i.repayments.drop("customer_id"), "loan_id").select(
        "loan_id", X.outstanding_principal("loan_amount", "principal_paid").alias("outstanding_principal"))


EMI_SQL = """loan_amount * ((interest_rate/100e0/12e0) * pow(1 + interest_rate/100e0/12e0, loan_term_months))
  / (pow(1 + interest_rate/100e0/12e0, loan_term_months) - 1)"""


@query("monthly_emi", ["loans"], f"SELECT loan_id, round({EMI_SQL}, 2) AS monthly_emi FROM loans")
def monthly_emi(i):
    emi = X.monthly_emi("loan_amount", "interest_rate", "loan_term_months")
    return i.loans.select("loan_id", X.round_to(emi, 2).alias("monthly_emi"))


@query("clip_value", ["loans"], """
SELECT loan_id, least(greatest(loan_amount, 50000e0), 200000e0) AS clipped_amount,
  CASE WHEN collateral_value IS NULL THEN NULL ELSE least(greatest(collateral_value, 1e0), 300000e0) END
    AS clipped_collateral FROM loans""")
def clip_value(i):
    return i.loans.select("loan_id", X.clip("loan_amount", 50000.0, 200000.0).alias("clipped_amount"),
                          X.clip("collateral_value", 1.0, 300000.0).alias("clipped_collateral"))


@query("dti_ratio", ["customers", "loans"], f"""
SELECT loan_id, round(12 * ({EMI_SQL}) / NULLIF(annual_income, 0), 4) AS dti_ratio
FROM loans l JOIN customers c ON c.customer_id = l.customer_id""")
def dti_ratio(i):
    both = i.loans.join(i.customers.select("customer_id", "annual_income"), "customer_id")
    emi = X.monthly_emi("loan_amount", "interest_rate", "loan_term_months")
    return both.select("loan_id", X.round_to(X.dti_ratio(emi, "annual_income"), 4).alias("dti_ratio"))


@query("dti_simple", ["customers", "loans"], """
SELECT loan_id, round(loan_amount*0.35e0 / greatest(annual_income, 1000e0), 4) AS dti_simple
FROM loans l JOIN customers c ON c.customer_id = l.customer_id""")
def dti_simple(i):
    both = i.loans.join(i.customers.select("customer_id", "annual_income"), "customer_id")
    return both.select("loan_id", X.round_to(X.dti_simple("loan_amount", "annual_income"), 4).alias("dti_simple"))


@query("ltv_ratio", ["loans"], """
SELECT loan_id, CASE WHEN collateral_type IS NULL OR collateral_type = 'None' THEN 0 ELSE 1 END AS is_secured,
  round(CASE WHEN collateral_type IS NULL OR collateral_type = 'None' THEN 1e0
    ELSE least(greatest(loan_amount / greatest(coalesce(collateral_value, 0e0), 1e0), 0.1e0), 1.5e0) END, 4) AS ltv_ratio
FROM loans""")
def ltv_ratio(i):
    out = i.loans.withColumn("is_secured", X.is_secured("collateral_type"))
    return out.select("loan_id", "is_secured", X.round_to(
        X.ltv_ratio("loan_amount", "collateral_value", "is_secured"), 4).alias("ltv_ratio"))


@query("delinquency_severity", ["book"], """
SELECT loan_id, round(least(greatest((overdue_days/360e0)*60 + (1 - credit_score/850e0)*40, 0e0), 100e0), 4)
  AS delinquency_severity_score FROM book""")
def delinquency_severity(i):
    return i.book.select("loan_id", X.round_to(
        X.delinquency_severity("overdue_days", "credit_score"), 4).alias("delinquency_severity_score"))


@query("severity_index", ["book"], """
SELECT loan_id, round(least(1e0, overdue_days/90e0*0.5e0 + (1 - promise_to_pay_kept)*0.3e0
  + (loan_amount*0.35e0/greatest(annual_income, 1000e0))/0.6e0*0.2e0), 4) AS severity_index FROM book""")
def severity_index(i):
    index = X.severity_index("overdue_days", "promise_to_pay_kept", X.dti_simple("loan_amount", "annual_income"))
    return i.book.select("loan_id", X.round_to(index, 4).alias("severity_index"))


@query("credit_risk_tier", ["customers"], """
SELECT customer_id, credit_score, CASE WHEN credit_score <= 0 THEN NULL
  WHEN credit_score <= 549 THEN 'Deep Subprime (<550)' WHEN credit_score <= 649 THEN 'Subprime (550-649)'
  WHEN credit_score <= 699 THEN 'Near-Prime (650-699)' WHEN credit_score <= 749 THEN 'Prime (700-749)'
  WHEN credit_score <= 900 THEN 'Super-Prime (750+)' END AS credit_risk_tier FROM customers""")
def credit_risk_tier(i):
    return i.customers.select("customer_id", "credit_score", X.credit_risk_tier("credit_score").alias("credit_risk_tier"))


@query("delinquency_bucket", ["repayments"], "SELECT loan_id, overdue_days, delinquency_bucket FROM repayments")
def delinquency_bucket(i):
    return i.repayments.select("loan_id", "overdue_days", X.delinquency_bucket("overdue_days").alias("delinquency_bucket"))


@query("net_and_rate", ["book"], """
SELECT loan_id, round(recovered_amount - recovery_cost, 2) AS net_recovery_amount,
  round(CASE WHEN outstanding_principal > 0
    THEN least(greatest(recovered_amount/outstanding_principal*100e0, 0e0), 100e0) ELSE 0e0 END, 2) AS recovery_rate_pct
FROM book""")
def net_and_rate(i):
    return i.book.select(
        "loan_id", X.round_to(X.net_recovery("recovered_amount", "recovery_cost"), 2).alias("net_recovery_amount"),
        X.round_to(X.recovery_rate_pct("recovered_amount", "outstanding_principal"), 2).alias("recovery_rate_pct"))


@query("recovery_target", ["book"], """
SELECT loan_id, recovery_status, CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1
  WHEN recovery_status IN ('Written Off', 'Legal Escalation', 'In Progress') THEN 0 END AS recovery_target_binary,
  CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1 ELSE 0 END AS recovery_target
FROM book""")
def recovery_target(i):
    return i.book.select("loan_id", "recovery_status", X.recovery_target("recovery_status").alias("recovery_target_binary"),
                         X.recovery_label("recovery_status").alias("recovery_target"))


@query("risk_grade", ["scores"], """
SELECT loan_id, CASE WHEN p >= 0.75e0 THEN 'A' WHEN p >= 0.5e0 THEN 'B' WHEN p >= 0.175e0 THEN 'C' ELSE 'D' END AS grade,
  CASE WHEN p >= 0.75e0 THEN 'Low Risk (Grade A - High Recovery)' WHEN p >= 0.5e0 THEN 'Moderate Risk (Grade B - Restructure)'
    WHEN p >= 0.175e0 THEN 'Elevated Risk (Grade C - Targeted Intervention)'
    ELSE 'Critical Risk (Grade D - Unrecoverable / NPA)' END AS label,
  CASE WHEN p >= 0.75e0 THEN 'Digital Automation & Self-Curative AI Links' WHEN p >= 0.5e0 THEN 'Tele-Counseling & Term Restructuring'
    WHEN p >= 0.175e0 THEN 'Field Visit & Standardized Haircut'
    ELSE 'Immediate Legal Escalation / Debt Recovery Tribunal' END AS strategy FROM scores""")
def risk_grade(i):
    return i.scores.select("loan_id", X.risk_grade("p").alias("g")).select("loan_id", "g.*")


@query("risk_score_band", ["scores"], """
SELECT loan_id, CASE WHEN (1 - p)*100e0 <= 30 THEN '🟢 Low Risk (Grade A)' WHEN (1 - p)*100e0 <= 55 THEN '🟡 Moderate Risk (Grade B)'
  WHEN (1 - p)*100e0 <= 75 THEN '🟠 High Risk (Grade C)' ELSE '🔴 Critical / NPA (Grade D)' END AS risk_band FROM scores""")
def risk_score_band(i):
    return i.scores.select("loan_id", X.risk_score_band("p").alias("risk_band"))


@query("expected_yield", ["scores"], """
SELECT loan_id, round(outstanding_principal*(1e0 - settlement_discount_pct/100e0)*p, 2) AS expected_yield,
  round(least(greatest((1e0 - p)*100e0, 1e0), 99e0), 6) AS risk_pct FROM scores""")
def expected_yield(i):
    y = X.expected_yield("outstanding_principal", "settlement_discount_pct", "p")
    return i.scores.select("loan_id", X.round_to(y, 2).alias("expected_yield"), X.round_to(X.risk_pct("p"), 6).alias("risk_pct"))


@query("rule_score", ["scores"], "SELECT loan_id, round(p, 6) AS p FROM scores")
def rule_score(i):
    return rounded(i.scores.select("loan_id", "p"), 6)


@query("officer_first_name", ["recovery_activities"], """
SELECT DISTINCT officer_name, split_part(officer_name, ' ', 1) AS first_name FROM recovery_activities""")
def officer_first_name(i):
    return i.recovery.select("officer_name", X.first_word("officer_name").alias("first_name")).distinct()
