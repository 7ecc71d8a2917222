"""Queries: policy and monitoring rules, batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.functions import expressions as X
from arrearium.operators import policy
from catalog.registry import query, rounded
from catalog.scalar_rules import EMI_SQL


@query("contact_cap", ["contacts"], """
SELECT event_id, account_id, n AS contacts_in_window, CASE WHEN n > 3 THEN 1 ELSE 0 END AS over_cap
FROM (SELECT event_id, account_id, COUNT(*) OVER (PARTITION BY account_id ORDER BY contact_ts
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS n FROM contacts)""")
def contact_cap(i):
    return policy.contact_cap(i.contacts).drop("contact_ts")


@query("score_drop_alert", ["bureau_scores"], """
SELECT event_id, account_id, score, best_score, best_score - score AS score_drop,
  CASE WHEN best_score - score >= 35 THEN 1 ELSE 0 END AS alert
FROM (SELECT *, MAX(score) OVER (PARTITION BY account_id ORDER BY score_ts
  RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS best_score FROM bureau_scores)""")
def score_drop_alert(i):
    return policy.score_drop_alert(i.bureau_scores).drop("score_ts")


@query("overleverage_alert", ["customers", "loans", "repayments"], f"""
SELECT l.loan_id, round(12*({EMI_SQL})/NULLIF(annual_income, 0), 4) AS dti_ratio, overdue_days
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id JOIN customers c ON c.customer_id = l.customer_id
WHERE 12*({EMI_SQL})/NULLIF(annual_income, 0) > 0.5e0 AND overdue_days > 0""")
def overleverage_alert(i):
    dti = X.dti_ratio(X.monthly_emi("loan_amount", "interest_rate", "loan_term_months"), "annual_income")
    rows = i.book.select("loan_id", dti.alias("dti_ratio"), "overdue_days")
    return rounded(policy.overleverage_alert(rows))


@query("broken_promise_alert", ["promises"], """
SELECT event_id, account_id, kept, previous_kept, CASE WHEN kept = 0 AND previous_kept = 0 THEN 1 ELSE 0 END AS alert
FROM (SELECT *, lag(kept) OVER (PARTITION BY account_id ORDER BY promise_ts, event_id) AS previous_kept FROM promises)""")
def broken_promise_alert(i):
    return policy.broken_promise_alert(i.promises).drop("promise_ts")


@query("early_default_audit", ["loans", "repayments"], """
SELECT origination_channel, COUNT(*) AS n_loans,
  COUNT(*) FILTER (default_flag = 1 AND date_diff('day', disbursement_date, default_date) <= 90) AS n_early_defaults
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id WHERE origination_channel IS NOT NULL GROUP BY origination_channel""")
def early_default_audit(i):
    both = i.loans.select("loan_id", "origination_channel", "disbursement_date").join(
        i.repayments.select("loan_id", "default_flag", "default_date"), "loan_id")
    return policy.early_default_audit(both)


@query("contagion_flag", ["loans", "repayments"], """
SELECT l.loan_id, l.customer_id, l.loan_type FROM loans l JOIN repayments p ON p.loan_id = l.loan_id
WHERE l.loan_type <> 'Auto Loan' AND l.customer_id IN (
  SELECT a.customer_id FROM loans a JOIN repayments b ON b.loan_id = a.loan_id
  WHERE a.loan_type = 'Auto Loan' AND b.overdue_days > 30)""")
def contagion_flag(i):
    both = i.loans.select("loan_id", "customer_id", "loan_type").join(i.repayments.select("loan_id", "overdue_days"), "loan_id")
    return policy.contagion_flag(both).select("loan_id", "customer_id", "loan_type")


@query("collector_allocation", ["scores"], """
SELECT loan_id, k AS rank, CASE k WHEN 1 THEN 'AI Digital Bot & Automated WhatsApp' WHEN 2 THEN 'Inside Tele-Calling & Debt Counselor'
  WHEN 3 THEN 'Specialized Field Visit Officer' ELSE 'External Agency & Legal Recovery Counsel' END AS channel,
  CASE k WHEN 1 THEN '7 - 14 Days' WHEN 2 THEN '15 - 30 Days' WHEN 3 THEN '30 - 45 Days' ELSE '60 - 90 Days' END AS resolution_window
FROM (SELECT loan_id, greatest(CASE WHEN p >= 0.75e0 THEN 1 WHEN p >= 0.55e0 THEN 2 WHEN p >= 0.35e0 THEN 3 ELSE 4 END,
  CASE WHEN overdue_days <= 30 THEN 1 WHEN overdue_days <= 60 THEN 2 WHEN overdue_days <= 90 THEN 3 ELSE 4 END) AS k FROM scores)""")
def collector_allocation(i):
    return policy.collector_allocation(i.scores).select("loan_id", "rank", "channel", "resolution_window")


# Zones of the test data's regions.
ZONES = [("AFRICA", "Africa/Lagos"), ("AMERICA", "America/New_York"), ("ASIA", "Asia/Kolkata"),
         ("EUROPE", "Europe/Berlin"), ("MIDDLE EAST", "Asia/Dubai")]


@query("calling_window", ["contacts", "customers"], """
SELECT event_id, account_id, region, CAST(h AS INT) AS local_hour, CASE WHEN h >= 8 AND h < 21 THEN 1 ELSE 0 END AS allowed
FROM (SELECT k.event_id, k.account_id, c.region, hour((k.contact_ts AT TIME ZONE 'UTC') AT TIME ZONE (CASE c.region
    WHEN 'AFRICA' THEN 'Africa/Lagos' WHEN 'AMERICA' THEN 'America/New_York' WHEN 'ASIA' THEN 'Asia/Kolkata'
    WHEN 'EUROPE' THEN 'Europe/Berlin' WHEN 'MIDDLE EAST' THEN 'Asia/Dubai' ELSE 'UTC' END)) AS h
  FROM contacts k LEFT JOIN customers c ON c.customer_id = k.account_id)""")
def calling_window(i):
    zones = F.broadcast(i.spark.createDataFrame(ZONES, "region STRING, time_zone STRING"))
    where = i.customers.select(F.col("customer_id").alias("account_id"), "region")
    out = policy.calling_window(i.contacts.join(where, "account_id", "left"), zones)
    return out.select("event_id", "account_id", "region", "local_hour", "allowed")


@query("disparate_impact", ["scores"], """
SELECT r.attribute, r.group_value, r.n, round(r.rate, 6) AS positive_rate, round(b.rate, 6) AS baseline_rate,
  round(r.rate/NULLIF(b.rate, 0), 6) AS impact_ratio, CASE WHEN r.rate/NULLIF(b.rate, 0) >= 0.8e0 THEN 1
    WHEN r.rate/NULLIF(b.rate, 0) < 0.8e0 THEN 0 END AS passes
FROM rates r LEFT JOIN rates b ON b.attribute = r.attribute AND b.group_value =
  CASE r.attribute WHEN 'gender' THEN 'Male' WHEN 'region' THEN 'EUROPE' ELSE 'Tier 1' END""", extra={"rates": "\nUNION ALL\n".join(
    f"SELECT '{a}' AS attribute, {a} AS group_value, COUNT(*) AS n, AVG(CASE WHEN p >= 0.5e0 THEN 1e0 ELSE 0e0 END) AS rate "
    f"FROM scores WHERE {a} IS NOT NULL GROUP BY {a}" for a in ("gender", "region", "city_tier"))})
def disparate_impact(i):
    base = {"gender": "Male", "region": "EUROPE", "city_tier": "Tier 1"}
    return rounded(policy.disparate_impact(i.scores, base, F.col("p") >= 0.5), 6)


_EDGES = {"e": "SELECT quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM scores WHERE vintage_year <= 1997",
          "cells": """
SELECT len(list_filter(e.q, lambda x: x < s.p)) AS bin, CAST(COUNT(*) FILTER (vintage_year <= 1997) AS DOUBLE) AS b,
  CAST(COUNT(*) FILTER (vintage_year > 1997) AS DOUBLE) AS c FROM scores s, e GROUP BY 1""",
          "terms": """
SELECT bin, greatest(b/(SELECT SUM(b) FROM cells), 0.0001e0) AS bs, greatest(c/(SELECT SUM(c) FROM cells), 0.0001e0) AS cs FROM cells"""}


@query("population_stability", ["scores"], """
SELECT CAST(bin AS INT) AS bin, round(bs, 6) AS base_share, round(cs, 6) AS current_share, round((cs - bs)*ln(cs/bs), 6) AS psi_term
FROM terms""", extra=_EDGES)
def population_stability(i):
    """Scores of loans disbursed up to 1997 against later ones."""
    return rounded(policy.population_stability(i.scores, "p", F.col("vintage_year") <= 1997), 6)


@query("stability_index", ["scores"], """
SELECT round(SUM((cs - bs)*ln(cs/bs)), 6) AS psi, CASE WHEN SUM((cs - bs)*ln(cs/bs)) > 0.1e0 THEN 1 ELSE 0 END AS alert FROM terms""",
       extra=_EDGES)
def stability_index(i):
    terms = policy.population_stability(i.scores, "p", F.col("vintage_year") <= 1997)
    return rounded(policy.stability_index(terms), 6)


@query("error_rate_audit", ["scores"], "\nUNION ALL\n".join(f"""
SELECT '{a}' AS attribute, {a} AS group_value, COUNT(*) AS n,
  round(COUNT(*) FILTER (label = 1 AND p < 0.5e0)/NULLIF(CAST(COUNT(*) FILTER (label = 1) AS DOUBLE), 0), 6) AS false_negative_rate,
  round(COUNT(*) FILTER (label = 0 AND p >= 0.5e0)/NULLIF(CAST(COUNT(*) FILTER (label = 0) AS DOUBLE), 0), 6) AS false_positive_rate
FROM scores WHERE {a} IS NOT NULL GROUP BY {a}""" for a in ("gender", "marital_status")))
def error_rate_audit(i):
    return rounded(policy.error_rate_audit(i.scores, ["gender", "marital_status"]), 6)


@query("mask_ids", ["recovery_activities"], """
SELECT sha256(CAST(customer_id AS VARCHAR)) AS customer_id, loan_id, recovery_status, contact_attempts FROM recovery_activities""")
def mask_ids(i):
    rows = i.recovery.select("customer_id", "loan_id", "recovery_status", "contact_attempts", "officer_name")
    return policy.mask_ids(rows)


@query("sourcing_quality", ["loans", "repayments"], """
SELECT origination_channel, n_loans, round(r, 6) AS default_rate,
  round(percent_rank() OVER (ORDER BY r DESC), 6) AS rank_share,
  CASE WHEN percent_rank() OVER (ORDER BY r DESC) < 0.1e0 THEN 1 ELSE 0 END AS flagged
FROM (SELECT origination_channel, COUNT(*) AS n_loans, AVG(default_flag) AS r
  FROM loans l JOIN repayments p ON p.loan_id = l.loan_id WHERE origination_channel IS NOT NULL GROUP BY origination_channel)""")
def sourcing_quality(i):
    both = i.loans.select("loan_id", "origination_channel").join(i.repayments.select("loan_id", "default_flag"), "loan_id")
    return rounded(policy.sourcing_quality(both), 6)


_NEW_TERM = "(CASE WHEN loan_term_months = 36 THEN 60 ELSE loan_term_months + 12 END)"
_NEW_EMI = EMI_SQL.replace("loan_term_months", _NEW_TERM)


@query("restructure_offer", ["loans"], f"""
SELECT loan_id, CAST({_NEW_TERM} AS INT) AS new_term_months, round({EMI_SQL}, 2) AS current_emi, round({_NEW_EMI}, 2) AS new_emi,
  round(({_NEW_EMI}) - ({EMI_SQL}), 2) AS emi_change FROM loans""")
def restructure_offer(i):
    out = policy.restructure_offer(i.loans)
    return rounded(out.select("loan_id", "new_term_months", "current_emi", "new_emi", "emi_change"), 2)
