"""Test views: lending tables derived from the given base tables, in SQL both engines read.

The oracle statements start from the same text; the later CTEs (book, master, ...) are written for
the oracle only, from the definitions of the operators.
"""

import re

VIEWS = {
    "customers": """
SELECT c.c_custkey AS customer_id,
  CAST(21 + (c.c_custkey*7) % 48 AS INT) AS age,
  CASE WHEN (c.c_custkey*13) % 100 < 58 THEN 'Male' WHEN (c.c_custkey*13) % 100 < 98 THEN 'Female' ELSE 'Other' END AS gender,
  r.r_name AS region,
  CASE WHEN (c.c_custkey*37) % 100 < 42 THEN 'Tier 1' WHEN (c.c_custkey*37) % 100 < 77 THEN 'Tier 2'
       WHEN (c.c_custkey*37) % 100 < 95 THEN 'Tier 3' ELSE 'Rural' END AS city_tier,
  CASE WHEN c.c_custkey % 83 = 0 THEN 'Unemployed' ELSE c.c_mktsegment END AS employment_status,
  CASE WHEN c.c_custkey % 83 = 0 OR c.c_custkey % 29 = 0 THEN NULL ELSE CAST(c.c_custkey % 17 AS INT) END AS employment_length_years,
  (30000e0 + 9e0*c.c_acctbal) * (CASE WHEN c.c_custkey % 97 = 0 THEN 10e0 WHEN c.c_custkey % 211 = 0 THEN 0.1e0 ELSE 1e0 END) AS annual_income,
  CAST(480 + (c.c_custkey*7919) % 371 AS INT) AS credit_score,
  CASE WHEN c.c_custkey % 53 = 0 THEN NULL WHEN (c.c_custkey*11) % 100 < 26 THEN 'Owned'
       WHEN (c.c_custkey*11) % 100 < 51 THEN 'Mortgaged' WHEN (c.c_custkey*11) % 100 < 77 THEN 'Rented' ELSE 'Family Owned' END AS housing_status,
  CASE WHEN (c.c_custkey*19) % 100 < 47 THEN 'Married' WHEN (c.c_custkey*19) % 100 < 83 THEN 'Single' ELSE 'Divorced' END AS marital_status,
  CAST((c.c_custkey*3) % 7 AS INT) AS existing_debts_count
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "loans": """
SELECT o_orderkey AS loan_id, o_custkey AS customer_id,
  CASE SUBSTR(o_orderpriority,1,1) WHEN '1' THEN 'Home Loan' WHEN '2' THEN 'Auto Loan' WHEN '3' THEN 'Business Loan'
       WHEN '4' THEN 'Education Loan' ELSE 'Personal Loan' END AS loan_type,
  o_totalprice AS loan_amount,
  5.5e0 + ((o_orderkey*31) % 2050)/100e0 AS interest_rate,
  CAST(12*(1 + o_orderkey % 5) AS INT) AS loan_term_months,
  CAST(o_orderdate AS DATE) AS disbursement_date,
  CASE WHEN SUBSTR(o_orderpriority,1,1) = '1' THEN 'Residential Property' WHEN SUBSTR(o_orderpriority,1,1) = '2' THEN 'Vehicle'
       WHEN SUBSTR(o_orderpriority,1,1) = '3' AND o_orderkey % 4 < 3 THEN 'Equipment'
       WHEN SUBSTR(o_orderpriority,1,1) = '4' AND o_orderkey % 2 = 0 THEN 'Third Party Guarantee' ELSE 'None' END AS collateral_type,
  CASE WHEN SUBSTR(o_orderpriority,1,1) IN ('1','2') THEN o_totalprice*(1.05e0 + (o_orderkey % 50)/100e0)
       WHEN SUBSTR(o_orderpriority,1,1) = '3' AND o_orderkey % 4 < 3 THEN o_totalprice*1.2e0
       WHEN SUBSTR(o_orderpriority,1,1) = '4' AND o_orderkey % 2 = 0 THEN o_totalprice
       WHEN o_orderkey % 7 = 0 THEN NULL ELSE 0e0 END AS collateral_value,
  CASE o_orderkey % 3 WHEN 0 THEN 'Refinancing' WHEN 1 THEN 'Working Capital' ELSE 'Debt Consolidation' END AS loan_purpose,
  CASE (o_orderkey*3) % 5 WHEN 0 THEN 'Digital Portal' WHEN 1 THEN 'Branch Network' WHEN 2 THEN 'DSA / Direct Selling Agent'
       WHEN 3 THEN 'Mobile App' ELSE 'Tele-Sales' END AS origination_channel
FROM orders
""",
    "repayments": """
SELECT t.loan_id AS repayment_id, t.loan_id, t.customer_id, t.total_installments_due, t.installments_paid,
  1.3e0*t.principal_paid AS total_amount_paid, t.principal_paid, 0.3e0*t.principal_paid AS interest_paid,
  t.last_payment_date, t.overdue_days,
  CASE WHEN t.overdue_days = 0 THEN 'Current' WHEN t.overdue_days <= 30 THEN '1-30 DPD (SMA-0)' WHEN t.overdue_days <= 60 THEN '31-60 DPD (SMA-1)'
       WHEN t.overdue_days <= 90 THEN '61-90 DPD (SMA-2)' ELSE '90+ DPD (NPA / Default)' END AS delinquency_bucket,
  CASE WHEN t.overdue_days > 90 THEN 1 ELSE 0 END AS default_flag,
  CASE WHEN t.overdue_days > 90 THEN t.disbursed + CAST(30*t.installments_paid + 90 AS INT) ELSE NULL END AS default_date
FROM (SELECT o.o_orderkey AS loan_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS disbursed,
    CAST(COUNT(*) AS INT) AS total_installments_due,
    CAST(SUM(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END) AS INT) AS installments_paid,
    o.o_totalprice * SUM(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END) / (COUNT(*) + 2e0) AS principal_paid,
    CAST(MAX(l.l_shipdate) AS DATE) AS last_payment_date,
    CAST(CASE WHEN (o.o_orderkey*41) % 100 < 45 THEN 0 WHEN (o.o_orderkey*41) % 100 < 75 THEN 1 + (o.o_orderkey*7) % 30
              WHEN (o.o_orderkey*41) % 100 < 84 THEN 31 + (o.o_orderkey*7) % 30 WHEN (o.o_orderkey*41) % 100 < 92 THEN 61 + (o.o_orderkey*7) % 30
              ELSE 91 + (o.o_orderkey*7) % 449 END AS INT) AS overdue_days
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_orderkey, o.o_custkey, o.o_totalprice, CAST(o.o_orderdate AS DATE)) t
""",
    "recovery_activities": """
SELECT p.loan_id AS recovery_id, p.loan_id, p.customer_id,
  CASE WHEN (p.loan_id*17) % 101 < 43 THEN 'Fully Recovered' WHEN (p.loan_id*17) % 101 < 66 THEN 'Partially Recovered'
       WHEN p.overdue_days > 360 THEN 'Written Off' WHEN p.overdue_days > 120 AND p.loan_id % 3 = 0 THEN 'Legal Escalation' ELSE 'In Progress' END AS recovery_status,
  CASE WHEN p.overdue_days <= 60 THEN (CASE WHEN p.loan_id % 3 < 2 THEN 'AI Voice Bot & SMS' ELSE 'Tele-Calling & Counseling' END)
       WHEN p.overdue_days <= 120 THEN (CASE p.loan_id % 3 WHEN 0 THEN 'Tele-Calling & Counseling' WHEN 1 THEN 'Field Visit & Face-to-Face' ELSE 'Debt Restructuring' END)
       ELSE (CASE p.loan_id % 3 WHEN 0 THEN 'Legal Notice & DRT' WHEN 1 THEN 'Field Visit & Face-to-Face' ELSE 'External Recovery Agency' END) END AS primary_channel,
  CONCAT('OFF-', CAST(101 + p.loan_id % 8 AS VARCHAR(10))) AS recovery_officer_id,
  CONCAT('Officer ', CAST(101 + p.loan_id % 8 AS VARCHAR(10))) AS officer_name,
  CASE WHEN p.loan_id % 8 < 2 THEN 'Manager' ELSE 'Specialist' END AS officer_designation,
  CAST(1 + (p.loan_id*5) % 28 AS INT) AS contact_attempts,
  CAST(CASE WHEN (p.loan_id*23) % 103 < 39 THEN 1 ELSE 0 END AS INT) AS promise_to_pay_kept,
  CASE WHEN (p.loan_id*17) % 101 < 43 THEN ((p.loan_id*29) % 1500)/100e0 WHEN (p.loan_id*17) % 101 < 66 THEN 15e0 + ((p.loan_id*29) % 3000)/100e0 ELSE 0e0 END AS settlement_discount_pct,
  CASE WHEN (p.loan_id*17) % 101 < 43 THEN (o.o_totalprice - p.principal_paid)*(1e0 - ((p.loan_id*29) % 1500)/10000e0)
       WHEN (p.loan_id*17) % 101 < 66 THEN (o.o_totalprice - p.principal_paid)*(0.35e0 + ((p.loan_id*3) % 40)/100e0) ELSE 0e0 END AS recovered_amount,
  11e0 + 6.25e0*(1 + (p.loan_id*5) % 28) + (p.overdue_days % 7)*40e0 AS recovery_cost,
  CASE WHEN (p.loan_id*17) % 101 < 66 THEN p.last_payment_date + CAST(p.overdue_days AS INT) ELSE NULL END AS recovery_date
FROM repayments p JOIN orders o ON o.o_orderkey = p.loan_id WHERE p.overdue_days > 30
""",
    "contacts": """
SELECT event_id, user_id AS account_id, CAST(ts AS TIMESTAMP) AS contact_ts FROM events WHERE event_type = 'click'
""",
    "promises": """
SELECT event_id, user_id AS account_id, CAST(ts AS TIMESTAMP) AS promise_ts, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS kept FROM events WHERE event_type IN ('purchase','error')
""",
    "bureau_scores": """
SELECT event_id, user_id AS account_id, CAST(ts AS TIMESTAMP) AS score_ts, CAST(600 + (event_id*37) % 120 AS INT) AS score FROM events WHERE event_type = 'view'
""",
}

# CTEs for the oracle: name -> (names it builds on, text).
ORACLE_CTES = {
    "employment_median": (["customers"], """
SELECT employment_status, quantile_cont(CAST(employment_length_years AS DOUBLE), 0.5) AS med
FROM customers WHERE employment_status IS NOT NULL GROUP BY employment_status"""),
    "tier_income": (["customers"], """
SELECT city_tier, quantile_cont(annual_income, 0.25) AS q25, quantile_cont(annual_income, 0.75) AS q75
FROM customers WHERE city_tier IS NOT NULL GROUP BY city_tier"""),
    "housing_mode": (["customers"], """
SELECT housing_status AS value FROM customers WHERE housing_status IS NOT NULL
GROUP BY housing_status ORDER BY COUNT(*) DESC, housing_status LIMIT 1"""),
    "clean_customers": (["customers", "employment_median", "tier_income", "housing_mode"], """
SELECT c.customer_id, c.age, c.gender, c.region, c.city_tier, c.employment_status,
  CAST(trunc(coalesce(CAST(c.employment_length_years AS DOUBLE), m.med, 3e0)) AS INT) AS employment_length_years,
  CASE WHEN t.q25 IS NULL OR c.annual_income IS NULL THEN c.annual_income
       ELSE least(greatest(c.annual_income, greatest(12000e0, t.q25 - 1.5e0*(t.q75 - t.q25))),
                  t.q75 + 3e0*(t.q75 - t.q25)) END AS annual_income,
  c.credit_score, coalesce(c.housing_status, (SELECT value FROM housing_mode), 'Unknown') AS housing_status,
  c.marital_status, c.existing_debts_count
FROM customers c LEFT JOIN employment_median m ON m.employment_status = c.employment_status
LEFT JOIN tier_income t ON t.city_tier = c.city_tier"""),
    "loan_rows": (["loans", "repayments", "recovery_activities"], """
SELECT l.loan_id, l.customer_id, l.loan_type, l.loan_amount, l.interest_rate, l.loan_term_months,
  l.disbursement_date, l.collateral_type, coalesce(l.collateral_value, 0e0) AS collateral_value,
  l.loan_purpose, l.origination_channel,
  CAST(year(l.disbursement_date) AS INT) AS vintage_year,
  CAST(year(l.disbursement_date) AS VARCHAR) || 'Q' || CAST(quarter(l.disbursement_date) AS VARCHAR) AS vintage_quarter,
  p.repayment_id, p.total_installments_due, p.installments_paid, p.total_amount_paid, p.principal_paid,
  p.interest_paid, p.last_payment_date, p.overdue_days, p.delinquency_bucket, p.default_flag, p.default_date,
  CASE WHEN l.loan_amount - p.principal_paid > 0 THEN l.loan_amount - p.principal_paid
       WHEN l.loan_amount - p.principal_paid IS NULL THEN NULL ELSE 0e0 END AS outstanding_principal,
  v.recovery_id,
  coalesce(v.recovery_status, 'No Delinquency / Not Applicable') AS recovery_status,
  coalesce(v.primary_channel, 'None') AS primary_channel,
  coalesce(v.recovery_officer_id, 'None') AS recovery_officer_id,
  coalesce(v.officer_name, 'None') AS officer_name,
  coalesce(v.officer_designation, 'None') AS officer_designation,
  coalesce(v.contact_attempts, 0) AS contact_attempts,
  coalesce(v.promise_to_pay_kept, 0) AS promise_to_pay_kept,
  coalesce(v.settlement_discount_pct, 0e0) AS settlement_discount_pct,
  coalesce(v.recovered_amount, 0e0) AS recovered_amount,
  coalesce(v.recovery_cost, 0e0) AS recovery_cost, v.recovery_date
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id AND p.customer_id = l.customer_id
LEFT JOIN recovery_activities v ON v.loan_id = l.loan_id"""),
    "book": (["customers", "loan_rows"], """
SELECT c.age, c.gender, c.region, c.city_tier, c.employment_status, c.employment_length_years,
  c.annual_income, c.credit_score, c.housing_status, c.marital_status, c.existing_debts_count, r.*
FROM customers c JOIN loan_rows r ON r.customer_id = c.customer_id"""),
    "master_emi": (["clean_customers", "loan_rows"], """
SELECT c.age, c.gender, c.region, c.city_tier, c.employment_status, c.employment_length_years,
  c.annual_income, c.credit_score, c.housing_status, c.marital_status, c.existing_debts_count, r.*,
  round(CASE WHEN r.interest_rate = 0 THEN r.loan_amount / r.loan_term_months
       ELSE r.loan_amount * ((r.interest_rate/100e0/12e0) * pow(1 + r.interest_rate/100e0/12e0, r.loan_term_months))
            / (pow(1 + r.interest_rate/100e0/12e0, r.loan_term_months) - 1) END, 2) AS monthly_emi,
  CASE WHEN r.collateral_type IS NULL OR r.collateral_type = 'None' THEN 0 ELSE 1 END AS is_secured
FROM clean_customers c JOIN loan_rows r ON r.customer_id = c.customer_id"""),
    "master": (["master_emi"], """
SELECT m.*, round(m.monthly_emi*12 / NULLIF(m.annual_income, 0), 4) AS dti_ratio,
  round(CASE WHEN m.is_secured = 1
    THEN least(greatest(m.loan_amount / greatest(m.collateral_value, 1e0), 0.1e0), 1.5e0) ELSE 1e0 END, 4) AS ltv_ratio,
  CASE WHEN m.credit_score <= 0 THEN NULL WHEN m.credit_score <= 549 THEN 'Deep Subprime (<550)'
       WHEN m.credit_score <= 649 THEN 'Subprime (550-649)' WHEN m.credit_score <= 699 THEN 'Near-Prime (650-699)'
       WHEN m.credit_score <= 749 THEN 'Prime (700-749)' WHEN m.credit_score <= 900 THEN 'Super-Prime (750+)'
       END AS credit_risk_tier,
  round(least(greatest((m.overdue_days/360e0)*60 + (1 - m.credit_score/850e0)*40, 0e0), 100e0), 2)
    AS delinquency_severity_score,
  round(m.recovered_amount - m.recovery_cost, 2) AS net_recovery_amount,
  round(CASE WHEN m.outstanding_principal > 0
    THEN least(greatest((m.recovered_amount / m.outstanding_principal)*100e0, 0e0), 100e0) ELSE 0e0 END, 2)
    AS recovery_rate_pct,
  CASE WHEN m.recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1
       WHEN m.recovery_status IN ('Written Off', 'Legal Escalation', 'In Progress') THEN 0 END AS recovery_target_binary
FROM master_emi m"""),
    "delinquent": (["master"], "SELECT * FROM master WHERE overdue_days > 30"),
    "late_book": (["book"], "SELECT * FROM book WHERE overdue_days > 30"),
    "scores": (["late_book"], """
SELECT loan_id, customer_id, credit_score, overdue_days, promise_to_pay_kept, outstanding_principal,
  settlement_discount_pct, gender, region, city_tier, marital_status, vintage_year,
  CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1 ELSE 0 END AS label,
  least(greatest(0.45e0 + (credit_score - 600)*0.0012e0 - (overdue_days - 40)*0.001e0
        + promise_to_pay_kept*0.25e0, 0.05e0), 0.95e0) AS p
FROM late_book"""),
}
VIEW_NEEDS = {"recovery_activities": ["repayments"]}


def _ordered(names, seen):
    for name in names:
        if name in seen:
            continue
        needs = VIEW_NEEDS.get(name, []) if name in VIEWS else ORACLE_CTES[name][0]
        _ordered(needs, seen)
        seen[name] = VIEWS[name] if name in VIEWS else ORACLE_CTES[name][1]
    return seen


def half_even(sql: str) -> str:
    """Spell every round(x, n) of a statement as rounding half to even, which DuckDB lacks."""
    at = re.search(r"(?<![\w])round\(", sql)
    if not at:
        return sql
    depth, comma, end = 1, None, at.end()
    while depth:
        ch = sql[end]
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 1:
            comma = end
        end += 1
    scale = f"1{'0' * int(sql[comma + 1:end - 1])}e0"
    v = f"(({half_even(sql[at.end():comma])})*{scale})"
    exact = f"(CASE WHEN abs({v} - trunc({v})) = 0.5e0 THEN 2*ROUND({v}/2) ELSE ROUND({v}) END / {scale})"
    return sql[:at.start()] + exact + half_even(sql[end:])


def with_ctes(names, select, extra=None):
    """WITH the named CTEs and all they build on, then extra CTEs, then the statement."""
    parts = {n: half_even(t) for n, t in {**_ordered(names, {}), **(extra or {})}.items()}
    select = half_even(select)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in parts.items()) + "\n" + select
