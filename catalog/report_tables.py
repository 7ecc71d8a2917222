"""Queries: portfolio reports and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators import profile, reports, segments
from arrearium.plans.master import clean_customers
from catalog.registry import query, rounded


@query("default_rate_by_type", ["book"], """
SELECT loan_type, round(AVG(default_flag)*100e0, 4) AS default_rate_pct FROM book
WHERE loan_type IS NOT NULL GROUP BY loan_type""")
def default_rate_by_type(i):
    return rounded(reports.default_rate_by(i.book))


@query("delinquency_mix_by_region", ["book"], """
SELECT region, COUNT(*) AS n_rows,
  round(SUM(CASE WHEN delinquency_bucket = 'Current' THEN 1e0 ELSE 0e0 END)/COUNT(*)*100e0, 4) AS pct_1,
  round(SUM(CASE WHEN delinquency_bucket = '1-30 DPD (SMA-0)' THEN 1e0 ELSE 0e0 END)/COUNT(*)*100e0, 4) AS pct_2,
  round(SUM(CASE WHEN delinquency_bucket = '31-60 DPD (SMA-1)' THEN 1e0 ELSE 0e0 END)/COUNT(*)*100e0, 4) AS pct_3,
  round(SUM(CASE WHEN delinquency_bucket = '61-90 DPD (SMA-2)' THEN 1e0 ELSE 0e0 END)/COUNT(*)*100e0, 4) AS pct_4,
  round(SUM(CASE WHEN delinquency_bucket = '90+ DPD (NPA / Default)' THEN 1e0 ELSE 0e0 END)/COUNT(*)*100e0, 4) AS pct_5
FROM book WHERE region IS NOT NULL AND delinquency_bucket IS NOT NULL GROUP BY region""")
def delinquency_mix_by_region(i):
    return rounded(reports.mix_by(i.book))


@query("channel_performance", ["late_book"], """
SELECT primary_channel, round(SUM(outstanding_principal), 2) AS total_outstanding,
  round(SUM(recovered_amount), 2) AS total_recovered, round(SUM(recovery_cost), 2) AS total_cost,
  round(AVG(contact_attempts), 4) AS avg_attempts,
  round(SUM(recovered_amount)/NULLIF(SUM(outstanding_principal), 0)*100e0, 4) AS recovery_rate_pct,
  round(SUM(recovered_amount)/greatest(SUM(recovery_cost), 1e0), 4) AS roi_multiple
FROM late_book WHERE primary_channel IS NOT NULL GROUP BY primary_channel""")
def channel_performance(i):
    return rounded(reports.channel_performance(i.late_book), total_outstanding=2, total_recovered=2, total_cost=2)


@query("vintage_curve", ["book"], """
SELECT vintage_quarter, loan_type, round(SUM(loan_amount), 2) AS total_originated,
  round(SUM(recovered_amount), 2) AS total_recovered, round(SUM(principal_paid), 2) AS total_principal_paid,
  round((SUM(principal_paid) + SUM(recovered_amount))/NULLIF(SUM(loan_amount), 0)*100e0, 4) AS cumulative_repayment_rate
FROM book WHERE vintage_quarter IS NOT NULL AND loan_type IS NOT NULL GROUP BY vintage_quarter, loan_type""")
def vintage_curve(i):
    return rounded(reports.vintage_curve(i.book), total_originated=2, total_recovered=2, total_principal_paid=2)


RATE_SQL = """round(CASE WHEN outstanding_principal > 0
  THEN least(greatest(recovered_amount/outstanding_principal*100e0, 0e0), 100e0) ELSE 0e0 END, 2)"""


@query("officer_leaderboard", ["late_book"], f"""
SELECT recovery_officer_id, officer_name, COUNT(loan_id) AS total_accounts,
  round(SUM(recovered_amount), 2) AS total_recovered, round(AVG(rate), 4) AS avg_recovery_rate,
  round(SUM(recovery_cost), 2) AS total_cost, round(SUM(recovered_amount) - SUM(recovery_cost), 2) AS net_recovered
FROM (SELECT *, {RATE_SQL} AS rate FROM late_book)
WHERE recovery_officer_id <> 'None' GROUP BY recovery_officer_id, officer_name""")
def officer_leaderboard(i):
    rate = X.round_to(X.recovery_rate_pct("recovered_amount", "outstanding_principal"), 2)
    out = reports.officer_leaderboard(i.late_book.withColumn("recovery_rate_pct", rate))
    return rounded(out, total_recovered=2, total_cost=2, net_recovered=2)


@query("portfolio_kpis", ["book"], """
SELECT COUNT(*) AS n_accounts, round(AVG(default_flag)*100e0, 4) AS default_rate_pct,
  round(AVG(recovered_amount), 4) AS avg_recovered, round(SUM(recovered_amount), 2) AS total_recovered,
  round(AVG(overdue_days), 4) AS avg_overdue_days,
  round(AVG(CASE WHEN recovery_status IN ('Fully Recovered', 'Partially Recovered') THEN 1e0 ELSE 0e0 END)*100e0, 4)
    AS recovery_rate_pct,
  round(SUM(recovered_amount)/COUNT(*), 4) AS yield_per_account FROM book""")
def portfolio_kpis(i):
    flagged = i.book.withColumn("recovery_status_binary", X.recovery_label("recovery_status"))
    return rounded(reports.portfolio_kpis(flagged), total_recovered=2)


@query("sum_by_category", ["loans", "recovery_activities"], """
SELECT loan_type, round(SUM(recovered_amount), 2) AS total_recovered_amount
FROM loans l JOIN recovery_activities v ON v.loan_id = l.loan_id WHERE loan_type IS NOT NULL GROUP BY loan_type""")
def sum_by_category(i):
    both = i.loans.select("loan_id", "loan_type").join(i.recovery.select("loan_id", "recovered_amount"), "loan_id")
    return rounded(reports.sum_by_category(both, "loan_type", "recovered_amount"), 2)


@query("value_counts", ["loans"], """
SELECT loan_type, COUNT(*) AS n, round(COUNT(*)/CAST((SELECT COUNT(*) FROM loans WHERE loan_type IS NOT NULL) AS DOUBLE), 6)
  AS share FROM loans WHERE loan_type IS NOT NULL GROUP BY loan_type""")
def value_counts(i):
    return rounded(reports.value_counts(i.loans, "loan_type", share=True), 6)


DESCRIBED = ["loan_id", "customer_id", "loan_amount", "interest_rate", "loan_term_months", "collateral_value"]


@query("describe_numeric", ["loans"], "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS count, round(AVG({c}), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
  round(MIN(CAST({c} AS DOUBLE)), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
  round(MAX(CAST({c} AS DOUBLE)), 4) AS max FROM loans""" for c in DESCRIBED))
def describe_numeric(i):
    """Every numeric column of loans."""
    return rounded(profile.describe_numeric(i.loans))


TEXTS = ["gender", "region", "city_tier", "employment_status", "housing_status", "marital_status"]


@query("describe_categorical", ["customers"], "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", (SELECT COUNT({c}) FROM customers) AS count,
  (SELECT COUNT(DISTINCT {c}) FROM customers) AS "unique", {c} AS top, n AS freq
FROM (SELECT {c}, COUNT(*) AS n FROM customers WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""
                                                              for c in TEXTS))
def describe_categorical(i):
    out = profile.describe_categorical(i.customers, TEXTS)
    return out.withColumn("count", F.col("count").cast("long"))


CUSTOMER_COLUMNS = ["customer_id", "age", "gender", "region", "city_tier", "employment_status",
                    "employment_length_years", "annual_income", "credit_score", "housing_status", "marital_status",
                    "existing_debts_count"]


@query("missing_profile", ["customers"], "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count,
  round((COUNT(*) - COUNT({c}))/CAST(COUNT(*) AS DOUBLE)*100e0, 2) AS missing_pct FROM customers"""
                                                         for c in CUSTOMER_COLUMNS))
def missing_profile(i):
    return rounded(profile.missing_profile(i.customers), 2)


@query("outlier_profile", ["customers"], """
SELECT COUNT(*) FILTER (annual_income < q25 - 1.5e0*(q75 - q25) OR annual_income > q75 + 1.5e0*(q75 - q25)) AS n_outliers,
  COUNT(annual_income) AS n_values,
  round(COUNT(*) FILTER (annual_income < q25 - 1.5e0*(q75 - q25) OR annual_income > q75 + 1.5e0*(q75 - q25))
    / CAST(COUNT(annual_income) AS DOUBLE)*100e0, 4) AS outlier_pct
FROM customers, (SELECT quantile_cont(annual_income, 0.25) AS q25, quantile_cont(annual_income, 0.75) AS q75 FROM customers)""")
def outlier_profile(i):
    return rounded(profile.outlier_profile(i.customers, "annual_income"))


_PAIRS = [(fv.CORRELATION_COLUMNS[a], fv.CORRELATION_COLUMNS[b])
          for a in range(len(fv.CORRELATION_COLUMNS)) for b in range(a)]


@query("correlation_matrix", ["master"], "\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(r{k}, 6) AS r FROM c" for k, (a, b) in enumerate(_PAIRS)),
    extra={"c": "SELECT " + ", ".join(f"corr({a}, {b}) AS r{k}" for k, (a, b) in enumerate(_PAIRS)) + " FROM master"})
def correlation_matrix(i):
    return rounded(profile.correlation_matrix(i.stored_master), 6)


def _histogram_sql(bins, by):
    key = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM loans WHERE {by} IS NOT NULL) g, " if by else ""
    match = f" AND b.{by} = g.{by}" if by else ""
    return f"""
SELECT {f"g.{by}, " if by else ""}CAST(k.bin AS INT) AS bin, round(s.lo + k.bin*((s.hi - s.lo)/{bins}e0), 4) AS bin_start,
  round(s.lo + (k.bin + 1)*((s.hi - s.lo)/{bins}e0), 4) AS bin_end, coalesce(b.n, 0) AS n
FROM s, {groups}(SELECT unnest(range({bins})) AS bin) k
LEFT JOIN (SELECT {key}CAST(least(floor((loan_amount - lo)/((hi - lo)/{bins}e0)), {bins - 1}) AS INT) AS bin, COUNT(*) AS n
  FROM loans, s WHERE loan_amount IS NOT NULL GROUP BY {key}2) b ON b.bin = k.bin{match}""".replace(
        "GROUP BY 2", "GROUP BY 1")


_SPAN = {"s": "SELECT MIN(loan_amount) AS lo, MAX(loan_amount) AS hi FROM loans"}


@query("histogram", ["loans"], _histogram_sql(30, None), extra=_SPAN)
def histogram(i):
    return rounded(profile.histogram(i.loans, "loan_amount", 30))


@query("histogram_by_type", ["loans"], _histogram_sql(35, "loan_type"), extra=_SPAN)
def histogram_by_type(i):
    return rounded(profile.histogram(i.loans, "loan_amount", 35, ["loan_type"]))


@query("density_by_group", ["book"], """
SELECT f.delinquency_bucket, CAST(k.grid_no AS INT) AS grid_no, round(f.lo + k.grid_no*(f.hi - f.lo)/49e0, 4) AS x,
  round(SUM(f.n*exp(-0.5e0*pow(((f.lo + k.grid_no*(f.hi - f.lo)/49e0) - (f.lo + (f.bin + 0.5e0)*(f.hi - f.lo)/400e0))
    / (g.sd*pow(g.total, -0.2e0)), 2)))
    / (MIN(g.total)*MIN(g.sd*pow(g.total, -0.2e0))*sqrt(2*pi())), 6) AS density
FROM (SELECT delinquency_bucket, lo, hi, least(floor((credit_score - lo)/((hi - lo)/400e0)), 399) AS bin, COUNT(*) AS n
  FROM book, s GROUP BY 1, 2, 3, 4) f
JOIN (SELECT delinquency_bucket, COUNT(credit_score) AS total, stddev_samp(CAST(credit_score AS DOUBLE)) AS sd
  FROM book GROUP BY 1) g ON g.delinquency_bucket = f.delinquency_bucket,
(SELECT unnest(range(50)) AS grid_no) k
GROUP BY f.delinquency_bucket, k.grid_no, f.lo, f.hi""",
       extra={"s": "SELECT CAST(MIN(credit_score) AS DOUBLE) AS lo, CAST(MAX(credit_score) AS DOUBLE) AS hi FROM book"})
def density_by_group(i):
    return rounded(profile.density_by_group(i.book, "credit_score", "delinquency_bucket"), 6, x=4)


@query("box_stats", ["late_book"], f"""
SELECT d.collateral_type, q.n, round(q.q1, 4) AS q1, round(q.med, 4) AS median, round(q.q3, 4) AS q3,
  round(MIN(CASE WHEN d.rate >= q.q1 - 1.5e0*(q.q3 - q.q1) THEN d.rate END), 4) AS whisker_lo,
  round(MAX(CASE WHEN d.rate <= q.q3 + 1.5e0*(q.q3 - q.q1) THEN d.rate END), 4) AS whisker_hi
FROM d JOIN (SELECT collateral_type, COUNT(rate) AS n, quantile_cont(rate, 0.25) AS q1, quantile_cont(rate, 0.5) AS med,
  quantile_cont(rate, 0.75) AS q3 FROM d GROUP BY collateral_type) q ON q.collateral_type = d.collateral_type
GROUP BY d.collateral_type, q.n, q.q1, q.med, q.q3""",
       extra={"d": f"SELECT collateral_type, {RATE_SQL} AS rate FROM late_book"})
def box_stats(i):
    rate = X.round_to(X.recovery_rate_pct("recovered_amount", "outstanding_principal"), 2)
    rows = i.late_book.select("collateral_type", rate.alias("rate"))
    return rounded(profile.box_stats(rows, "rate", "collateral_type"))


@query("settlement_points", ["late_book"], """
SELECT loan_id, loan_type, round(settlement_discount_pct, 4) AS settlement_discount_pct,
  round(recovered_amount, 2) AS recovered_amount, round(outstanding_principal, 2) AS outstanding_principal
FROM late_book WHERE settlement_discount_pct > 0""")
def settlement_points(i):
    return rounded(reports.settlement_points(i.late_book), 2, settlement_discount_pct=4)


@query("sample_rows", ["loans", "repayments"], """
SELECT l.loan_id, l.loan_type, round(l.interest_rate, 4) AS interest_rate, p.overdue_days
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id AND p.customer_id = l.customer_id
ORDER BY md5(CAST(l.loan_id AS VARCHAR)), l.loan_id LIMIT 2500""")
def sample_rows(i):
    from arrearium.operators.joins import join_loans_repayments
    rows = join_loans_repayments(i.loans, i.repayments).select("loan_id", "loan_type", "interest_rate", "overdue_days")
    return rounded(reports.sample_rows(rows, 2500, "loan_id"))


@query("cleaning_summary", ["clean_customers", "customers"], """
SELECT * FROM (SELECT COUNT(*) AS raw_rows,
    """ + " + ".join(f"COUNT(*) - COUNT({c})" for c in CUSTOMER_COLUMNS) + """ AS raw_missing FROM customers),
  (SELECT COUNT(*) AS clean_rows,
    """ + " + ".join(f"COUNT(*) - COUNT({c})" for c in CUSTOMER_COLUMNS) + """ AS clean_missing FROM clean_customers)""")
def cleaning_summary(i):
    return reports.cleaning_summary(i.customers, clean_customers(i.customers))


# Fixed centroids for the scoring half of clustering: scaled score and days past due.
CENTROIDS = [(0, 760.0, 10.0), (1, 660.0, 20.0), (2, 560.0, 60.0), (3, 520.0, 250.0)]
_DIST = ["pow((credit_score - {})/100e0, 2) + pow((overdue_days - {})/90e0, 2)".format(f"{c[1]}e0", f"{c[2]}e0")
         for c in CENTROIDS]
CLUSTERED = {"clustered": f"""
SELECT m.*, CASE WHEN d0 <= d1 AND d0 <= d2 AND d0 <= d3 THEN 0 WHEN d1 <= d2 AND d1 <= d3 THEN 1
  WHEN d2 <= d3 THEN 2 ELSE 3 END AS cluster_id
FROM (SELECT *, {", ".join(f"{d} AS d{k}" for k, d in enumerate(_DIST))} FROM master) m"""}
PROFILE_COLUMNS = [*fv.SEGMENT_FEATURES, "default_flag", "recovered_amount"]
PROFILED = {**CLUSTERED, "profiled": f"""
SELECT cluster_id, COUNT(*) AS n, {", ".join(f"AVG({c}) AS avg_{c}" for c in PROFILE_COLUMNS)},
  COUNT(*)/CAST((SELECT COUNT(*) FROM clustered) AS DOUBLE) AS share FROM clustered GROUP BY cluster_id"""}
PERSONA = {**PROFILED, "persona": """
SELECT cluster_id, CASE WHEN avg_credit_score >= 690 AND avg_default_flag < 0.05e0 THEN 'Prime / Low-Risk Self-Curative'
  WHEN avg_loan_amount > 100000 AND avg_credit_score >= 630 THEN 'Secured High-Value / Asset-Backed'
  WHEN avg_overdue_days > 90 OR avg_credit_score < 600 OR avg_default_flag > 0.3e0
    THEN 'Chronic Delinquent / High Risk (Agency/Legal)'
  ELSE 'Distressed but Responsive (Restructure)' END AS segment_name FROM profiled"""}


def clustered(i):
    scaled = i.stored_master.withColumns({"z0": F.col("credit_score") / 100.0, "z1": F.col("overdue_days") / 90.0})
    centroids = {k: [a / 100.0, b / 90.0] for k, a, b in CENTROIDS}
    return segments.assign_nearest_centroid(scaled, ["z0", "z1"], centroids).drop("z0", "z1")


@query("assign_nearest_centroid", ["master"], "SELECT loan_id, cluster_id FROM clustered", extra=CLUSTERED)
def assign_nearest_centroid(i):
    return clustered(i).select("loan_id", "cluster_id")


@query("cluster_profile", ["master"], "SELECT cluster_id, n, " + ", ".join(
    f"round(avg_{c}, 4) AS avg_{c}" for c in PROFILE_COLUMNS) + ", round(share, 6) AS share FROM profiled", extra=PROFILED)
def cluster_profile(i):
    return rounded(reports.cluster_profile(clustered(i)), share=6)


@query("persona_rules", ["master"], """
SELECT c.loan_id, c.cluster_id, p.segment_name FROM clustered c JOIN persona p ON p.cluster_id = c.cluster_id""",
       extra=PERSONA)
def persona_rules(i):
    return segments.persona_rules(clustered(i)).select("loan_id", "cluster_id", "segment_name")


@query("segment_default_rate", ["master"], """
SELECT p.segment_name, round(AVG(c.default_flag), 6) AS default_rate
FROM clustered c JOIN persona p ON p.cluster_id = c.cluster_id GROUP BY p.segment_name""", extra=PERSONA)
def segment_default_rate(i):
    return rounded(reports.segment_default_rate(segments.persona_rules(clustered(i))), 6)


@query("persona_playbook", ["master"], """
SELECT p.segment_name, CASE WHEN p.segment_name LIKE 'Prime%' THEN '700+ Score, Low' WHEN p.segment_name LIKE 'Distressed%'
  THEN '630-690, Medium' WHEN p.segment_name LIKE 'Secured%' THEN 'Asset-Backed' ELSE '<600 Score, High' END AS risk_profile,
  CASE WHEN p.segment_name LIKE 'Prime%' THEN 'AI SMS/Email only' WHEN p.segment_name LIKE 'Distressed%'
  THEN 'Restructure / Haircut' WHEN p.segment_name LIKE 'Secured%' THEN 'Repossession Notice' ELSE 'Agency / Legal DRT' END AS action,
  COUNT(*) AS n_accounts, round(COUNT(*)/CAST((SELECT COUNT(*) FROM clustered) AS DOUBLE), 6) AS share
FROM clustered c JOIN persona p ON p.cluster_id = c.cluster_id GROUP BY p.segment_name""", extra=PERSONA)
def persona_playbook(i):
    return rounded(segments.persona_playbook(segments.persona_rules(clustered(i))), 6)


@query("haircut_policy", ["master"], """
SELECT c.loan_id, p.segment_name, round(c.settlement_discount_pct, 4) AS proposed_pct,
  round(least(c.settlement_discount_pct, CASE WHEN p.segment_name LIKE 'Prime%' THEN 20e0 WHEN p.segment_name LIKE 'Distressed%'
  THEN 15e0 WHEN p.segment_name LIKE 'Secured%' THEN 20e0 ELSE 25e0 END), 4) AS allowed_pct
FROM clustered c JOIN persona p ON p.cluster_id = c.cluster_id""", extra=PERSONA)
def haircut_policy(i):
    from arrearium.operators.policy import haircut_policy as policy
    out = policy(segments.persona_rules(clustered(i)))
    return rounded(out.select("loan_id", "segment_name", F.col("settlement_discount_pct").alias("proposed_pct"), "allowed_pct"))


@query("portfolio_summary", ["book"], """
SELECT round(SUM(loan_amount), 2) AS disbursed, round(SUM(outstanding_principal), 2) AS outstanding,
  round(SUM(CASE WHEN overdue_days > 30 THEN outstanding_principal ELSE 0e0 END), 2) AS delinquent_exposure,
  COUNT(*) FILTER (overdue_days > 30) AS delinquent_accounts,
  round(SUM(CASE WHEN overdue_days > 30 THEN recovered_amount - recovery_cost ELSE 0e0 END), 2) AS net_recovered,
  round(AVG(CASE WHEN overdue_days > 90 THEN 1e0 ELSE 0e0 END)*100e0, 4) AS npa_rate_pct,
  round(AVG(CASE WHEN overdue_days > 0 AND overdue_days <= 60 THEN 1e0 ELSE 0e0 END)*100e0, 4) AS early_stage_pct
FROM book""")
def portfolio_summary(i):
    return rounded(reports.portfolio_summary(i.book), 4, disbursed=2, outstanding=2, delinquent_exposure=2, net_recovered=2)


@query("lgd_by_collateral", ["book"], """
SELECT CASE WHEN collateral_type IS NULL OR collateral_type = 'None' THEN 0 ELSE 1 END AS is_secured,
  COUNT(*) AS n_defaults, round(1e0 - SUM(recovered_amount)/NULLIF(SUM(outstanding_principal), 0), 6) AS lgd
FROM book WHERE default_flag = 1 GROUP BY 1""")
def lgd_by_collateral(i):
    return rounded(reports.lgd_by_collateral(i.book.withColumn("is_secured", X.is_secured("collateral_type"))), 6)


@query("haircut_elasticity", ["late_book"], """
SELECT CASE WHEN settlement_discount_pct < 10 THEN '<10' WHEN settlement_discount_pct < 20 THEN '10-20'
    WHEN settlement_discount_pct <= 30 THEN '20-30' ELSE '>30' END AS discount_band, COUNT(*) AS n_accounts,
  round(SUM(recovered_amount)/NULLIF(SUM(outstanding_principal), 0)*100e0, 4) AS recovery_rate_pct,
  round(SUM(recovered_amount - recovery_cost), 2) AS net_recovered
FROM late_book GROUP BY 1""")
def haircut_elasticity(i):
    return rounded(reports.haircut_elasticity(i.late_book), net_recovered=2)


@query("filter_options", ["loans", "repayments"], """
SELECT array_to_string(list_sort(list(DISTINCT loan_type)), '|') AS options, MAX(overdue_days) AS max_dpd
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id""")
def filter_options(i):
    both = i.loans.select("loan_id", "loan_type").join(i.repayments.select("loan_id", "overdue_days"), "loan_id")
    return reports.filter_options(both).withColumn("options", F.array_join("options", "|"))
