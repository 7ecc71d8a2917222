"""Queries: scans, sinks, joins and the master table."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.operators import clean, joins, reports
from arrearium.plans import master as M
from arrearium.session import scratch_path
from arrearium.sources import readers, writers
from catalog.registry import query, rounded


@query("scan_tables", ["customers", "loans", "repayments", "recovery_activities"], """
SELECT 'customers' AS table_name, COUNT(*) AS n_rows, 12 AS n_columns FROM customers
UNION ALL SELECT 'loans', COUNT(*), 11 FROM loans
UNION ALL SELECT 'repayments', COUNT(*), 13 FROM repayments
UNION ALL SELECT 'recovery_activities', COUNT(*), 14 FROM recovery_activities""")
def scan_tables(i):
    return readers.table_shapes({"customers": i.customers, "loans": i.loans, "repayments": i.repayments,
                                 "recovery_activities": i.recovery})


@query("scan_master", ["master"], """
SELECT loan_type, COUNT(*) AS n_rows, round(SUM(loan_amount), 2) AS total_amount FROM master GROUP BY loan_type""")
def scan_master(i):
    """Write the master once, read two columns of it back."""
    path = scratch_path(i.spark, "master")
    writers.write_master(i.master, path)
    stored = readers.read_master(i.spark, f"{path}/master")
    out = stored.groupBy("loan_type").agg(F.count("*").alias("n_rows"), F.sum("loan_amount").alias("total_amount"))
    return rounded(out, 2)


@query("scan_untyped_csv", ["loans"], "SELECT * FROM loans")
def scan_untyped_csv(i):
    """Types are inferred; ids come back as int and are widened for the comparison."""
    path = scratch_path(i.spark, "untyped")
    i.loans.write.option("header", True).csv(path)
    back = readers.read_untyped_csv(i.spark, path)
    return back.withColumns({c: F.col(c).cast("long") for c in ("loan_id", "customer_id")})


@query("scan_with_fallback", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_with_fallback(i):
    """The first path does not exist, so the given orders table is read."""
    found = readers.read_first_existing(i.spark, [f"{i.sf_dir}/no_such_master.parquet", f"{i.sf_dir}/orders.parquet"])
    return found.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("write_clean_tables", ["customers", "loans", "repayments", "recovery_activities"], """
SELECT 'customers' AS table_name, COUNT(*) AS n_rows, 12 AS n_columns FROM customers
UNION ALL SELECT 'loans', COUNT(*), 13 FROM loans
UNION ALL SELECT 'repayments', COUNT(*), 13 FROM repayments
UNION ALL SELECT 'recovery_activities', COUNT(*), 14 FROM recovery_activities""")
def write_clean_tables(i):
    path = scratch_path(i.spark, "clean")
    tables = {"customers": M.clean_customers(i.customers), "loans": M.clean_loans(i.loans),
              "repayments": M.clean_repayments(i.repayments), "recovery_activities": i.recovery}
    writers.write_tables(tables, path)
    return readers.table_shapes({n: i.spark.read.parquet(f"{path}/{n}") for n in tables})


@query("write_master", ["book"], """
SELECT 'master' AS table_name, COUNT(*) AS n_rows, 57 AS n_columns FROM book
UNION ALL SELECT 'delinquent', COUNT(*), 57 FROM book WHERE overdue_days > 30""")
def write_master(i):
    path = scratch_path(i.spark, "master")
    writers.write_master(i.master, path)
    return readers.table_shapes({"master": i.spark.read.parquet(f"{path}/master"),
                                 "delinquent": i.spark.read.parquet(f"{path}/delinquent")})


@query("export_top_n", ["loans"], """
SELECT loan_id, loan_type, round(loan_amount, 2) AS loan_amount FROM loans
ORDER BY loan_amount DESC, loan_id LIMIT 5000""")
def export_top_n(i):
    path = scratch_path(i.spark, "export")
    rows = i.loans.select("loan_id", "loan_type", "loan_amount")
    writers.export_top_n(rows, path, 5000, [F.desc("loan_amount"), "loan_id"])
    back = i.spark.read.schema("loan_id BIGINT, loan_type STRING, loan_amount DOUBLE").option("header", True).csv(path)
    return rounded(back, 2)


@query("join_loans_repayments", ["loans", "repayments"], """
SELECT l.loan_id, l.customer_id, round(l.loan_amount, 4) AS loan_amount, p.installments_paid, p.overdue_days
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id AND p.customer_id = l.customer_id""")
def join_loans_repayments(i):
    out = joins.join_loans_repayments(i.loans, i.repayments)
    return rounded(out.select("loan_id", "customer_id", "loan_amount", "installments_paid", "overdue_days"))


@query("join_customers", ["customers", "loans", "repayments"], """
SELECT l.loan_id, c.customer_id, c.region, c.credit_score, p.overdue_days
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id AND p.customer_id = l.customer_id
JOIN customers c ON c.customer_id = l.customer_id""")
def join_customers(i):
    out = joins.join_customers(i.customers, joins.join_loans_repayments(i.loans, i.repayments))
    return out.select("loan_id", "customer_id", "region", "credit_score", "overdue_days")


@query("join_recovery", ["loans", "repayments", "recovery_activities"], """
SELECT l.loan_id, l.customer_id, p.overdue_days, v.recovery_id, v.recovery_status, v.contact_attempts
FROM loans l JOIN repayments p ON p.loan_id = l.loan_id AND p.customer_id = l.customer_id
LEFT JOIN recovery_activities v ON v.loan_id = l.loan_id""")
def join_recovery(i):
    out = joins.join_recovery(joins.join_loans_repayments(i.loans, i.repayments), i.recovery)
    return out.select("loan_id", "customer_id", "overdue_days", "recovery_id", "recovery_status", "contact_attempts")


@query("build_master", ["master"], "SELECT * FROM master")
def build_master(i):
    return i.master


@query("join_group_stat", ["customers", "tier_income"], """
SELECT c.customer_id, c.city_tier, round(t.q25, 4) AS q25, round(t.q75, 4) AS q75
FROM customers c LEFT JOIN tier_income t ON t.city_tier = c.city_tier""")
def join_group_stat(i):
    stats = clean.group_quantile(i.customers, "annual_income", ["city_tier"], {"q25": 0.25, "q75": 0.75})
    out = clean.join_group_stat(i.customers, stats, ["city_tier"])
    return rounded(out.select("customer_id", "city_tier", "q25", "q75"))


@query("lookup_label", ["loans"], """
SELECT loan_id, CAST(loan_term_months AS INT) AS loan_term_months,
  CASE loan_term_months WHEN 12 THEN 'one year' WHEN 24 THEN 'two years' WHEN 36 THEN 'three years' END AS term_label
FROM loans""")
def lookup_label(i):
    names = {12: "one year", 24: "two years", 36: "three years"}
    return joins.lookup_label(i.loans.select("loan_id", "loan_term_months"), "loan_term_months", names, "term_label")


@query("group_transform", ["customers", "employment_median"], """
SELECT c.customer_id, c.employment_status, round(m.med, 4) AS group_median
FROM customers c LEFT JOIN employment_median m ON m.employment_status = c.employment_status""")
def group_transform(i):
    out = clean.group_transform(i.customers, "employment_length_years", ["employment_status"], "group_median")
    return rounded(out.select("customer_id", "employment_status", "group_median"))


@query("top_k", ["loans"], """
SELECT loan_id, round(loan_amount, 4) AS loan_amount FROM loans ORDER BY loan_amount DESC, loan_id LIMIT 15""")
def top_k(i):
    return rounded(reports.top_k(i.loans.select("loan_id", "loan_amount"), "loan_amount", 15, "loan_id"))


@query("top_bottom_k", ["loans"], """
SELECT loan_id, round(loan_amount, 4) AS loan_amount FROM (
  SELECT * FROM (SELECT loan_id, loan_amount FROM loans ORDER BY loan_amount DESC, loan_id LIMIT 5)
  UNION SELECT * FROM (SELECT loan_id, loan_amount FROM loans ORDER BY loan_amount, loan_id LIMIT 5))""")
def top_bottom_k(i):
    return rounded(reports.top_bottom_k(i.loans.select("loan_id", "loan_amount"), "loan_amount", 5, "loan_id"))


@query("preview", ["loans"], """
SELECT loan_id, loan_type, round(loan_amount, 4) AS loan_amount FROM loans ORDER BY loan_id LIMIT 30""")
def preview(i):
    return rounded(reports.preview(i.loans.select("loan_id", "loan_type", "loan_amount"), 30, "loan_id"))


@query("union_distinct", ["loans", "repayments"], """
SELECT loan_id, customer_id FROM loans UNION SELECT loan_id, customer_id FROM repayments""")
def union_distinct(i):
    return reports.union_distinct(i.loans.select("loan_id", "customer_id"), i.repayments.select("loan_id", "customer_id"))


@query("drop_duplicates", ["loans"], """
SELECT DISTINCT loan_id, customer_id, loan_type, round(loan_amount, 4) AS loan_amount, loan_purpose
FROM (SELECT * FROM loans UNION ALL SELECT * FROM loans)""")
def drop_duplicates(i):
    doubled = i.loans.unionByName(i.loans)
    return rounded(clean.drop_duplicates(doubled).select("loan_id", "customer_id", "loan_type", "loan_amount", "loan_purpose"))
