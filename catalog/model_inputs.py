"""Queries: cleaning, encoding, scaling, splitting and weighting."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.operators import clean, features
from arrearium.operators.stats import hash_folds
from catalog.registry import query, rounded


@query("impute_group_median", ["clean_customers"], """
SELECT customer_id, employment_status, employment_length_years FROM clean_customers""")
def impute_group_median(i):
    out = clean.impute_group_median(i.customers, "employment_length_years", ["employment_status"])
    return out.select("customer_id", "employment_status", "employment_length_years")


@query("impute_mode", ["clean_customers"], "SELECT customer_id, housing_status FROM clean_customers")
def impute_mode(i):
    return clean.impute_mode(i.customers, ["housing_status"]).select("customer_id", "housing_status")


_CUSTOMER_NUMBERS = ["age", "employment_length_years", "annual_income", "credit_score", "existing_debts_count"]
_LOAN_NUMBERS = ["loan_amount", "interest_rate", "loan_term_months", "collateral_value"]
_BOTH_NUMBERS = _CUSTOMER_NUMBERS + _LOAN_NUMBERS
_CUSTOMER_TEXTS = ["gender", "region", "city_tier", "employment_status", "housing_status", "marital_status"]


@query("impute_numeric", ["customers", "loans"], f"""
SELECT loan_id, {", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT {c} FROM m)) AS {c}" for c in _BOTH_NUMBERS)} FROM both_""", extra={
    "both_": "SELECT l.*, c.* EXCLUDE (customer_id) FROM loans l JOIN customers c ON c.customer_id = l.customer_id",
    "m": f"SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}' for c in _BOTH_NUMBERS)} FROM both_"})
def impute_numeric(i):
    """Every numeric column of the joined loans and customers."""
    both = i.loans.join(i.customers, "customer_id").drop("customer_id")
    ids = both.withColumn("loan_id", F.col("loan_id").cast("string"))  # a name, not a number to fill
    return clean.impute_numeric(ids, "median").select(F.col("loan_id").cast("long").alias("loan_id"), *_BOTH_NUMBERS)


@query("impute_numeric_mean", ["customers"], """
SELECT customer_id, round(coalesce(CAST(employment_length_years AS DOUBLE), (SELECT AVG(employment_length_years) FROM customers)), 6)
  AS employment_length_years FROM customers""")
def impute_numeric_mean(i):
    rows = i.customers.select("customer_id", "employment_length_years")
    return rounded(clean.impute_numeric(rows, "mean", ["employment_length_years"]), 6)


@query("cap_outliers_by_group", ["clean_customers"], "SELECT customer_id, city_tier, annual_income FROM clean_customers")
def cap_outliers_by_group(i):
    out = clean.cap_outliers_by_group(i.customers, "annual_income", ["city_tier"])
    return out.select("customer_id", "city_tier", "annual_income")


def _capped(c: str, value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN NULL ELSE least(greatest({value}, {c}_q25 - 2.5e0*({c}_q75 - {c}_q25)), {c}_q75 + 2.5e0*({c}_q75 - {c}_q25)) END"


_MANY = [c for c in _CUSTOMER_NUMBERS if c != "existing_debts_count"]


def _quartiles(source: str) -> str:
    return "SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {p}e-2) AS {c}_q{p}" for c in _MANY for p in (25, 75)) + f" FROM {source}"


@query("cap_outliers_global", ["customers"], f"""
SELECT customer_id, {", ".join(f"{_capped(c, f'CAST({c} AS DOUBLE)')} AS {c}" for c in _MANY)}, CAST(existing_debts_count AS DOUBLE) AS existing_debts_count
FROM customers, q""", extra={"q": _quartiles("customers")})
def cap_outliers_global(i):
    """Every numeric column of customers but the id; existing_debts_count has only seven values, so it stays."""
    return clean.cap_outliers_global(i.customers, exclude=["customer_id"]).select("customer_id", *_CUSTOMER_NUMBERS)


@query("clean_table", ["customers"], f"""
SELECT customer_id, {", ".join(f"round({_capped(c, 'filled.' + c)}, 4) AS {c}" for c in _MANY)}, existing_debts_count,
  {", ".join(f"coalesce({c}, (SELECT {c} FROM modes)) AS {c}" for c in _CUSTOMER_TEXTS)}, 25000e0 AS loan_amount, 0 AS default_flag
FROM filled, q""", extra={
    "medians": f"SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}' for c in _CUSTOMER_NUMBERS)} FROM customers",
    "filled": f"""SELECT customer_id, {", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT {c} FROM medians)) AS {c}" for c in _CUSTOMER_NUMBERS)},
  {", ".join(_CUSTOMER_TEXTS)} FROM customers""",
    "q": _quartiles("filled"),
    "modes": "SELECT " + ", ".join(f"(SELECT {c} FROM customers WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS {c}"
                                   for c in _CUSTOMER_TEXTS)})
def clean_table(i):
    """All twelve columns of customers, every row twice before."""
    out = clean.clean_table(i.customers.unionByName(i.customers), exclude=["customer_id"])
    return rounded(out.select("customer_id", *_CUSTOMER_NUMBERS, *_CUSTOMER_TEXTS, "loan_amount", "default_flag"))


_LABELS = {
    "loan_type": ["Auto Loan", "Business Loan", "Education Loan", "Home Loan", "Personal Loan"],
    "collateral_type": ["Equipment", "None", "Residential Property", "Third Party Guarantee", "Vehicle"],
    "loan_purpose": ["Debt Consolidation", "Refinancing", "Working Capital"],
    "origination_channel": ["Branch Network", "DSA / Direct Selling Agent", "Digital Portal", "Mobile App", "Tele-Sales"],
}


def _dummy_sql(sep, skip):
    cells = [f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}{sep}{v}\"""" for c, vs in _LABELS.items() for v in vs[skip:]]
    return f"SELECT loan_id, {', '.join(cells)} FROM loans"


@query("one_hot_encode", ["loans"], _dummy_sql("=", 0))
def one_hot_encode(i):
    """Every text column of loans."""
    names = clean.text_columns(i.loans)
    return features.one_hot_encode(i.loans.select("loan_id", *names), names).drop(*names)


@query("dummies_drop_first", ["loans"], _dummy_sql("_", 1))
def dummies_drop_first(i):
    return features.dummies_drop_first(i.loans.select("loan_id", *clean.text_columns(i.loans)))


_SCALED = {"s": "SELECT " + ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _LOAN_NUMBERS) + " FROM loans"}


@query("standard_scale", ["loans"], f"""
SELECT loan_id, {", ".join(f"round(({c} - m_{c})/s_{c}, 6) AS {c}" for c in _LOAN_NUMBERS)} FROM loans, s""", extra=_SCALED)
def standard_scale(i):
    """Every numeric column of loans but the ids."""
    return rounded(features.standard_scale(i.loans.select("loan_id", *_LOAN_NUMBERS), _LOAN_NUMBERS), 6)


@query("scaled_copies", ["loans"], f"""
SELECT loan_id, {", ".join(_LOAN_NUMBERS)}, {", ".join(f"round(({c} - m_{c})/s_{c}, 3) AS {c}_scaled" for c in _LOAN_NUMBERS)} FROM loans, s""",
       extra=_SCALED)
def scaled_copies(i):
    return features.scaled_copies(i.loans.select("loan_id", *_LOAN_NUMBERS), _LOAN_NUMBERS)


_FIRST = ["loan_id", "customer_id", "loan_amount", "interest_rate", "loan_term_months", "collateral_value"]
_STAGE_LABELS = {c: vs for c, vs in _LABELS.items()}


@query("engineer_features", ["loans"], f"""
SELECT loans.loan_id, round(loan_amount*0.35e0/50000e0, 4) AS dti_ratio, round((1e0 - 650e0/850e0)*40e0, 2) AS delinquency_severity_score,
  {", ".join(f"round(({c} - m_{c})/s_{c}, 3) AS {c}_scaled" for c in _FIRST)},
  {", ".join(f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}\"""" for c, vs in _STAGE_LABELS.items() for v in vs[1:])}
FROM loans, s""", extra={"s": "SELECT " + ", ".join(f"AVG({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FIRST) + " FROM loans"})
def engineer_features(i):
    """The whole feature stage on loans, which have neither incomes nor days overdue."""
    out = features.engineer_features(i.loans, key="loan_id")
    hot = [f"{c}_{v}" for c, vs in _STAGE_LABELS.items() for v in vs[1:]]
    return out.select("loan_id", "dti_ratio", "delinquency_severity_score", *[f"{c}_scaled" for c in _FIRST], *[F.col(f"`{c}`").cast("int").alias(c) for c in hot])


@query("feature_matrix", ["delinquent"], "\nUNION ALL\n".join(
    [f"SELECT loan_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM delinquent" for c in fv.MODEL_NUMERIC]
    + [f"SELECT loan_id, '{c}=' || {c}, 1e0 FROM delinquent" for c in fv.MODEL_CATEGORICAL]))
def feature_matrix(i):
    """The vector of every delinquent account, listed by entry name; zero indicators are left out."""
    rows = i.delinquent.select("loan_id", *fv.MODEL_NUMERIC, *fv.MODEL_CATEGORICAL)
    model = features.feature_matrix().fit(rows)
    names = F.array(*[F.lit(n) for n in features.feature_names(model)])
    cells = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    long = model.transform(rows).select("loan_id", F.explode(cells).alias("c")).select("loan_id", "c.*")
    return long.where((F.col("value") != 0) | ~F.contains("feature", F.lit("=")))


@query("stratified_split", ["scores"], """
SELECT loan_id, label, CAST(CASE WHEN rn <= floor(0.2e0*n + 1e-9) THEN 1 ELSE 0 END AS INT) AS is_test
FROM (SELECT loan_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id) AS rn,
  COUNT(*) OVER (PARTITION BY label) AS n FROM scores)""")
def stratified_split(i):
    return features.stratified_split(i.scores.select("loan_id", "label"), "loan_id", "label", 0.2)


@query("stratified_folds", ["scores"], """
SELECT loan_id, label, CAST((rn > floor(n/3e0)) AS INT) + CAST((rn > floor(2e0*n/3e0)) AS INT) AS fold
FROM (SELECT loan_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id) AS rn,
  COUNT(*) OVER (PARTITION BY label) AS n FROM scores)""")
def stratified_folds(i):
    """The folds of the grid search: three parts of each class, equal but for one row."""
    return hash_folds(i.scores.select("loan_id", "label"), "loan_id", 3, ["label"])


@query("random_split", ["loans"], """
SELECT loan_id, CASE WHEN CAST('0x' || substr(md5(CAST(loan_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 THEN 1 ELSE 0 END AS is_test
FROM loans""")
def random_split(i):
    return features.random_split(i.loans.select("loan_id"), "loan_id", 20)


@query("class_weights", ["scores"], """
SELECT label, COUNT(*) AS n, round((SELECT COUNT(*) FROM scores)/(2e0*COUNT(*)), 6) AS weight,
  round((SELECT COUNT(*) FILTER (label = 0)/CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) FROM scores), 2) AS neg_pos_ratio
FROM scores GROUP BY label""")
def class_weights(i):
    return rounded(features.class_weights(i.scores, "label"), 6)


@query("class_weight_per_row", ["scores"], """
SELECT loan_id, label, round((SELECT COUNT(*) FROM scores)/(2e0*COUNT(*) OVER (PARTITION BY label)), 6) AS weight FROM scores""")
def class_weight_per_row(i):
    return rounded(features.with_class_weight(i.scores.select("loan_id", "label"), "label"), 6)
