"""Scalar rules, cleaning and the standardiser on hand-written rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators import clean, features, joins, policy, profile, reports, segments
from arrearium.operators import standardize as S
from arrearium.sources import readers, writers


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(
        f"{k} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}" for k, v in cols.items()))
    return df.select(expr.alias("r")).first()["r"]


def test_emi_known_and_interest_free(spark):
    emi = X.monthly_emi("a", "r", "n")
    assert one(spark, emi, a=10000.0, r=12.0, n=12) == pytest.approx(888.4879, abs=1e-4)
    assert one(spark, emi, a=1200.0, r=0.0, n=12) == 100.0


def test_clip_keeps_null(spark):
    assert one(spark, X.clip("v", 0.0, 1.0), v=None) is None
    assert one(spark, X.clip("v", 0.0, 1.0), v=7.0) == 1.0


def test_rounding_goes_to_even_on_the_binary_value(spark):
    assert one(spark, X.round_to("v", 2), v=1.005) == 1.0
    assert one(spark, X.round_to("v", 0), v=2.5) == 2.0
    assert one(spark, X.round_to("v", 0), v=3.5) == 4.0


@pytest.mark.parametrize("score,tier", [(0, None), (549, 0), (550, 1), (649, 1), (650, 2), (700, 3), (750, 4), (901, None)])
def test_credit_tier_edges(spark, score, tier):
    want = None if tier is None else fv.CREDIT_TIERS[tier][1]
    assert one(spark, X.credit_risk_tier("s"), s=score) == want


def test_bands_cover_every_probability(spark):
    p = spark.range(0, 1001).select((F.col("id") / 1000.0).alias("p"))
    out = p.select(X.risk_score_band("p").alias("b"), X.risk_grade("p")["grade"].alias("g"))
    assert out.where("b IS NULL OR g IS NULL").count() == 0
    assert out.select("b").distinct().count() == 4 and out.select("g").distinct().count() == 4


def test_unsecured_loans(spark):
    for kind in ("None", None):
        df = spark.createDataFrame([(kind, 100.0, None)], "k string, a double, v double")
        sec = X.is_secured("k")
        assert tuple(df.select(sec, X.ltv_ratio("a", "v", sec)).first()) == (0, 1.0)


def test_targets(spark):
    rows = [("Fully Recovered",), ("Written Off",), ("No Delinquency / Not Applicable",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    assert [r[0] for r in df.select(X.recovery_target("s")).collect()] == [1, 0, None, None]
    assert [r[0] for r in df.select(X.recovery_label("s")).collect()] == [1, 0, 0, 0]


def test_scenarios_order(spark):
    from arrearium.plans.scoring import batch_score, scenario_accounts

    p = {r["scenario"]: r for r in batch_score(scenario_accounts(spark)).collect()}
    assert p["A"]["p"] > p["B"]["p"] > p["C"]["p"]
    assert p["A"]["grade"] == "A" and p["A"]["strategy"] == fv.RISK_GRADES[0][3]


# --- cleaning ----------------------------------------------------------------------------------

def test_group_median_falls_back_and_truncates(spark):
    rows = [("a", 1), ("a", 4), ("a", None), ("b", None), (None, None), (None, 9)]
    df = spark.createDataFrame(rows, "g string, y int")
    got = sorted((str(r["g"]), r["y"]) for r in clean.impute_group_median(df, "y", ["g"], 3).collect())
    assert got == [("None", 3), ("None", 9), ("a", 1), ("a", 2), ("a", 4), ("b", 3)]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("y", None), ("x", None), (None, None)], "a string, b string")
    got = clean.impute_mode(df, ["a", "b"]).collect()
    assert sorted(r["a"] for r in got) == ["x", "x", "y"] and {r["b"] for r in got} == {"Unknown"}


def test_cap_skips_zero_iqr_and_is_idempotent(spark):
    rows = [(0.0 if k < 80 else float(k), float(k) if k else 9999.0) for k in range(100)]
    df = spark.createDataFrame(rows, "flat double, v double")
    once = clean.cap_outliers_global(df)
    assert once.agg(F.max("flat"), F.max("v")).first() == (99.0, pytest.approx(50.5 + 3 * 50, abs=30))
    twice = clean.cap_outliers_global(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    flat = clean.cap_outliers_global(df, skip_zero_iqr=False)
    assert flat.agg(F.max("flat")).first()[0] == 0.0


@pytest.mark.parametrize("strategy,want", [("median", 2.0), ("mean", 3.0), ("zero", 0.0)])
def test_impute_numeric(spark, strategy, want):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (6.0, None), (None, None)], "v double, empty double")
    got = clean.impute_numeric(df, strategy).collect()
    assert {r["v"] for r in got} == {1.0, 2.0, 6.0, want} and {r["empty"] for r in got} == {0.0}


def test_duplicates_and_clean_table(spark):
    rows = [(1, 5.0, "x")] * 30 + [(2, None, None), (3, 7.0, "x")]
    df = spark.createDataFrame(rows, "loan_id int, loan_amount double, region string")
    out = clean.clean_table(df, exclude=["loan_id"])
    assert out.count() == 3 and out.where("loan_amount IS NULL OR region IS NULL").count() == 0


# --- standardiser ------------------------------------------------------------------------------

def test_aliases(spark):
    df = spark.createDataFrame([(1.0, 2, "x", 3)], "`Balance` double, ` DPD ` int, City string, amount int")
    out = S.standardize_columns(df)
    assert out.columns == ["loan_amount", "overdue_days", "region", "amount"]
    kept = spark.createDataFrame([(1.0, 2.0)], "loan_amount double, principal double")
    assert S.standardize_columns(kept).columns == ["loan_amount", "principal"]


def test_whole_words_mode(spark):
    df = spark.createDataFrame([("unpaid",), ("Paid off",), (None,)], "recovery_status string")
    assert [r[-1] for r in S.derive_recovery_flag(df).collect()] == [1, 1, 0]
    assert [r[-1] for r in S.derive_recovery_flag(df, whole_words=True).collect()] == [0, 1, 0]


def test_existing_flag_wins_and_empty_table_stays_empty(spark):
    df = spark.createDataFrame([(7, "paid")], "recovery_status_binary int, recovery_status string")
    assert S.derive_recovery_flag(df).first()["recovery_status_binary"] == 7
    empty = spark.createDataFrame([], "income string, dpd string")
    assert S.standardize_dataset(empty).count() == 0


def test_bad_text_becomes_the_default(spark):
    df = spark.createDataFrame([("12.7", "n/a"), (None, "NaN")], "term string, int_rate string")
    got = S.standardize_dataset(df).select("loan_term_months", "interest_rate", "credit_score", "loan_type").collect()
    assert sorted(map(tuple, got)) == [(12, 12.5, 680.0, "Personal Loan"), (36, 12.5, 680.0, "Personal Loan")]


# --- reports, joins, files ---------------------------------------------------------------------

def test_filters_and_empty_results(spark):
    df = spark.createDataFrame([("a", 5, 1), ("b", 50, 0)], "loan_type string, overdue_days int, recovery_status_binary int")
    assert reports.portfolio_filter(df).count() == 2
    assert reports.portfolio_filter(df, ["a"], 10, 1).count() == 1
    assert reports.portfolio_filter(df, ["a"], 10, 0).count() == 0


def test_zero_denominators(spark):
    df = spark.createDataFrame([("c", 0.0, 5.0, 0.0, 1)], "primary_channel string, outstanding_principal double, "
                               "recovered_amount double, recovery_cost double, contact_attempts int")
    row = reports.channel_performance(df).first()
    assert row["recovery_rate_pct"] is None and row["roi_multiple"] == 5.0


@settings(max_examples=8, deadline=None)
@given(cells=st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(fv.STAGE_LABELS)), min_size=1, max_size=30))
def test_row_percentages_sum_to_100(spark, cells):
    out = reports.mix_by(spark.createDataFrame(cells, "region string, delinquency_bucket string")).collect()
    for r in out:
        assert sum(r[f"pct_{k}"] for k in range(1, 6)) == pytest.approx(100.0)


def test_top_bottom_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "k string, v double")
    assert [r["k"] for r in reports.top_bottom_k(df, "v", 5, "k").collect()] == ["a", "b", "c"]


def test_histogram_has_empty_bins_and_every_row(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (None,)], "v double")
    assert [r["n"] for r in profile.histogram(df, "v", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["n"] for r in profile.histogram(same, "v", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_loan_without_customer_match_is_dropped(spark):
    loans = spark.createDataFrame([(1, 10), (2, 10), (3, None)], "loan_id int, customer_id int")
    rep = spark.createDataFrame([(1, 10, 5), (2, 11, 6), (3, None, 7)], "loan_id int, customer_id int, x int")
    assert [tuple(r) for r in joins.join_loans_repayments(loans, rep).collect()] == [(1, 10, 5)]


def test_unknown_category_gives_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fit = Pipeline(stages=features.encoder_stages(["c"])).fit(spark.createDataFrame([("a",), ("b",)], "c string"))
    got = fit.transform(spark.createDataFrame([("b",), ("z",), (None,)], "c string")).select(vector_to_array("c_hot"))
    assert [list(r[0]) for r in got.collect()] == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_nearest_centroid_tie_takes_the_first(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (9.0,)], "x double")
    got = segments.assign_nearest_centroid(df, ["x"], {0: [0.0], 1: [10.0]}).orderBy("x").collect()
    assert [r["cluster_id"] for r in got] == [0, 0, 1]


def test_collector_takes_the_stricter_row(spark):
    df = spark.createDataFrame([(0.9, 10), (0.9, 200), (0.2, 10)], "p double, overdue_days int")
    assert sorted(r["rank"] for r in policy.collector_allocation(df).collect()) == [1, 4, 4]


def test_csv_round_trip(spark, tmp_path):
    rows = [("L1", "C1", "Auto Loan", 10.5, 7.0, 12, "2021-03-04", "None", None, "x", "y"),
            ("L2", "C1", "Auto Loan", 10.5, 7.0, 12, "bad", "Vehicle", 5.0, "x", "y")]
    from arrearium.schemas import RAW_SCHEMAS

    for name, schema in RAW_SCHEMAS.items():
        df = spark.createDataFrame(rows if name == "loans" else [], schema)
        writers.write_tables({name: df}, str(tmp_path), "csv")
    back = readers.read_raw_tables(spark, str(tmp_path))["loans"].orderBy("loan_id").collect()
    assert str(back[0]["disbursement_date"]) == "2021-03-04" and back[1]["disbursement_date"] is None
    assert back[0]["collateral_type"] == "None" and back[0]["collateral_value"] is None


def test_missing_paths_are_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_first_existing(spark, [f"{tmp_path}/a.parquet", f"{tmp_path}/b.csv"])


def test_numbers_that_do_not_fit_become_the_default(spark):
    from arrearium.operators.standardize import coerce_numeric

    df = spark.createDataFrame([("inf",), ("9999999999",), ("12",), ("x",), (None,)], "overdue_days string")
    assert [r[0] for r in coerce_numeric(df, {"overdue_days": 0}).collect()] == [0, 0, 12, 0, 0]


def test_cap_counts_few_distinct_values_exactly(spark):
    from pyspark.sql import functions as F

    from arrearium.operators import clean

    # Ten near values and one far; some such eleven meet in a register of the approximate count.
    both = F.explode(F.concat(F.sequence(F.col("id") * 10, F.col("id") * 10 + 9), F.array(F.col("id") + 10**6))).alias("v")
    groups = spark.range(3_000).select("id", both)
    unlucky = groups.groupBy("id").agg(F.approx_count_distinct("v", 0.01).alias("n")).where("n = 10").agg(F.min("id")).first()[0]
    rows = groups.where(F.col("id") == unlucky).select("v", F.col("v").cast("decimal(20,2)").alias("d"), F.lit(1.5).alias("one"))
    capped = clean.cap_outliers_global(rows)
    assert capped.agg(F.max("v"), F.max("d"), F.max("one")).first()[:] == (unlucky * 10 + 20.0, unlucky * 10 + 20.0, 1.5)
    ten = clean.cap_outliers_global(rows.where(F.col("v") != unlucky * 10))
    assert ten.agg(F.max("v")).first()[0] == unlucky + 10**6
    counts = spark.range(20_000).select((F.col("id") % 11).cast("int").alias("a"), "id", (F.col("id") % 10 / 7).alias("f"), F.lit(None).cast("int").alias("z"))
    n = counts.agg(*[clean.distinct_beyond(counts, c, 10).alias(c) for c in counts.columns]).first()
    assert (n["a"], n["f"], n["z"]) == (11, 10, 0) and n["id"] > 10_000
