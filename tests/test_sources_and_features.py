"""Untyped files, the feature stage, label limits and filters that leave nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from arrearium.operators import features, reports
from arrearium.sources import readers


def test_types_of_an_untyped_file(spark, tmp_path):
    text = """i,l,d,s,b,day,at,none,mixed,late
1,5000000000,1.5,x,true,2024-01-01,2024-01-01 10:00:00,,1,7
-2,3,2,12d,FALSE,2024-02-30x,2024-01-02T11:00:00,,x,7
3,,1e3,,,,,,2024-01-01,oops
"""
    (tmp_path / "t.csv").write_text(text.replace("2024-02-30x", "2024-02-28"))
    df = readers.read_untyped_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"i": "int", "l": "bigint", "d": "double", "s": "string", "b": "boolean", "day": "date", "at": "timestamp",
                               "none": "string", "mixed": "string", "late": "string"}
    rows = df.orderBy("i").collect()
    assert rows[0]["i"] == -2 and rows[2]["d"] == 1000.0 and rows[1]["day"] == dt.date(2024, 1, 1) and rows[2]["l"] is None
    (tmp_path / "u.csv").write_text(text)
    assert dict(readers.read_untyped_csv(spark, str(tmp_path / "u.csv")).dtypes)["day"] == "string"


def test_broken_lines_are_kept_and_teach_nothing(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\nx,y,z\n3,4\n")
    df = readers.read_untyped_csv(spark, str(tmp_path / "t.csv"), rescue="_line")
    assert dict(df.dtypes) == {"a": "int", "b": "int", "_line": "string"}
    assert {(r["a"], r["b"], r["_line"]) for r in df.collect()} == {(1, 2, None), (3, 4, None), (None, None, "x,y,z")}


def test_an_empty_file_has_its_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    df = readers.read_untyped_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["a", "b"] and df.count() == 0


def test_labels_at_the_limit(spark):
    df = spark.range(60_000).select(F.concat(F.lit("v"), F.col("id") % 30).alias("thirty"), F.concat(F.lit("v"), F.col("id") % 29).alias("few"),
                                    F.col("id").cast("string").alias("many"))
    out = features.dummies_drop_first(df, max_levels=30)
    assert [c for c in out.columns if not c.startswith("few_")] == ["thirty", "many"] and sum(c.startswith("few_") for c in out.columns) == 28
    found = features.few_labels(df, df.columns, 30)
    assert len(found["thirty"]) == 30 and len(found["few"]) == 29 and found["many"] is None
    with pytest.raises(ValueError, match="more than 10000 labels in many"):
        features.one_hot_encode(df, ["few", "many"])
    assert len(reports.filter_options(df.withColumn("overdue_days", F.lit(3)), "few").first()["options"]) == 29
    with pytest.raises(Exception, match="more than 50 labels"):
        reports.filter_options(df.withColumn("overdue_days", F.lit(3)), "many", most=50).collect()


def test_empty_filter_results(spark):
    df = spark.createDataFrame([("Auto Loan", 5), ("Home Loan", 50)], "loan_type string, overdue_days int")
    assert reports.portfolio_filter(df, ["No Loan"]).count() == 0
    assert reports.portfolio_filter(df, ["No Loan"], on_empty="all").count() == 2
    assert reports.portfolio_filter(df, ["Auto Loan"], on_empty="all").count() == 1
    with pytest.raises(ValueError):
        reports.portfolio_filter(df, on_empty="some")


def test_feature_stage(spark):
    rows = [(k, 1000.0 * k, 500.0 if k == 1 else 40_000.0 + k, 30 * k, 600 + k, "Auto Loan" if k % 2 else "Home Loan", f"name {k}", 1, 2, 3, 4, 5) for k in range(40)]
    df = spark.createDataFrame(rows, "loan_id int, loan_amount double, annual_income double, overdue_days int, credit_score int, loan_type string, note string, "
                                     "a int, b int, c int, e int, f int")
    out = features.engineer_features(df, key="loan_id")
    got = {r["loan_id"]: r for r in out.collect()}
    assert got[1]["dti_ratio"] == 0.35 and got[2]["delinquency_severity_score"] == round(60 / 360 * 60 + (1 - 602 / 850) * 40, 2)
    assert "loan_type_Home Loan" in out.columns and "note" in out.columns
    scaled = [c for c in out.columns if c.endswith("_scaled")]
    assert scaled == [f"{c}_scaled" for c in ("loan_id", "loan_amount", "annual_income", "overdue_days", "credit_score", "a", "b", "c")]
    mean, sd = 19.5, (sum((k - 19.5) ** 2 for k in range(40)) / 40) ** 0.5
    assert got[3]["loan_id_scaled"] == round((3 - mean) / sd, 3) and got[3]["a_scaled"] == 0.0
    plain = features.engineer_features(df.select("loan_id", "note"), encode=False, scale=False, key="loan_id")
    assert plain.first()["dti_ratio"] == 0.175
