"""Order statistics, running totals and look-back windows against brute force, with hot keys."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrearium.operators import policy, stats, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds two thirds of the rows and one value a third of that group."""
    rng = np.random.default_rng(7)
    n = 40_000
    group = np.where(rng.random(n) < 0.66, "hot", rng.choice(["a", "b", "c"], n))
    value = np.round(rng.lognormal(10, 1, n), 2)
    value[(group == "hot") & (rng.random(n) < 0.33)] = 20000.0
    pdf = pd.DataFrame({"g": group, "v": value, "k": np.arange(n)})
    pdf.loc[::50, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).persist()


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_grouped_quantiles_are_exact(skewed):
    pdf, df = skewed
    got = {r["g"]: r for r in stats.quantiles(df, ["v"], PROBS, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        known = part["v"].dropna()
        assert got[g]["n"] == len(known)
        np.testing.assert_allclose(got[g]["q"], np.quantile(known, PROBS), rtol=1e-12)


def test_global_quantiles_are_exact(skewed):
    pdf, df = skewed
    got = {r["column"]: r["q"] for r in stats.quantiles(df, ["v", "k"], PROBS).collect()}
    np.testing.assert_allclose(got["v"], np.quantile(pdf["v"].dropna(), PROBS), rtol=1e-12)
    np.testing.assert_allclose(got["k"], np.quantile(pdf["k"], PROBS), rtol=1e-12)


def test_quantiles_of_sorted_partitions(spark):
    """Each task sees another range of values, so the lots disagree as far as they can."""
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") % 40_000).cast("double").alias("v"))
    want = np.quantile(np.arange(50_000) % 40_000, PROBS)
    np.testing.assert_allclose(stats.quantiles(df, ["v"], PROBS).first()["q"], want, rtol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_quantiles_of_few_rows(spark, n):
    values = [float(3 * x % 11) for x in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert stats.quantiles(df, ["v"], PROBS).first()["q"] == pytest.approx(list(np.quantile(values, PROBS)))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, None)], "g string, v double")
    assert stats.quantiles(df, ["v"], [0.5], ["g"]).count() == 0
    assert stats.quantiles(df, ["v"], [0.5]).count() == 0


def test_groups_beyond_the_broadcast_limit_still_join(skewed):
    pdf, df = skewed
    small = df.groupBy("g").agg(F.count("*").alias("n"))
    for limit in (1, 100):
        out = df.join(stats.bounded_side(small, limit), "g").agg(F.sum("n")).first()[0]
        assert out == (pdf.groupby("g").size() ** 2).sum()


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(skewed, descending):
    pdf, df = skewed
    counts = df.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"), F.sum("k").alias("s"))
    got = stats.running_totals(counts, "v", ["n", "s"], descending).toPandas().sort_values("v", ascending=not descending)
    assert (got["n"].cumsum() == got["upto_n"]).all()
    assert (got["s"].cumsum() == got["upto_s"]).all()
    assert len(got) == pdf["v"].nunique()


def test_share_by_hash_is_the_head_of_the_hash_order(skewed):
    import hashlib

    pdf, df = skewed
    got = stats.first_share_by_hash(df.select("g", "k"), "k", 0.2, ["g"]).toPandas()
    got["h"] = [hashlib.md5(str(k).encode()).hexdigest() for k in got["k"]]
    for _, part in got.sort_values("h").groupby("g"):
        want = int(0.2 * len(part))
        assert part["is_test"].tolist() == [1] * want + [0] * (len(part) - want)


@pytest.fixture(scope="module")
def timeline(spark):
    """An account with a third of all events, equal times, gaps and burst."""
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(1500):
        account = 1 if k % 3 == 0 else rnd.randrange(2, 40)
        at = start + dt.timedelta(hours=rnd.randrange(0, 24 * 300))
        rows.append((k, account, at, rnd.randrange(500, 700), rnd.randrange(2)))
    return rows, spark.createDataFrame(rows, "event_id long, account_id long, ts timestamp, score int, kept int").persist()


def _look_back(rows, days):
    for r in rows:
        yield r, [q for q in rows if q[1] == r[1] and r[2] - dt.timedelta(days=days) <= q[2] <= r[2]]


def test_rolling_count(timeline):
    rows, df = timeline
    got = {r["event_id"]: r["n"] for r in windows.rolling_count(df, "account_id", "ts", 7, "n").collect()}
    assert got == {r[0]: len(w) for r, w in _look_back(rows, 7)}


def test_rolling_max(timeline):
    rows, df = timeline
    got = {r["event_id"]: r["m"] for r in windows.rolling_max(df, "account_id", "ts", "score", 90, "m").collect()}
    assert got == {r[0]: max(q[3] for q in w) for r, w in _look_back(rows, 90)}


def test_previous_value(timeline):
    rows, df = timeline
    got = {r["event_id"]: r["p"] for r in windows.previous_value(df, "account_id", "ts", "kept", "event_id", "p").collect()}
    want = {}
    for account in {r[1] for r in rows}:
        last = None
        for r in sorted((r for r in rows if r[1] == account), key=lambda r: (r[2], r[0])):
            want[r[0]], last = last, r[4]
    assert got == want


def test_previous_value_keeps_null_values_apart_from_no_event(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, 1, day, 5), (2, 1, day + dt.timedelta(days=60), None), (3, 1, day + dt.timedelta(days=61), 6)]
    df = spark.createDataFrame(rows, "event_id long, account_id long, ts timestamp, v int")
    got = {r["event_id"]: r["p"] for r in windows.previous_value(df, "account_id", "ts", "v", "event_id", "p").collect()}
    assert got == {1: None, 2: 5, 3: None}


def test_psi_of_equal_populations_is_zero(skewed):
    _, df = skewed
    both = df.withColumn("base", F.lit(True)).unionByName(df.withColumn("base", F.lit(False)))
    psi = policy.stability_index(policy.population_stability(both, "v", F.col("base"))).first()
    assert psi["psi"] == pytest.approx(0.0, abs=1e-12) and psi["alert"] == 0


def test_windows_with_nulls_and_repeated_ids(spark):
    from pyspark.sql import Window as W

    rows = [(1, 10, "2024-01-01", 1), (1, 11, "2024-01-02", 100), (2, 10, None, 7), (None, 10, "2024-02-01", 5), (3, None, "2024-02-01", 9),
            (4, None, "2024-02-03", 2), (5, 10, "2024-03-20", 3), (5, 10, "2024-03-20", 3), (6, 10, "2024-07-01", 4)]
    df = spark.createDataFrame(rows, "event_id int, account_id int, d string, v int").selectExpr("event_id", "account_id", "to_timestamp(d) ts", "v").coalesce(1)
    at = F.unix_micros("ts")
    plain = df.withColumn("m", F.max("v").over(W.partitionBy("account_id").orderBy(at).rangeBetween(-90 * 86_400_000_000, 0)))
    assert sorted(map(str, windows.rolling_max(df, "account_id", "ts", "v", 90, "m").collect())) == sorted(map(str, plain.collect()))
    plain = df.withColumn("p", F.lag("v").over(W.partitionBy("account_id").orderBy("ts", "event_id")))
    got = windows.previous_value(df, "account_id", "ts", "v", "event_id", "p").collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("folds", [2, 3, 7])
def test_folds_of_every_class_differ_by_one_row_at_most(spark, folds):
    import hashlib

    rows = [(k, None if k % 11 == 0 else k % 3 if k > 5 else 9) for k in range(2_000)]
    got = stats.hash_folds(spark.createDataFrame(rows, "k long, label int"), "k", folds, ["label"])
    assert got.columns == ["k", "label", "fold"]
    by = {}
    for r in got.collect():
        by.setdefault(r["label"], []).append((hashlib.md5(str(r["k"]).encode()).hexdigest(), r["fold"]))
    assert sum(map(len, by.values())) == 2_000
    for held in by.values():
        n = len(held)
        want = [sum(rank >= n * j // folds for j in range(1, folds)) for rank in range(n)]
        assert [f for _, f in sorted(held)] == want


def test_sortable_image_keeps_every_double(spark):
    rng = np.random.default_rng(4)
    some = np.concatenate([2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1000, 1024), 0), rng.integers(0, 0x7FF << 52, 3_000).view(np.float64),
                           [0.0, np.inf, np.finfo(float).max, np.finfo(float).tiny]])
    some = np.concatenate([some, -some])
    df = spark.createDataFrame([(float(x),) for x in some], "x double")
    got = df.select("x", stats.sortable(F.col("x")).alias("at")).withColumn("back", stats.from_sortable(F.col("at"))).toPandas()
    bits = got["x"].to_numpy().view(np.int64)
    want = np.where(bits < 0, -(bits & 0x7FFFFFFFFFFFFFFF), bits)
    assert (got["at"].to_numpy() == want).all() and (got["back"] == got["x"]).all()


@pytest.mark.parametrize("kind", ["random", "sorted", "constant", "continuous", "signs"])
def test_no_task_orders_more_than_a_constant(spark, kind, monkeypatch):
    """Whatever the size, what is left to be ordered of a node is bounded, and the quantiles are exact."""
    most = []
    gather = 500
    deeper = stats._deeper
    for n in (1_000, 10_000, 60_000):
        rng = np.random.default_rng(n)
        x = {"random": lambda: rng.integers(0, 1_000_000, n).astype(float), "sorted": lambda: np.arange(n) * 1.5, "constant": lambda: np.full(n, 7.25),
             "continuous": lambda: rng.normal(1e6, 1e-3, n), "signs": lambda: rng.normal(0, 1e3, n)}[kind]()
        df = spark.createDataFrame(pd.DataFrame({"value": x})).select(F.lit("v").alias("column"), stats.sortable(F.col("value")).alias("_at"))
        last = []
        monkeypatch.setattr(stats, "_deeper", lambda *a: last.append(deeper(*a)) or last[-1])
        _, ranked = stats.multi_select(df, ["column"], PROBS, gather=gather)
        got = {r["rank"]: r["value"] for r in ranked.collect()}
        ordered = np.sort(x)
        assert all(ordered[k] == v for k, v in got.items())
        assert set(got) == {int(f(p * (n - 1))) for p in PROBS for f in (np.floor, np.ceil)}
        most.append(max([r["n"] for r in last[-1].groupBy("_node").agg(F.count("*").alias("n")).collect()], default=0))
    assert max(most) <= gather


@pytest.mark.parametrize("gather", [10, 400])
def test_running_totals_in_leaves(spark, gather):
    rng = np.random.default_rng(9)
    x = np.unique(np.concatenate([rng.normal(0, 1, 2_000), rng.uniform(5, 5 + 1e-9, 500), [-1e300, 1e300, 0.0]]))
    n = rng.integers(1, 9, len(x))
    df = spark.createDataFrame(pd.DataFrame({"v": x, "n": n}))
    got = stats.running_totals(df, "v", ["n"], True, gather).toPandas().sort_values("v", ascending=False)
    assert (got["n"].cumsum() == got["upto_n"]).all() and (got["total_n"] == n.sum()).all() and len(got) == len(x)
    placed = stats.leaves(df.withColumn("_at", stats.sortable(F.col("v"))), [], {"n": (F.sum("n"), "sum")}, gather=gather)
    assert placed.groupBy("_leaf").count().agg(F.max("count")).first()[0] <= gather


def _plain_windows(df, days):
    from pyspark.sql import Window as W

    at = F.unix_micros("ts")
    w = W.partitionBy("account_id").orderBy(at).rangeBetween(-days * 86_400_000_000, 0)
    lag = F.lag("score").over(W.partitionBy("account_id").orderBy("ts", "event_id"))
    return {"n": df.withColumn("n", F.count("*").over(w)), "m": df.withColumn("m", F.max("score").over(w)), "p": df.withColumn("p", lag)}


@pytest.mark.parametrize("gather", [30, 1_000_000])
def test_an_account_with_a_third_of_all_events_in_one_day(spark, gather):
    """Hot accounts, moments and missing times and accounts: the same rows as plain windows, whether the scan is taken or not."""
    rnd = random.Random(5)
    start, rows = dt.datetime(2024, 3, 1), []
    for k in range(1_800):
        account = 1 if k % 3 == 0 else None if k % 50 == 1 else rnd.randrange(2, 30)
        at = start + (dt.timedelta(seconds=rnd.randrange(86_400)) if account == 1 else dt.timedelta(hours=rnd.randrange(24 * 200)))
        if k % 30 == 0:
            at = start + dt.timedelta(hours=7)  # one moment of many events
        rows.append((k, account, None if k % 41 == 0 else at, None if k % 17 == 0 else rnd.randrange(500, 700)))
    rows += [(9_000, 1, start - dt.timedelta(days=7), 999), (9_001, 1, start + dt.timedelta(days=91), 1), (9_002, None, None, 3)]
    df = spark.createDataFrame(rows, "event_id long, account_id long, ts timestamp, score int")
    for days in (7, 90):
        plain = _plain_windows(df, days)
        got = {"n": windows.rolling_count(df, "account_id", "ts", days, "n", gather=gather),
               "m": windows.rolling_max(df, "account_id", "ts", "score", days, "m", gather=gather)}
        for name, want in plain.items():
            if name in got:
                assert sorted(map(str, got[name].collect())) == sorted(map(str, want.collect())), (name, days)
    got = windows.previous_value(df, "account_id", "ts", "score", "event_id", "p", gather=gather)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain["p"].collect()))


def test_hot_accounts_are_spread(spark):
    """Moments of an account within one second are cut into leaves of a bounded number of rows."""
    events = spark.range(20_000).select((F.col("id") % 2).alias("_k"), (F.col("id") * 50).alias("_at"))
    cut = stats.leaves(events, ["_k"], {"n": (F.count("*"), "sum")}, gather=700)
    sizes = cut.groupBy("_k", "_leaf").agg(F.count("*").alias("n"), F.min("o_n").alias("before"), F.min("_at").alias("lo")).orderBy("_k", "lo").collect()
    assert max(r["n"] for r in sizes) <= 700
    for k in (0, 1):
        at = 0
        for r in (r for r in sizes if r["_k"] == k):
            assert (r["before"] or 0) == at
            at += r["n"]


def test_shuffle_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    from arrearium import session

    first, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 20_000)
    before = spark.conf.get(first, None), spark.conf.get(merged, None)
    seen = []
    try:
        for n in (100, 200_000):
            path = f"{tmp_path}/{n}"
            spark.range(n).selectExpr("id", "rand(1) AS x").write.parquet(path)
            session.size_shuffles(spark, [path, f"{tmp_path}/absent"])
            seen.append(int(spark.conf.get(first)))
            assert int(spark.conf.get(merged)) == session.MERGED_PARTITION
            rows = spark.read.parquet(path).groupBy("id").count()
            rows.collect()
            assert f"hashpartitioning(id#{rows._jdf.queryExecution().executedPlan().toString().split('hashpartitioning(id#')[1].split(',')[0]}, {seen[-1]})" in (
                rows._jdf.queryExecution().executedPlan().toString())
    finally:
        for key, value in zip((first, merged), before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert seen[0] == int(spark.conf.get("spark.sql.shuffle.partitions")) and seen[1] > 50


def test_merged_partitions_stay_small_enough_to_sort(spark, tmp_path, monkeypatch):
    from arrearium import session

    keys = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = [spark.conf.get(key, None) for key in keys]
    try:
        session.size_shuffles(spark, [f"{tmp_path}/absent"])
        spark.conf.set(keys[0], 200)
        rows = spark.range(16_000_000).select(F.xxhash64("id").alias("x")).repartition("x")  # 128 MB that do not compress
        n = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in zip(keys, before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(n) >= 15 and max(r["count"] for r in n) <= 1_200_000  # 2 million and more before


def test_the_sortable_image_is_computed_once(spark):
    """The expression is not copied into filters and columns made of it: one in the plan, below what uses it."""
    df = spark.range(10).select(stats.sortable(F.col("id").cast("double")).alias("_at"))
    used = df.select("_at", (F.col("_at") + 1).alias("a"), F.shiftright("_at", 48).alias("b")).where("b > 3 and a is not null")
    optimized = used._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("doubleToLongBits") == 1
    rows = spark.createDataFrame([(None,), (-0.0,), (1.0,), (-1.0,)], "v double").select(stats.sortable(F.col("v"))).collect()
    assert [r[0] for r in rows] == [None, 0, 0x3FF << 52, -(0x3FF << 52)]


def test_the_scores_of_the_pipeline_are_stored(spark, sf_dir, monkeypatch):
    from arrearium.plans import pipeline
    from catalog.registry import Inputs

    names, store = [], pipeline.stored
    monkeypatch.setattr(pipeline, "stored", lambda df, name: (names.append(name), store(df, name))[1])
    book = Inputs(spark, sf_dir).book.select("loan_id", "credit_score", "overdue_days", "loan_amount")
    result = pipeline.run_pipeline(book, "loan_id", trees=2, depth=2)
    assert names == ["prepared", "scores"] and result.scores.count() == result.metrics.first()["n"]
