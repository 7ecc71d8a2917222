"""Stream = batch whatever the arrival order; and plans keep their shape."""

import datetime as dt
import random

import pytest

from arrearium.operators import evaluate, policy, reports
from arrearium.operators import stats
from arrearium.plans.master import filter_delinquent
from arrearium.streaming import alerts, ingest
from catalog.all_queries import QUERIES
from catalog.registry import Inputs


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    rows = [(k, 1 if k % 3 == 0 else None if k % 20 == 1 else rnd.randrange(0, 12), start + dt.timedelta(hours=rnd.randrange(0, 24 * 120)),
             rnd.randrange(500, 700), rnd.randrange(2)) for k in range(600)]
    return rows


COLUMNS = "event_id long, account_id long, ts timestamp, score int, kept int"


def stream_of(spark, rows, folder, shuffle_within):
    """Files arrive by time, but rows inside `shuffle_within` hours come in any order."""
    rnd = random.Random(2)
    rows = sorted(rows, key=lambda r: r[2] + dt.timedelta(hours=rnd.uniform(0, shuffle_within)))
    # a last event far ahead lets the watermark pass all others
    rows.append((10**9, 10**9, rows[-1][2] + dt.timedelta(days=30), 0, 1))
    for n in range(0, len(rows), 100):
        spark.createDataFrame(rows[n:n + 100], COLUMNS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return (spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))


def collect(spark, out, folder):
    out.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").where("event_id < 1000000000").collect()
    return {r["event_id"]: (r["account_id"], r["measure"], r["alert"]) for r in rows}


def test_streams_equal_batch(spark, events, tmp_path):
    batch = spark.createDataFrame(events, COLUMNS)
    cases = [
        ("cap", lambda s: alerts.contact_cap_stream(s.withColumnRenamed("ts", "contact_ts"), delay="3 days"),
         policy.contact_cap(batch.withColumnRenamed("ts", "contact_ts")), "contacts_in_window", "over_cap"),
        ("drop", lambda s: alerts.score_drop_stream(s.withColumnRenamed("ts", "score_ts"), delay="3 days"),
         policy.score_drop_alert(batch.withColumnRenamed("ts", "score_ts")), "score_drop", "alert"),
        ("promise", lambda s: alerts.broken_promise_stream(s.withColumnRenamed("ts", "promise_ts"), delay="3 days"),
         policy.broken_promise_alert(batch.withColumnRenamed("ts", "promise_ts")).fillna(1, ["previous_kept"]),
         "previous_kept", "alert"),
    ]
    for name, form, want, measure, flag in cases:
        folder = f"{tmp_path}/{name}"
        got = collect(spark, form(stream_of(spark, events, folder, 48)), folder)
        assert got == {r["event_id"]: (r["account_id"], r[measure], r[flag]) for r in want.collect()}, name


def test_state_falls_back_and_the_last_events_come(spark, tmp_path):
    """Once the watermark is past the window, no account holds state; every event has been judged by then."""
    start = dt.datetime(2024, 1, 1)
    rows = [(k, k % 5, start + dt.timedelta(hours=k), 600 + k % 7, k % 2) for k in range(60)]
    far = [(10**9 + n, 10**9, start + dt.timedelta(days=100 * (n + 1)), 0, 1) for n in range(3)]
    for n, part in enumerate([rows, *[[f] for f in far]]):
        spark.createDataFrame(part, COLUMNS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = alerts.contact_cap_stream(stream.withColumnRenamed("ts", "contact_ts"), delay="2 days")
    run = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    assert max(held) >= 5 and held[-1] <= 1  # a list counts once
    got = {r["event_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got >= {r[0] for r in rows}


def test_ingest_keeps_the_latest_row_and_repeats_safely(spark, tmp_path):
    schema = "loan_id int, day int, overdue_days int"
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    days = [[(1, 0, 5), (2, 0, 40)], [(1, 1, 35)], [(3, 2, 0)], [(2, 3, 0)], [(1, 2, 36), (3, 2, 99)], [(1, 0, 0)]]
    latest = {}
    for n, rows in enumerate(days):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        for _ in range(2):  # the second run finds nothing new
            stream = spark.readStream.schema(schema).parquet(src)
            ingest.daily_ingest(stream, out, "loan_id", "day", filter_delinquent, merge_every=3).awaitTermination()
        for loan, day, overdue in rows:
            if day >= latest.get(loan, (-1, 0))[0]:
                latest[loan] = (day, overdue)
        got = {r["loan_id"]: (r["day"], r["overdue_days"]) for r in ingest.latest_rows(spark, out, "loan_id", "day").collect()}
        assert got == latest
        late = {r["loan_id"] for r in ingest.current_alerts(spark, out).collect()}
        assert late == {k for k, (_, overdue) in latest.items() if overdue > 30}, "withdrawn once cured"
        base, deltas = ingest.manifest(spark, out)
        assert len(deltas) < 3
    assert spark.read.parquet(f"{out}/accounts").count() == sum(map(len, days))


def test_a_batch_tried_again_changes_nothing(spark, tmp_path):
    """A driver lost between the snapshot and the manifest: the batch runs again under its number."""
    schema = "loan_id int, day int, overdue_days int"
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    calls = []

    def failing(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return filter_delinquent(df)

    for n, rows in enumerate([[(1, 0, 50)], [(1, 1, 60), (2, 1, 70)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run = ingest.daily_ingest(spark.readStream.schema(schema).parquet(src), out, "loan_id", "day", failing)
        if n == 1:
            with pytest.raises(Exception, match="lost"):
                run.awaitTermination()
            assert {r["loan_id"] for r in ingest.latest_rows(spark, out, "loan_id", "day").collect()} == {1}
            run = ingest.daily_ingest(spark.readStream.schema(schema).parquet(src), out, "loan_id", "day", failing)
        run.awaitTermination()
    assert {r["loan_id"]: r["overdue_days"] for r in ingest.latest_rows(spark, out, "loan_id", "day").collect()} == {1: 60, 2: 70}
    assert spark.read.parquet(f"{out}/accounts").count() == 3


def test_daily_ingest_reads_every_event_type(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    day = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, 1, day(1), "click"), (2, 1, day(2), "chat"), (3, 2, day(1), None), (4, 3, day(3), "error"), (5, 3, day(2), None)]
    names = ["event_id", "user_id", "ts", "event_type"]
    pq.write_table(pa.table({n: list(c) for n, c in zip(names, zip(*rows))}), f"{tmp_path}/events.parquet")
    got = {r["account_id"]: (r["event_id"], r["event_type"]) for r in QUERIES["daily_ingest"](spark, str(tmp_path)).collect()}
    assert got == {1: (2, "chat"), 2: (3, None), 3: (4, "error")}


# --- plans -------------------------------------------------------------------------------------

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_master(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "master")
    Inputs(spark, sf_dir).master.write.partitionBy("vintage_year").parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(spark, stored_master):
    master = spark.read.parquet(stored_master)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(reports.channel_performance(filter_delinquent(master.where("vintage_year = 1995"))))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(overdue_days,30)" in text
    assert "PartitionFilters: [isnotnull(vintage_year" in text
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert schema.count(":") == 6, schema


def test_loan_joins_share_one_distribution(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        i = Inputs(spark, sf_dir)
        text = plan(i.book)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "_customer" in line]
    assert joins and "[loan_id#" in joins[0]
    # the recovery join sits directly on the loan join: no exchange between them
    lines = text.splitlines()
    left = next(k for k, line in enumerate(lines) if "LeftOuter" in line)
    inner = next(k for k, line in enumerate(lines) if k > left and "_customer" in line and "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in lines[left:inner])


def test_no_python_and_no_unbounded_single_partition_window(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    for df in (i.scores, evaluate.score_counts(i.scores), evaluate.threshold_sweep(i.scores),
               policy.contact_cap(i.contacts), policy.score_drop_alert(i.bureau_scores),
               policy.broken_promise_alert(i.promises), stats.quantiles(i.scores, ["p"], [0.5])):
        text = plan(df)
        assert "Python" not in text and "Pandas" not in text
        for line in text.splitlines():
            if "Window [" in line:
                assert "], [" in line and not line.rstrip().endswith("[]"), line


def test_group_statistics_are_broadcast(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    from arrearium.operators import clean

    text = plan(clean.group_transform(i.customers, "annual_income", ["city_tier"], "m"))
    assert "BroadcastHashJoin [city_tier" in text
