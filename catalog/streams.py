"""Queries: streaming forms over the event table, run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearium.session import scratch_path
from arrearium.streaming import alerts, ingest
from catalog.registry import query


def event_stream(i, *kinds):
    """The events file as a stream, of the given types or else of all; file-source timestamps come without a zone and mean UTC."""
    schema = i.base("events").schema
    stream = i.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(i.sf_dir)
    if kinds:
        stream = stream.where(F.col("event_type").isin(*kinds))
    return stream.select(
        "event_id", F.col("user_id").alias("account_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type")


def ended(i, stream, name):
    """The stream and a mark of time behind its last event, without an account: it moves the watermark past all events."""
    path = scratch_path(i.spark, name)
    last = i.base("events").agg((F.max(F.col("ts").cast("timestamp")) + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    last.select(*[F.col("ts") if c == "ts" else F.lit(None).cast(t).alias(c) for c, t in stream.dtypes]).na.fill(0, ["event_id"]).write.parquet(path)
    return stream.unionByName(i.spark.readStream.schema(stream.schema).parquet(path))


def run_to_end(i, stream, name):
    path = scratch_path(i.spark, name)
    (stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/_progress")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return i.spark.read.schema("account_id BIGINT, event_id BIGINT, measure BIGINT, alert BIGINT").parquet(f"{path}/rows")


@query("contact_cap_stream", ["contacts"], """
SELECT account_id, event_id, n AS measure, CAST(CASE WHEN n > 3 THEN 1 ELSE 0 END AS BIGINT) AS alert
FROM (SELECT *, COUNT(*) OVER (PARTITION BY account_id ORDER BY contact_ts
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS n FROM contacts)""")
def contact_cap_stream(i):
    """Every contact, judged once the watermark has passed it."""
    return run_to_end(i, alerts.contact_cap_stream(ended(i, event_stream(i, "click"), "cap-end").withColumnRenamed("ts", "contact_ts")), "cap")


@query("score_drop_stream", ["bureau_scores"], """
SELECT account_id, event_id, CAST(best - score AS BIGINT) AS measure,
  CAST(CASE WHEN best - score >= 35 THEN 1 ELSE 0 END AS BIGINT) AS alert
FROM (SELECT *, MAX(score) OVER (PARTITION BY account_id ORDER BY score_ts
  RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW) AS best FROM bureau_scores)""")
def score_drop_stream(i):
    stream = event_stream(i, "view").select("event_id", "account_id", "ts", (600 + (F.col("event_id") * 37) % 120).cast("int").alias("score"))
    return run_to_end(i, alerts.score_drop_stream(ended(i, stream, "drop-end").na.fill(0, ["score"]).withColumnRenamed("ts", "score_ts")), "drop")


@query("broken_promise_stream", ["promises"], """
SELECT account_id, event_id, CAST(coalesce(prev, 1) AS BIGINT) AS measure,
  CAST(CASE WHEN kept = 0 AND prev = 0 THEN 1 ELSE 0 END AS BIGINT) AS alert
FROM (SELECT *, lag(kept) OVER (PARTITION BY account_id ORDER BY promise_ts, event_id) AS prev FROM promises)""")
def broken_promise_stream(i):
    stream = event_stream(i, "purchase", "error").select("event_id", "account_id", "ts", (F.col("event_type") == "purchase").cast("int").alias("kept"))
    return run_to_end(i, alerts.broken_promise_stream(ended(i, stream, "promise-end").na.fill(0, ["kept"]).withColumnRenamed("ts", "promise_ts")), "promise")


@query("daily_ingest", ["customers"], """
SELECT account_id, event_id, event_type FROM (SELECT user_id AS account_id, event_id, event_type,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def daily_ingest(i):
    """Latest event per account after ingesting the event stream."""
    path = scratch_path(i.spark, "ingest")
    stream = event_stream(i).withColumn("at", F.struct("ts", "event_id"))
    late = lambda df: df.where(F.col("event_type") == "error").groupBy("account_id").agg(F.count("*").alias("n_errors"))
    ingest.daily_ingest(stream, path, "account_id", "at", late).awaitTermination()
    return ingest.latest_rows(i.spark, path, "account_id", "at").select("account_id", "event_id", "event_type")
