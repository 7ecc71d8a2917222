"""Daily ingestion: append what arrived, keep a snapshot of the latest row per account, and derive the alerts from it.

Below the folder lie `accounts/batch=N` (all rows that came with batch N, never read again here), `snapshot/N` (the latest row
of each key: a base, or the delta of one batch), `manifest/version=N` (which base and deltas make the snapshot after
batch N) and `alerts/N`. A batch reads the last manifest and what it names, so its work follows the keys there are
and not the days gone by; every merge_every batches the deltas become a new base. All of a batch's outputs carry its number
and are overwritten if it is tried again; the manifest comes last, so a reader sees a batch whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arrearium.session import exists

_MANIFEST = "base long, deltas array<long>"


def manifest(spark: SparkSession, folder: str, before: int | None = None) -> tuple[int, list[int]] | None:
    """Base and deltas of the last version, or of the last before a batch; None if there is none."""
    if not exists(spark, f"{folder}/manifest"):
        return None
    versions = spark.read.schema(f"{_MANIFEST}, version long").parquet(f"{folder}/manifest")
    if before is not None:
        versions = versions.where(F.col("version") < before)
    row = versions.orderBy(F.desc("version")).first()
    return (row["base"], list(row["deltas"])) if row else None


def _newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """A partial aggregate, so no key is sorted whole. Of rows equal in order the one of the later batch stays."""
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(order, "batch")).alias("r"))
    return newest.select("r.*")


def _parts(spark: SparkSession, folder: str, base: int, deltas: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{folder}/snapshot/{n}" for n in (base, *deltas)])


def daily_ingest(stream: DataFrame, folder: str, key: str, order: str, alerts: Callable[[DataFrame], DataFrame] | None = None,
                 merge_every: int = 8) -> StreamingQuery:
    """Start a run that takes everything available and stops.

    alerts turns the snapshot into the alert rows of its version, so an alert ends with the row that cures it.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/accounts/batch={batch_id}")
        arrived = spark.read.schema(batch.schema).parquet(f"{folder}/accounts/batch={batch_id}")
        fresh = _newest(arrived.withColumn("batch", F.lit(batch_id).cast("long")), key, order)
        known = manifest(spark, folder, before=batch_id)
        if known is None:
            base, deltas = batch_id, []
        elif len(known[1]) + 1 >= merge_every:
            fresh = _newest(_parts(spark, folder, *known).unionByName(fresh), key, order)
            base, deltas = batch_id, []
        else:
            base, deltas = known[0], [*known[1], batch_id]
        fresh.write.mode("overwrite").parquet(f"{folder}/snapshot/{batch_id}")
        if alerts is not None:
            now = _newest(_parts(spark, folder, base, deltas), key, order).drop("batch")
            alerts(now).write.mode("overwrite").parquet(f"{folder}/alerts/{batch_id}")
        spark.createDataFrame([(base, deltas)], _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/version={batch_id}")

    return (stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/_progress")
            .trigger(availableNow=True).start())


def latest_rows(spark: SparkSession, folder: str, key: str, order: str) -> DataFrame:
    """The newest row of each key, from the snapshot's base and its few deltas."""
    known = manifest(spark, folder)
    if known is None:
        raise ValueError(f"nothing was ingested into {folder}")
    return _newest(_parts(spark, folder, *known), key, order).drop("batch")


def current_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts of the last version."""
    known = manifest(spark, folder)
    if known is None:
        raise ValueError(f"nothing was ingested into {folder}")
    base, deltas = known
    return spark.read.parquet(f"{folder}/alerts/{(deltas or [base])[-1]}")
