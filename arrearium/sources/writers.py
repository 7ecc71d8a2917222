"""Writing tables, exports, run metadata and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(f"{folder}/{name}") if fmt == "csv" else writer.parquet(f"{folder}/{name}")


def write_master(master: DataFrame, folder: str, rows_per_file: int = 5_000_000, rebalance: bool = True) -> None:
    """The master by vintage year, and its delinquent part taken from the written master.

    Reading the delinquent rows back from Parquet spares a second run of the joins. rebalance spends
    a shuffle to get few, even files per year, splitting large years; with it off each task writes
    its own file per year.
    """
    if rebalance:
        master = master.hint("rebalance", "vintage_year")
    (master.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .partitionBy("vintage_year").parquet(f"{folder}/master"))
    stored = master.sparkSession.read.parquet(f"{folder}/master")
    (stored.where(F.col("overdue_days") > 30).write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/delinquent"))


def write_segments(segmented: DataFrame, path: str) -> None:
    segmented.write.mode("overwrite").parquet(path)


def write_run_metadata(metadata: DataFrame, path: str) -> None:
    """A small (one-row, nested) table as JSON."""
    metadata.coalesce(1).write.mode("overwrite").json(path)


def export_top_n(df: DataFrame, path: str, n: int = 5000, order: Sequence = ()) -> None:
    """At most n rows as CSV, the first in the given order."""
    ordered = df.orderBy(*order) if order else df
    ordered.limit(n).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
