"""Name -> query and oracle statement, and the input tables queries start from."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearium.functions import expressions as X
from arrearium.operators.joins import loan_book
from arrearium.plans.master import build_master, clean_loans, filter_delinquent
from arrearium.session import scratch_path, size_shuffles
from arrearium.sources.readers import read_master
from arrearium.sources.writers import write_master
from catalog.views import with_ctes

BASE_TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]
_STORED: dict = {}
QUERIES: dict = {}
ORACLES: dict = {}


class Inputs:
    """The tables of one scale, each built only when a query asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        size_shuffles(spark, [f"{sf_dir}/{name}.parquet" for name in BASE_TABLES])

    @cached_property
    def _tables(self) -> dict[str, DataFrame]:
        return {}

    def base(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        text = with_ctes([name], f"SELECT * FROM {name}")
        for t in BASE_TABLES:
            if re.search(rf"\b{t}\b", text):
                self.base(t).createOrReplaceTempView(t)
        return self.spark.sql(text)

    customers = cached_property(lambda self: self.view("customers"))
    loans = cached_property(lambda self: self.view("loans"))
    repayments = cached_property(lambda self: self.view("repayments"))
    recovery = cached_property(lambda self: self.view("recovery_activities"))
    contacts = cached_property(lambda self: self.view("contacts"))
    promises = cached_property(lambda self: self.view("promises"))
    bureau_scores = cached_property(lambda self: self.view("bureau_scores"))

    @cached_property
    def book(self) -> DataFrame:
        """Joined loans with customers as they came (no imputation, no caps)."""
        return loan_book(self.customers, clean_loans(self.loans), self.repayments, self.recovery)

    @cached_property
    def late_book(self) -> DataFrame:
        return filter_delinquent(self.book)

    @cached_property
    def master(self) -> DataFrame:
        return build_master(self.customers, self.loans, self.repayments, self.recovery)

    @cached_property
    def stored_master(self) -> DataFrame:
        """The master as later stages find it: written once per session and scale, then read."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORED:
            folder = scratch_path(self.spark, "master")
            write_master(self.master, folder)
            _STORED[key] = f"{folder}/master"
        return read_master(self.spark, _STORED[key])

    @cached_property
    def delinquent(self) -> DataFrame:
        return filter_delinquent(self.stored_master)

    @cached_property
    def scores(self) -> DataFrame:
        """Delinquent accounts with the rule score p and the two-state label."""
        return self.late_book.select(
            "loan_id", "customer_id", "credit_score", "overdue_days", "promise_to_pay_kept",
            "outstanding_principal", "settlement_discount_pct", "gender", "region", "city_tier",
            "marital_status", "vintage_year", X.recovery_label("recovery_status").alias("label"),
            X.rule_score("credit_score", "overdue_days", "promise_to_pay_kept").alias("p"))


def query(key: str, needs: list[str] | None = None, sql: str | None = None, extra: dict | None = None):
    """Register fn(inputs) under key; sql is the oracle's final SELECT over the CTEs it needs."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        assert key not in QUERIES, key
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_ctes(needs or [], sql, extra) if (needs or extra) else sql
        return fn

    return register


def rounded(df: DataFrame, places: int = 4, **other: int) -> DataFrame:
    """Round every double column for the comparison, to `places` or the number given by name."""
    return df.select(*[
        X.round_to(F.col(f"`{f.name}`"), other.get(f.name, places)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema])
