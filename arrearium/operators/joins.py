"""Joins of the four lending tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.operators.clean import impute_constants
from arrearium.functions import expressions as X


def join_loans_repayments(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """Inner join on loan and customer.

    loan_id alone distributes the rows; that the customers agree is checked as a plain condition.
    So the next join on loan_id finds its rows already in place.
    """
    right = repayments.withColumnRenamed("customer_id", "_customer")
    same = F.col("customer_id").isNotNull() & F.nullif("customer_id", "_customer").isNull()
    return loans.join(right, "loan_id").where(same).drop("_customer")


def join_recovery(loans: DataFrame, recovery: DataFrame) -> DataFrame:
    """Left outer join; loans without recovery work stay."""
    return loans.join(recovery.drop("customer_id"), "loan_id", "left")


def join_customers(customers: DataFrame, loans: DataFrame) -> DataFrame:
    """One customer to many loans. A customer with very many loans is split by adaptive execution,
    as the customer side has one row per key."""
    joined = loans.join(customers, "customer_id")
    rest = [c for c in loans.columns if c != "customer_id"]
    return joined.select(*customers.columns, *rest)


def loan_book(customers: DataFrame, loans: DataFrame, repayments: DataFrame, recovery: DataFrame) -> DataFrame:
    """The three joins, with recovery gaps filled and the open principal added.

    All loan_id joins come first and share one distribution; customers follow last.
    """
    lr = join_loans_repayments(loans, repayments)
    lr = lr.withColumn("outstanding_principal", X.outstanding_principal("loan_amount", "principal_paid"))
    return join_customers(customers, impute_constants(join_recovery(lr, recovery)))


def lookup_label(df: DataFrame, column: str, labels: dict, out: str) -> DataFrame:
    """Map a small id to a name; ids without a name give NULL."""
    pairs: list[Column] = [F.lit(x) for kv in labels.items() for x in kv]
    return df.withColumn(out, F.try_element_at(F.create_map(*pairs), F.col(column)))
