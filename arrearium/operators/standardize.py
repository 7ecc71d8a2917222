"""A table of unknown column names in, the canonical loan table out.

Every choice is made from column names while the plan is built; no data is scanned for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.stats import attach, quantiles


def standardize_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = fv.COLUMN_ALIASES) -> DataFrame:
    """Rename to canonical names: names are trimmed and lower-cased, the first alias found wins."""
    seen = {c.strip().lower(): c for c in df.columns}
    rename: dict[str, str] = {}
    for canonical, names in aliases.items():
        if canonical in df.columns:
            continue
        found = next((seen[n] for n in names if n in seen), None)
        # a column taken by an earlier canonical name goes to the later one, as both list it
        if found is not None:
            rename[found] = canonical
    return df.withColumnsRenamed(rename)


def _number(c: str) -> Column:
    """Text or number to a finite double, else NULL."""
    n = X.nan_to_null(F.col(f"`{c}`").try_cast("double"))
    return F.when(F.abs(n) < float("inf"), n)


def _whole(c: str) -> Column:
    """The same as an int; NULL where it does not fit."""
    return _number(c).try_cast("int")


def coerce_numeric(df: DataFrame, defaults: Mapping[str, float] = fv.NUMERIC_DEFAULTS) -> DataFrame:
    """Unreadable or missing numbers, and those an int default cannot hold, become the default; it sets the type."""
    return df.withColumns({
        c: F.coalesce(_whole(c), F.lit(v)) if isinstance(v, int) else F.coalesce(_number(c), F.lit(float(v)))
        for c, v in defaults.items() if c in df.columns})


def default_missing_columns(df: DataFrame, defaults: Mapping[str, object] = fv.ABSENT_DEFAULTS) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def annualize_income(df: DataFrame, column: str = "annual_income", method: str = "exact",
                     now: bool = False) -> DataFrame:
    """Multiply by 12 if the median says that incomes are monthly (between 500 and 12000)."""
    median = quantiles(df, [column], [0.5], method=method).agg(F.max(F.col("q")[0]).alias("median"))
    monthly = (F.col("_m.median") > 500) & (F.col("_m.median") < 12000)
    scaled = F.when(monthly, F.col(column) * 12.0).otherwise(F.col(column))
    return attach(df, now, _m=median).withColumn(column, scaled).drop("_m")


def synthesize_credit_score(df: DataFrame) -> DataFrame:
    """A stand-in score from days past due, for tables without one."""
    if "credit_score" in df.columns:
        return df
    if "overdue_days" not in df.columns:
        return df.withColumn("credit_score", F.lit(fv.ABSENT_CREDIT_SCORE))
    dpd = F.coalesce(_number("overdue_days"), F.lit(0.0))
    return df.withColumn("credit_score", X.round_to(X.clip(720 - dpd * 1.2, 350.0, 850.0), 0))


def derive_recovery_flag(df: DataFrame, whole_words: bool = False) -> DataFrame:
    """recovery_status_binary from the best column present."""
    if "recovery_status_binary" in df.columns:
        return df
    have = set(df.columns)

    def flag(c: str, default: int) -> Column:
        return F.coalesce(_whole(c), F.lit(default))

    worded = next((c for c in fv.RECOVERY_KEYWORDS if c in have), None)
    if "recovery_target_binary" in have:
        out = flag("recovery_target_binary", 0)
    elif "recovery_target" in have:
        out = flag("recovery_target", 0)
    elif worded:
        out = X.contains_any(worded, fv.RECOVERY_KEYWORDS[worded], whole_words).cast("int")
    elif "default_flag" in have:
        out = F.lit(1) - F.coalesce(_whole("default_flag"), F.lit(0))
    elif "loyal_customer" in have:
        out = flag("loyal_customer", 1)
    else:
        out = X.logistic_recovery_rule("credit_score", "overdue_days")
    return df.withColumn("recovery_status_binary", out)


def derive_recovered_amount(df: DataFrame, key: str | None = None) -> DataFrame:
    """Existing amount, else monthly spending, else a repeatable share (60-95%) of recovered loans.

    key names the row key for that share; without one the share is hashed from the whole row.
    """
    if "recovered_amount" in df.columns:
        out = F.coalesce(_number("recovered_amount"), F.lit(0.0))
    elif "monthly_spending" in df.columns:
        out = F.coalesce(_number("monthly_spending"), F.lit(0.0))
    else:
        row = F.col(key) if key else F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        share = 0.60 + 0.35 * X.hash_fraction(row)
        out = X.round_to(F.when(F.col("recovery_status_binary") == 1, F.col("loan_amount") * share).otherwise(0.0), 2)
    return df.withColumn("recovered_amount", out)


def derive_default_flag(df: DataFrame) -> DataFrame:
    if "default_flag" in df.columns:
        out = F.coalesce(_whole("default_flag"), F.lit(0))
    elif "delinquency_bucket" in df.columns:
        out = F.coalesce(F.col("delinquency_bucket").rlike(fv.DEFAULT_STAGE_PATTERN), F.lit(False)).cast("int")
    else:
        out = (F.col("overdue_days") > 90).cast("int")
    return df.withColumn("default_flag", out)


def standardize_dataset(df: DataFrame, key: str | None = None, whole_words: bool = False,
                        method: str = "exact", now: bool = False) -> DataFrame:
    """All of the above in order. An empty table stays empty."""
    out = standardize_columns(df)
    had_income = "annual_income" in out.columns
    out = synthesize_credit_score(out)
    if had_income:
        # scaled before missing incomes are filled, so the default is not scaled
        out = annualize_income(out.withColumn("annual_income", _number("annual_income")), method=method,
                               now=now)
    out = default_missing_columns(coerce_numeric(out))
    out = derive_default_flag(derive_recovered_amount(derive_recovery_flag(out, whole_words), key))
    if "outstanding_principal" not in out.columns:
        out = out.withColumn("outstanding_principal", F.col("loan_amount"))
    return out.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit(fv.ABSENT_DEFAULTS[c]))
        for c in ("loan_type", "region", "primary_channel")})
