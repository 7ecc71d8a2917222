"""Imputation, capping and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.standardize import standardize_dataset
from arrearium.operators.stats import attach, quantiles, wide_quantiles
from arrearium.session import stored


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def select_by_dtype(df: DataFrame, include: str = "numeric", exclude: Sequence[str] = ()) -> DataFrame:
    names = numeric_columns(df) if include == "numeric" else text_columns(df)
    return df.select(*[F.col(f"`{c}`") for c in names if c not in set(exclude)])


def impute_constants(df: DataFrame, defaults: Mapping[str, object] = fv.NO_RECOVERY_DEFAULTS) -> DataFrame:
    """Replace NULL by one constant per column; the integer columns keep their type."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in defaults.items() if c in df.columns})


def join_group_stat(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring a per-group statistic back to each row; rows with a NULL group get NULL."""
    return df.join(stats, list(by), "left")


def group_quantile(df: DataFrame, column: str, by: Sequence[str], probs: Mapping[str, float],
                   method: str = "exact") -> DataFrame:
    """by..., <name> for each named probability; hinted for broadcast where the size was checked."""
    q = quantiles(df, [column], list(probs.values()), by, method)
    return q.select(*by, *[F.col("q")[i].alias(name) for i, name in enumerate(probs)])


def group_transform(df: DataFrame, column: str, by: Sequence[str], out: str, method: str = "exact") -> DataFrame:
    """Median of the row's group on every row."""
    return join_group_stat(df, group_quantile(df, column, by, {out: 0.5}, method), by)


def impute_group_median(df: DataFrame, column: str, by: Sequence[str], default: float = 3,
                        method: str = "exact") -> DataFrame:
    """NULL -> median of the group -> default; cast to int, which truncates."""
    filled = F.coalesce(F.col(column).cast("double"), F.col("_median"), F.lit(float(default)))
    return (group_transform(df, column, by, "_median", method)
            .select(*[filled.cast("int").alias(c) if c == column else F.col(c) for c in df.columns]))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the most frequent non-NULL value of each text column, smallest first on ties."""
    long = df.select(*columns).unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.agg(*[
        F.min(F.when(F.col("column") == c, F.struct((-F.col("n")).alias("neg"), "value")))["value"].alias(c)
        for c in columns])


def impute_mode(df: DataFrame, columns: Sequence[str], default: str = "Unknown", now: bool = False) -> DataFrame:
    if not columns:
        return df
    filled = {c: F.coalesce(F.col(c), F.col(f"_m.`{c}`"), F.lit(default)) for c in columns}
    return attach(df, now, _m=most_frequent(df, columns)).withColumns(filled).drop("_m")


def impute_numeric(df: DataFrame, strategy: str = "median", columns: Sequence[str] | None = None,
                   method: str = "exact", now: bool = False) -> DataFrame:
    """Fill NULL in numeric columns by median, mean or zero; all statistics come from one pass.

    A column without any value is filled with zero; whole-number columns keep their type only for
    zero, as a median may lie between two values.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    if not columns:
        return df
    if strategy == "zero":
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})
    if strategy == "mean":
        stats = df.agg(*[F.avg(c).alias(f"{c}__fill") for c in columns])
    elif strategy == "median":
        stats = wide_quantiles(quantiles(df, columns, [0.5], method=method), columns, ["fill"])
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_m.`{c}__fill`"), F.lit(0.0)) for c in columns}
    return attach(df, now, _m=stats).withColumns(filled).drop("_m")


def cap_outliers_by_group(df: DataFrame, column: str, by: Sequence[str], k_lo: float = 1.5,
                          k_hi: float = 3.0, floor: float | None = 12000.0,
                          method: str = "exact") -> DataFrame:
    """Clamp to [max(floor, q25 - k_lo*IQR), q75 + k_hi*IQR] of the row's group."""
    stats = group_quantile(df, column, by, {"_q25": 0.25, "_q75": 0.75}, method)
    iqr = F.col("_q75") - F.col("_q25")
    lo = F.col("_q25") - k_lo * iqr
    if floor is not None:
        lo = F.greatest(F.lit(float(floor)), lo)
    capped = F.when(F.col("_q25").isNull(), F.col(column)).otherwise(
        X.clip(column, lo, F.col("_q75") + k_hi * iqr))
    return (join_group_stat(df, stats, by)
            .select(*[capped.alias(c) if c == column else F.col(c) for c in df.columns]))


def distinct_beyond(df: DataFrame, column: str, limit: int) -> Column:
    """Aggregate: how many distinct values a column has, exact up to limit + 1, and more than limit beyond.

    A theta sketch keeps the 64-bit hash of every value while there are no more than its nominal entries, so few values
    are counted and not estimated; its size is bounded. Beyond, the estimate is far above the limit.
    """
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.DecimalType, T.StringType)):
        value = value.cast("string")
    else:
        value = value.cast("double" if isinstance(kind, T.FractionalType) else "long")
    return F.theta_sketch_estimate(F.theta_sketch_agg(value, max(12, (2 * limit + 1).bit_length())))


def cap_outliers_global(df: DataFrame, columns: Sequence[str] | None = None, k: float = 2.5,
                        min_distinct: int = 10, skip_zero_iqr: bool = True,
                        exclude: Sequence[str] = (), method: str = "exact", now: bool = False) -> DataFrame:
    """Clamp to q25 - k*IQR .. q75 + k*IQR where a column has more than min_distinct values.

    A column whose IQR is zero would be flattened to one value; it is left alone unless
    skip_zero_iqr is off.
    """
    columns = [c for c in (numeric_columns(df) if columns is None else columns) if c not in set(exclude)]
    if not columns:
        return df
    q = wide_quantiles(quantiles(df, columns, [0.25, 0.75], method=method), columns, ["q25", "q75"])
    many = df.agg(*[distinct_beyond(df, c, min_distinct).alias(c) for c in columns])
    out = {}
    for c in columns:
        q25, q75 = F.col(f"_q.{c}__q25"), F.col(f"_q.{c}__q75")
        iqr = q75 - q25
        use = F.col(f"_n.{c}") > min_distinct
        if skip_zero_iqr:
            use = use & (iqr > 0)
        out[c] = F.when(use, X.clip(F.col(c).cast("double"), q25 - k * iqr, q75 + k * iqr)).otherwise(
            F.col(c).cast("double"))
    return attach(df, now, _q=q, _n=many).withColumns(out).drop("_q", "_n")


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Remove fully equal rows. Equal copies collapse map-side, so a much-copied row is no hot key."""
    return df.distinct()


def clean_table(df: DataFrame, drop_dups: bool = True, strategy: str = "median", cap: bool = True,
                exclude: Sequence[str] = (), method: str = "exact", standardize: bool = True) -> DataFrame:
    """De-duplicate, fill numbers, cap outliers, fill text, standardise.

    Each step's statistics rest on the step before. The de-duplicated table is stored once in the
    shared folder, and each step then makes one narrow pass over it for one row of statistics.
    """
    out = stored(drop_duplicates(df), "distinct") if drop_dups else df
    numbers = [c for c in numeric_columns(out) if c not in set(exclude)]
    out = impute_numeric(out, strategy, numbers, method, now=True)
    if cap:
        out = cap_outliers_global(out, numbers, method=method, now=True)
    out = impute_mode(out, [c for c in text_columns(out) if c not in set(exclude)], now=True)
    return standardize_dataset(out, now=True) if standardize else out
