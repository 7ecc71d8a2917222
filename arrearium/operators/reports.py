"""Portfolio report tables: grouped sums and rates, top-k lists, set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.operators.stats import attach, one_row


def _known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all known, as groups do not include missing keys."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def portfolio_filter(df: DataFrame, loan_types: Sequence[str] | None = None, max_dpd: int | None = None,
                     target: int | None = None, on_empty: str = "none") -> DataFrame:
    """AND of the filters given; one that is not given, or whose column is absent, is left out.

    on_empty='all' gives the whole table where no row passes, as a dashboard wants it: one lookup of a single row.
    """
    if on_empty not in ("none", "all"):
        raise ValueError(f"unknown on_empty {on_empty!r}")
    whole = df
    if loan_types and "loan_type" in df.columns:
        df = df.where(F.col("loan_type").cast("string").isin([str(t) for t in loan_types]))
    if max_dpd is not None and "overdue_days" in df.columns:
        df = df.where(F.col("overdue_days") <= max_dpd)
    if target is not None and "recovery_status_binary" in df.columns:
        df = df.where(F.col("recovery_status_binary") == target)
    return whole if on_empty == "all" and df is not whole and df.isEmpty() else df


def filter_settled(df: DataFrame) -> DataFrame:
    return df.where(F.col("settlement_discount_pct") > 0)


def default_rate_by(df: DataFrame, by: str = "loan_type") -> DataFrame:
    rate = (F.avg("default_flag") * 100).alias("default_rate_pct")
    return _known(df, by).groupBy(by).agg(rate).orderBy(F.desc("default_rate_pct"), by)


def mix_by(df: DataFrame, row: str = "region", column: str = "delinquency_bucket",
           values: Sequence[str] = tuple(fv.STAGE_LABELS), names: Sequence[str] | None = None) -> DataFrame:
    """Counts per row and column value as row percentages, absent combinations as zero.

    values are the column's labels, so no job is needed to find them. Names default to pct_1, ...
    """
    names = [f"pct_{i + 1}" for i in range(len(values))] if names is None else names
    counts = _known(df, row, column).groupBy(row).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(column) == v).alias(n) for v, n in zip(values, names)])
    return counts.select(row, "n_rows", *[(F.col(n) / F.col("n_rows") * 100).alias(n) for n in names])


def channel_performance(delinquent: DataFrame, by: str = "primary_channel") -> DataFrame:
    out = _known(delinquent, by).groupBy(by).agg(
        F.sum("outstanding_principal").alias("total_outstanding"),
        F.sum("recovered_amount").alias("total_recovered"),
        F.sum("recovery_cost").alias("total_cost"),
        F.avg("contact_attempts").alias("avg_attempts"))
    return out.withColumns({
        "recovery_rate_pct": F.try_divide("total_recovered", "total_outstanding") * 100,
        "roi_multiple": F.col("total_recovered") / F.greatest("total_cost", F.lit(1.0)),
    }).orderBy(F.desc("recovery_rate_pct"), by)


def vintage_curve(df: DataFrame) -> DataFrame:
    out = _known(df, "vintage_quarter", "loan_type").groupBy("vintage_quarter", "loan_type").agg(
        F.sum("loan_amount").alias("total_originated"),
        F.sum("recovered_amount").alias("total_recovered"),
        F.sum("principal_paid").alias("total_principal_paid"))
    repaid = F.col("total_principal_paid") + F.col("total_recovered")
    return out.withColumn("cumulative_repayment_rate", F.try_divide(repaid, F.col("total_originated")) * 100)


def officer_leaderboard(delinquent: DataFrame) -> DataFrame:
    named = _known(delinquent, "recovery_officer_id", "officer_name").where(
        F.col("recovery_officer_id") != "None")
    out = named.groupBy("recovery_officer_id", "officer_name").agg(
        F.count("loan_id").alias("total_accounts"),
        F.sum("recovered_amount").alias("total_recovered"),
        F.avg("recovery_rate_pct").alias("avg_recovery_rate"),
        F.sum("recovery_cost").alias("total_cost"))
    return out.withColumn("net_recovered", F.col("total_recovered") - F.col("total_cost")).orderBy(
        F.desc("total_recovered"), "recovery_officer_id")


def portfolio_kpis(df: DataFrame, absent_recovery_rate: float = 65.0) -> DataFrame:
    """One row; a measure whose column is absent is zero, an absent recovery rate is 65."""
    have = set(df.columns)

    def over(c: str, agg: Column, absent: float = 0.0) -> Column:
        return agg if c in have else F.lit(absent)

    return df.agg(
        F.count("*").alias("n_accounts"),
        over("default_flag", F.avg("default_flag") * 100).alias("default_rate_pct"),
        over("recovered_amount", F.avg("recovered_amount")).alias("avg_recovered"),
        over("recovered_amount", F.sum("recovered_amount")).alias("total_recovered"),
        over("overdue_days", F.avg("overdue_days")).alias("avg_overdue_days"),
        over("recovery_status_binary", F.avg("recovery_status_binary") * 100,
             absent_recovery_rate).alias("recovery_rate_pct"),
        over("recovered_amount", F.sum("recovered_amount") / F.greatest(F.count("*"), F.lit(1))
             ).alias("yield_per_account"))


def sum_by_category(df: DataFrame, category: str, measure: str) -> DataFrame:
    return _known(df, category).groupBy(category).agg(F.sum(measure).alias(f"total_{measure}"))


def value_counts(df: DataFrame, column: str, share: bool = False) -> DataFrame:
    counts = _known(df, column).groupBy(column).agg(F.count("*").alias("n"))
    if share:
        total = one_row(counts.agg(F.sum("n").alias("total")))["total"]
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.desc("n"), column)


def filter_options(df: DataFrame, category: str = "loan_type", dpd: str = "overdue_days", most: int = 10_000) -> DataFrame:
    """Sorted distinct category labels and the largest dpd, for choosing filters; more than `most` labels are an error.

    Labels are made distinct first, and no more than most + 1 of them meet.
    """
    labels = df.select(F.col(category).cast("string").alias("label")).where("label is not null").distinct().limit(most + 1)
    found = labels.agg(F.array_sort(F.collect_list("label")).alias("options"))
    options = F.when(F.size("options") <= most, F.col("options")).otherwise(
        F.raise_error(F.lit(f"more than {most} labels in {category}")).cast("array<string>"))
    return attach(df.agg(F.max(dpd).alias("max_dpd")), _o=found.select(options.alias("options"))).select(F.col("_o.options").alias("options"), "max_dpd")


def settlement_points(delinquent: DataFrame) -> DataFrame:
    return filter_settled(delinquent).select(
        "loan_id", "loan_type", "settlement_discount_pct", "recovered_amount", "outstanding_principal")


def cleaning_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    def totals(df: DataFrame, tag: str) -> DataFrame:
        nulls = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
        total = nulls[0]
        for n in nulls[1:]:
            total = total + n
        return df.agg(F.count("*").alias(f"{tag}_rows"), total.alias(f"{tag}_missing"))

    return attach(totals(raw, "raw"), _s=totals(clean, "clean")).select("raw_rows", "raw_missing", "_s.*")


def cluster_profile(df: DataFrame, cluster: str = "cluster_id",
                    features: Sequence[str] = tuple(fv.SEGMENT_FEATURES)) -> DataFrame:
    """Means per cluster, with the cluster's size and share."""
    columns = [*features, "default_flag", "recovered_amount"]
    out = _known(df, cluster).groupBy(cluster).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in columns])
    total = one_row(out.agg(F.sum("n").alias("total")))["total"]
    return out.withColumn("share", F.col("n") / total)


def segment_default_rate(df: DataFrame, segment: str = "segment_name") -> DataFrame:
    return _known(df, segment).groupBy(segment).agg(F.avg("default_flag").alias("default_rate"))


def portfolio_summary(master: DataFrame) -> DataFrame:
    late = F.col("overdue_days") > 30
    early = (F.col("overdue_days") > 0) & (F.col("overdue_days") <= 60)
    return master.agg(
        F.sum("loan_amount").alias("disbursed"),
        F.sum("outstanding_principal").alias("outstanding"),
        F.sum(F.when(late, F.col("outstanding_principal")).otherwise(0.0)).alias("delinquent_exposure"),
        F.count_if(late).alias("delinquent_accounts"),
        F.sum(F.when(late, F.col("recovered_amount") - F.col("recovery_cost")).otherwise(0.0)).alias("net_recovered"),
        (F.avg(F.when(F.col("overdue_days") > 90, 1.0).otherwise(0.0)) * 100).alias("npa_rate_pct"),
        (F.avg(F.when(early, 1.0).otherwise(0.0)) * 100).alias("early_stage_pct"))


def lgd_by_collateral(master: DataFrame) -> DataFrame:
    """Loss given default = 1 - recovered / outstanding over the defaulted loans."""
    defaults = master.where(F.col("default_flag") == 1)
    return defaults.groupBy("is_secured").agg(
        F.count("*").alias("n_defaults"),
        (1 - F.try_divide(F.sum("recovered_amount"), F.sum("outstanding_principal"))).alias("lgd"))


def haircut_elasticity(delinquent: DataFrame) -> DataFrame:
    d = F.col("settlement_discount_pct")
    band = F.when(d < 10, "<10").when(d < 20, "10-20").when(d <= 30, "20-30").when(d > 30, ">30")
    return _known(delinquent.withColumn("discount_band", band), "discount_band").groupBy("discount_band").agg(
        F.count("*").alias("n_accounts"),
        (F.try_divide(F.sum("recovered_amount"), F.sum("outstanding_principal")) * 100).alias("recovery_rate_pct"),
        F.sum(F.col("recovered_amount") - F.col("recovery_cost")).alias("net_recovered"))


# --- ordering, limits and set operations -------------------------------------------------------

def top_k(df: DataFrame, measure: str, k: int, key: str, ascending: bool = False) -> DataFrame:
    first = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
    return df.orderBy(first, F.asc(key)).limit(k)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def top_bottom_k(df: DataFrame, measure: str, k: int, key: str) -> DataFrame:
    both = union_distinct(top_k(df, measure, k, key), top_k(df, measure, k, key, ascending=True))
    return both.orderBy(measure, key)


def preview(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    """A repeatable sample of n rows: those whose key hashes lowest, kept per partition first."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key).limit(n)


