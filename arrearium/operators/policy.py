"""Collection policy and monitoring rules, batch form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.segments import playbook
from arrearium.operators.stats import attach, quantiles
from arrearium.operators.windows import previous_value, rolling_count, rolling_max


def contact_cap(contacts: DataFrame, max_contacts: int = 3, days: int = 7) -> DataFrame:
    """Flag contacts that make more than max_contacts within `days` for an account."""
    out = rolling_count(contacts, "account_id", "contact_ts", days, "contacts_in_window")
    return out.withColumn("over_cap", (F.col("contacts_in_window") > max_contacts).cast("int"))


def score_drop_alert(scores: DataFrame, points: int = 35, days: int = 90) -> DataFrame:
    """Flag a score at least `points` below the account's best of the last `days`."""
    out = rolling_max(scores, "account_id", "score_ts", "score", days, "best_score")
    drop = F.col("best_score") - F.col("score")
    return out.withColumns({"score_drop": drop, "alert": (drop >= points).cast("int")})


def overleverage_alert(df: DataFrame, dti: str = "dti_ratio", limit: float = 0.5) -> DataFrame:
    """Debt service above half of income on an account that is late."""
    return df.where((F.col(dti) > limit) & (F.col("overdue_days") > 0))


def broken_promise_alert(promises: DataFrame) -> DataFrame:
    """Flag the second of two promises in a row that were not kept."""
    out = previous_value(promises, "account_id", "promise_ts", "kept", "event_id", "previous_kept")
    hit = (F.col("kept") == 0) & (F.col("previous_kept") == 0)
    return out.withColumn("alert", F.coalesce(hit, F.lit(False)).cast("int"))


def early_default_audit(loans: DataFrame, days: int = 90) -> DataFrame:
    """Loans in default within `days` of disbursement, per origination channel."""
    early = (F.col("default_flag") == 1) & (F.datediff("default_date", "disbursement_date") <= days)
    return loans.where(F.col("origination_channel").isNotNull()).groupBy("origination_channel").agg(
        F.count("*").alias("n_loans"), F.count_if(early).alias("n_early_defaults"))


def contagion_flag(loans: DataFrame, loan_type: str = "Auto Loan", min_days: int = 30) -> DataFrame:
    """The other loans of customers with a delinquent loan of the given type.

    The qualifying customers are made distinct first, so a customer with many such loans is one key.
    """
    hit = loans.where((F.col("loan_type") == loan_type) & (F.col("overdue_days") > min_days))
    return loans.where(F.col("loan_type") != loan_type).join(
        hit.select("customer_id").distinct(), "customer_id", "left_semi")


def collector_allocation(scored: DataFrame, p: str = "p") -> DataFrame:
    """Channel and resolution window: the stricter of the row by probability and the row by stage."""
    by_p = by_stage = None
    for rank, lower, upper, _, _ in fv.COLLECTOR_MATRIX:
        hit_p = F.col(p) >= lower
        hit_s = F.col("overdue_days").isNotNull() if upper is None else F.col("overdue_days") <= upper
        by_p = F.when(hit_p, rank) if by_p is None else by_p.when(hit_p, rank)
        by_stage = F.when(hit_s, rank) if by_stage is None else by_stage.when(hit_s, rank)
    rules = F.broadcast(scored.sparkSession.createDataFrame(
        [(r, c, w) for r, _, _, c, w in fv.COLLECTOR_MATRIX], "rank INT, channel STRING, resolution_window STRING"))
    return scored.withColumn("rank", F.greatest(by_p, by_stage)).join(rules, "rank", "left")


def calling_window(contacts: DataFrame, zones: DataFrame, ts: str = "contact_ts", key: str = "region",
                   first_hour: int = 8, last_hour: int = 21) -> DataFrame:
    """Flag whether a contact falls in the allowed local hours; zones maps a region to a time zone."""
    local = contacts.join(zones, key, "left").withColumn(
        "local_hour", F.hour(F.from_utc_timestamp(F.col(ts), F.coalesce("time_zone", F.lit("UTC")))))
    allowed = (F.col("local_hour") >= first_hour) & (F.col("local_hour") < last_hour)
    return local.withColumn("allowed", allowed.cast("int"))


def disparate_impact(scored: DataFrame, baselines: Mapping[str, str], positive: Column, limit: float = 0.8) -> DataFrame:
    """Positive rate of each group over that of its attribute's baseline group."""
    attributes = list(baselines)
    flat = scored.select(*[F.col(a).cast("string").alias(a) for a in attributes], positive.cast("double").alias("_pos"))
    long = flat.unpivot("_pos", attributes, "attribute", "group_value").where(F.col("group_value").isNotNull())
    rates = long.groupBy("attribute", "group_value").agg(F.count("*").alias("n"), F.avg("_pos").alias("positive_rate"))
    is_base = None
    for a, g in baselines.items():
        hit = (F.col("attribute") == a) & (F.col("group_value") == g)
        is_base = hit if is_base is None else is_base | hit
    base = rates.where(is_base).select("attribute", F.col("positive_rate").alias("baseline_rate"))
    out = rates.join(F.broadcast(base), "attribute", "left")  # one row per listed attribute
    ratio = F.try_divide("positive_rate", "baseline_rate")
    return out.withColumn("impact_ratio", ratio).withColumn("passes", (F.col("impact_ratio") >= limit).cast("int"))


def population_stability(df: DataFrame, column: str, is_base: Column, bins: int = 10,
                         method: str = "exact") -> DataFrame:
    """Per bin shares of the base and the current population and their PSI term; bins are quantiles
    of the base. An empty share counts as 0.0001."""
    edges = [i / bins for i in range(1, bins)]
    cut = quantiles(df.where(is_base), [column], edges, method=method).select("q")
    rows = attach(df.where(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("v"), is_base.cast("int").alias("base")), _s=cut).withColumn("cut", F.col("_s.q"))
    place = F.lit(0)
    for k in range(len(edges)):
        place = place + (F.col("v") > F.col("cut")[k]).cast("int")
    cells = rows.groupBy(place.alias("bin")).agg(
        F.sum("base").alias("b"), F.sum(1 - F.col("base")).alias("c"))
    total = cells.agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    share = {n: F.greatest(F.try_divide(F.col(n), F.col(f"_s.{n}")), F.lit(0.0001)) for n in ("b", "c")}
    out = attach(cells, _s=total).select("bin", share["b"].alias("base_share"), share["c"].alias("current_share"))
    return out.withColumn("psi_term", (F.col("current_share") - F.col("base_share"))
                          * F.ln(F.col("current_share") / F.col("base_share")))


def stability_index(terms: DataFrame, limit: float = 0.10) -> DataFrame:
    return terms.agg(F.sum("psi_term").alias("psi")).withColumn("alert", (F.col("psi") > limit).cast("int"))


def error_rate_audit(scored: DataFrame, attributes: Sequence[str], threshold: float = 0.5, label: str = "label",
                     p: str = "p") -> DataFrame:
    """False negative and false positive rate per group of each protected attribute."""
    flat = scored.select(*[F.col(a).cast("string").alias(a) for a in attributes], F.col(label).alias("_y"),
                         (F.col(p) >= threshold).alias("_hit"))
    long = flat.unpivot(["_y", "_hit"], list(attributes), "attribute", "group_value").where(
        F.col("group_value").isNotNull())
    pos, neg = F.count_if(F.col("_y") == 1), F.count_if(F.col("_y") == 0)
    fn = F.count_if((F.col("_y") == 1) & ~F.col("_hit"))
    fp = F.count_if((F.col("_y") == 0) & F.col("_hit"))
    return long.groupBy("attribute", "group_value").agg(
        F.count("*").alias("n"), F.try_divide(fn, pos).alias("false_negative_rate"),
        F.try_divide(fp, neg).alias("false_positive_rate"))


def mask_ids(df: DataFrame, id_col: str = "customer_id", drop: Sequence[str] = ("officer_name",)) -> DataFrame:
    """Replace the customer id by its SHA-256 and drop direct identifiers."""
    return df.drop(*drop).withColumn(id_col, F.sha2(F.col(id_col).cast("string"), 256))


def haircut_policy(named: DataFrame, discount: str = "settlement_discount_pct") -> DataFrame:
    """Cap the proposed discount by persona; no persona, no cap."""
    caps = playbook(named.sparkSession).select("segment_name", "cap_pct")
    out = named.join(F.broadcast(caps), "segment_name", "left")
    return out.withColumn("allowed_pct", F.when(F.col(discount).isNotNull(), F.least(F.col(discount), F.col("cap_pct"))))


def sourcing_quality(loans: DataFrame, channel: str = "origination_channel", worst_share: float = 0.10) -> DataFrame:
    """Default rate per sourcing channel; the worst tenth is flagged. Ranks one row per channel."""
    rates = loans.where(F.col(channel).isNotNull()).groupBy(channel).agg(
        F.count("*").alias("n_loans"), F.avg("default_flag").alias("default_rate"))
    ranked = rates.withColumn("rank_share", F.percent_rank().over(W.orderBy(F.desc("default_rate"))))
    return ranked.withColumn("flagged", (F.col("rank_share") < worst_share).cast("int"))


def restructure_offer(df: DataFrame, extra_months: int = 12, stretch_from: int = 36, stretch_to: int = 60) -> DataFrame:
    """Instalment before and after a longer term: 36 months become 60, any other term gets 12 more."""
    new_term = F.when(F.col("loan_term_months") == stretch_from, stretch_to).otherwise(
        F.col("loan_term_months") + extra_months)
    out = df.withColumn("new_term_months", new_term.cast("int"))
    out = out.withColumns({
        "current_emi": X.monthly_emi("loan_amount", "interest_rate", "loan_term_months"),
        "new_emi": X.monthly_emi("loan_amount", "interest_rate", "new_term_months")})
    return out.withColumn("emi_change", F.col("new_emi") - F.col("current_emi"))
