"""Scalar rules as Column -> Column functions; nothing here touches a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrearium import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(value: Column | str, lo, hi) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (greatest/least alone would skip it)."""
    value = _col(value)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))


def round_to(value: Column | str, places: int) -> Column:
    """Round half to even on the binary value, the way arrays of floats are rounded.

    F.round goes through decimal text instead: slower, and it moves values such as 1.005 up.
    """
    scale = float(10**places)
    return F.rint(_col(value) * scale) / scale


def nan_to_null(value: Column | str) -> Column:
    return F.nanvl(_col(value), F.lit(None).cast("double"))


def parse_date(text: Column | str) -> Column:
    """Text to date; unreadable text gives NULL."""
    return F.try_to_date(_col(text))


def vintage_year(date: Column | str) -> Column:
    return F.year(_col(date))


def vintage_quarter(date: Column | str) -> Column:
    date = _col(date)
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def outstanding_principal(amount: Column | str, paid: Column | str) -> Column:
    open_amount = _col(amount) - _col(paid)
    return F.when(open_amount.isNotNull(), F.greatest(F.lit(0.0), open_amount))


def monthly_emi(amount: Column | str, annual_rate_pct: Column | str, months: Column | str) -> Column:
    """Instalment of an annuity loan, unrounded; an interest-free loan is repaid in equal parts."""
    amount, rate, n = _col(amount), _col(annual_rate_pct) / 100.0 / 12.0, _col(months)
    growth = F.pow(1 + rate, n)
    return F.when(rate == 0, F.try_divide(amount, n)).otherwise(
        F.try_divide(amount * (rate * growth), growth - 1))


def dti_ratio(emi: Column | str, annual_income: Column | str) -> Column:
    return F.try_divide(_col(emi) * 12, _col(annual_income))


def dti_simple(amount: Column | str, annual_income: Column | str) -> Column:
    income = _col(annual_income)
    return (_col(amount) * 0.35) / F.when(income.isNotNull(), F.greatest(income, F.lit(1000.0)))


def is_secured(collateral_type: Column | str) -> Column:
    kind = _col(collateral_type)
    return F.when(kind.isNull() | kind.isin(fv.UNSECURED_LABELS), 0).otherwise(1)


def ltv_ratio(amount: Column | str, collateral_value: Column | str, secured: Column | str) -> Column:
    value = F.greatest(F.coalesce(_col(collateral_value), F.lit(0.0)), F.lit(1.0))
    return F.when(_col(secured) == 1, clip(_col(amount) / value, 0.1, 1.5)).otherwise(F.lit(1.0))


def delinquency_severity(overdue_days: Column | str, credit_score: Column | str) -> Column:
    """The 0-100 severity that models are trained on."""
    raw = (_col(overdue_days) / 360.0) * 60 + (1 - _col(credit_score) / 850.0) * 40
    return clip(raw, 0.0, 100.0)


def severity_index(overdue_days: Column | str, promise_kept: Column | str, dti: Column | str) -> Column:
    """The 0-1 index of the single-borrower form; a different measure from delinquency_severity."""
    raw = (_col(overdue_days) / 90.0) * 0.5 + (1 - _col(promise_kept)) * 0.3 + (_col(dti) / 0.6) * 0.2
    return F.when(raw.isNotNull(), F.least(F.lit(1.0), raw))


def _first_band(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    chain = None
    for upper, label in bands:
        hit = value.isNotNull() if upper is None else value <= upper
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def credit_risk_tier(credit_score: Column | str) -> Column:
    score = _col(credit_score)
    return F.when(score > 0, _first_band(score, fv.CREDIT_TIERS))


def delinquency_bucket(overdue_days: Column | str) -> Column:
    return _first_band(_col(overdue_days), fv.DELINQUENCY_STAGES)


def net_recovery(recovered: Column | str, cost: Column | str) -> Column:
    return _col(recovered) - _col(cost)


def recovery_rate_pct(recovered: Column | str, outstanding: Column | str) -> Column:
    recovered, outstanding = _col(recovered), _col(outstanding)
    return F.when(outstanding > 0, clip((recovered / outstanding) * 100.0, 0.0, 100.0)).otherwise(F.lit(0.0))


def recovery_target(status: Column | str) -> Column:
    """1 recovered, 0 not recovered, NULL where neither applies."""
    status = _col(status)
    return F.when(status.isin(fv.RECOVERED_STATUSES), 1).when(status.isin(fv.UNRECOVERED_STATUSES), 0)


def recovery_label(status: Column | str) -> Column:
    """Two-state training label: 1 recovered, else 0."""
    return F.when(_col(status).isin(fv.RECOVERED_STATUSES), 1).otherwise(0)


def risk_grade(p: Column | str, threshold: float = fv.OPTIMAL_THRESHOLD) -> Column:
    """Struct of grade, label and strategy."""
    p = _col(p)
    chain = None
    for grade, lower, label, strategy in fv.RISK_GRADES:
        row = F.struct(F.lit(grade).alias("grade"), F.lit(label).alias("label"),
                       F.lit(strategy).alias("strategy"))
        hit = p >= (threshold if lower is None else lower) if grade != "D" else p.isNotNull()
        chain = F.when(hit, row) if chain is None else chain.when(hit, row)
    return chain


def risk_score_band(p: Column | str) -> Column:
    score = (1.0 - _col(p)) * 100.0
    return F.when(score > -0.1, _first_band(score, fv.RISK_BANDS))


def expected_yield(balance: Column | str, discount_pct: Column | str, p: Column | str) -> Column:
    return _col(balance) * (1.0 - _col(discount_pct) / 100.0) * _col(p)


def risk_pct(p: Column | str) -> Column:
    return clip((1.0 - _col(p)) * 100.0, 1.0, 99.0)


def rule_score(credit_score: Column | str, overdue_days: Column | str, promise_kept: Column | str) -> Column:
    """Recovery probability by rule, for when no model is loaded."""
    raw = (0.45 + (_col(credit_score) - 600) * 0.0012 - (_col(overdue_days) - 40) * 0.001
           + _col(promise_kept) * 0.25)
    return clip(raw, 0.05, 0.95)


def logistic_recovery_rule(credit_score: Column | str, overdue_days: Column | str) -> Column:
    z = (_col(credit_score) - 620) / 60.0 - (_col(overdue_days) - 30) / 45.0
    return F.when(1.0 / (1.0 + F.exp(-z)) >= 0.5, 1).otherwise(0)


def first_word(name: Column | str) -> Column:
    return F.split(_col(name), " ")[0]


def contains_any(text: Column | str, words: Sequence[str], whole_words: bool = False) -> Column:
    """Does lower-cased text contain one of the words; whole_words keeps 'unpaid' apart from 'paid'."""
    body = "|".join(w.replace("-", "\\-") for w in words)
    pattern = f"\\b({body})\\b" if whole_words else body
    return F.coalesce(F.lower(_col(text)).rlike(pattern), F.lit(False))


def hash_fraction(key: Column | str, salt: str = "") -> Column:
    """Repeatable pseudo-random number in [0, 1) from a row key."""
    text = F.concat(_col(key).cast("string"), F.lit(salt)) if salt else _col(key).cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)
