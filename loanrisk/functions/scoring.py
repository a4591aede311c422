"""Row-level risk rules as Column expressions.

Arithmetic runs in double and is cast to decimal last: decimal division would widen to
38 digits and round differently.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanrisk.policy import DOMAINS, TIERS, RiskPolicy


def loan_to_value(policy: RiskPolicy) -> Column:
    """Loan principal as a percentage of the property value, unrounded.

    The documented rules know no ratio to a value that is not positive.
    """
    loan, value = (F.col(c).cast("double") for c in ("loan_amount", "property_value"))
    ratio = loan / value
    return (F.when(value > 0, ratio) if policy.documented_rules else ratio) * 100


def composite_score(policy: RiskPolicy) -> Column:
    """Weighted sum of inverse credit score, loan-to-value, marks and utilization."""
    p = policy
    score, ltv, marks, utilization = (
        F.col(c).cast("double")
        for c in ("latest_credit_score", "current_ltv", "derogatory_marks",
                  "credit_utilization_pct")
    )
    total = (
        (1 - score / p.credit_full_scale) * p.credit_weight
        + ltv / p.ltv_full_scale * p.ltv_weight
        + marks / p.marks_full_scale * p.marks_weight
        + utilization / p.utilization_full_scale * p.utilization_weight
    ) * p.score_multiplier
    if not p.documented_rules:
        return total
    # greatest/least skip NULL, so an unknown score has to be kept unknown.
    return F.when(total.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)))


def half_up_cents(value: Column) -> Column:
    """Two decimals, halves up, decided in double.

    A plain cast rounds the printed digits of the double, where a sum that should end in 5
    may print as ...4999; scaling first gives the halves back.
    """
    return F.floor(value * 100 + 0.5).cast("decimal(18,0)") * F.lit(Decimal("0.01"))


def _by_tier(score: Column, attribute: str) -> Column:
    *ranked, lowest = TIERS
    branches = F
    for tier in ranked:
        branches = branches.when(score >= tier.min_score, F.lit(getattr(tier, attribute)))
    return branches.otherwise(F.lit(getattr(lowest, attribute)))


def risk_category(score: Column) -> Column:
    return _by_tier(score, "name")


def default_probability(score: Column) -> Column:
    return _by_tier(score, "default_probability")


def recommended_action(score: Column) -> Column:
    return _by_tier(score, "recommended_action")


def tier_rank(category: Column) -> Column:
    """1 for the best tier to 5 for the worst."""
    return F.array_position(F.array(*map(F.lit, DOMAINS["risk_category"])), category).cast("int")


def score_declined(policy: RiskPolicy) -> Column:
    """The newest score lies too far below the best one of the window that ends with it."""
    return F.col("window_high") - F.col("latest_credit_score") > policy.decline_points


def has_new_marks() -> Column:
    """More marks than at the previous observation; a first observation counts as new."""
    return F.col("derogatory_marks") > F.coalesce("previous_marks", F.lit(0))


def risk_flags(policy: RiskPolicy) -> Column:
    """Warning flags as an array of names.

    The coded form keeps a NULL slot for each flag that does not fire; the documented form
    holds fired flags only. A comparison with NULL fires nothing in either.
    """
    ltv, score = F.col("current_ltv"), F.col("latest_credit_score")
    marks, utilization = F.col("derogatory_marks"), F.col("credit_utilization_pct")
    rules = {
        "HIGH_LTV": ltv > policy.ltv_limit,
        "LOW_CREDIT": score < policy.credit_floor,
    }
    if policy.documented_rules:
        rules["SCORE_DECLINE"] = score_declined(policy)
        rules["DEROGATORY_MARKS"] = has_new_marks()
    else:
        rules["DEROGATORY_MARKS"] = marks > 0
    rules["HIGH_UTILIZATION"] = utilization > policy.utilization_limit
    if policy.documented_rules:
        rules["PAYMENT_ISSUES"] = F.col("payment_history_score") < policy.payment_floor
    slots = F.array(*(F.when(fires, F.lit(flag)) for flag, fires in rules.items()))
    return F.array_compact(slots) if policy.documented_rules else slots


def ltv_band(ltv: Column) -> Column:
    """Equity band; 80 itself is standard and 95 itself elevated."""
    return (
        F.when(ltv < 65, "excellent")
        .when(ltv <= 80, "standard")
        .when(ltv <= 95, "elevated")
        .when(ltv > 95, "high")
    )


def metric_id(calculation_date: Column) -> Column:
    """Key of an (account, date) pair, unique because the date part has a fixed width.

    It depends on the row alone, so retried tasks and re-runs give the same id.
    """
    digits = F.replace(calculation_date.cast("string"), F.lit("-"), F.lit(""))
    return F.concat(F.lit("RISK"), digits, "account_id")
