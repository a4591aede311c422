"""Risk metrics per account: at one date, or at every date of a calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanrisk.functions import scoring
from loanrisk.operators.history import (
    KEY,
    Calendar,
    at_each_date,
    in_force,
    latest_profiles,
    latest_scores,
    observations_until,
    profiles_in_force,
)
from loanrisk.policy import RiskPolicy

_ACCOUNT_INPUTS = (KEY, "loan_amount", "property_value")


def _joined(accounts: DataFrame, observed: DataFrame, policy: RiskPolicy) -> DataFrame:
    """Accounts with their observation and ratio.

    Accounts without an observation drop out (``accounts_without_scores`` lists them). Both
    sides hold one row per account, and ``observed`` arrives partitioned by the join key.
    """
    joined = accounts.select(*_ACCOUNT_INPUTS).join(observed, KEY)
    return joined.withColumn("current_ltv", scoring.loan_to_value(policy))


def _tiers() -> dict[str, Column]:
    score = F.col("latest_credit_score")
    return {
        "risk_category": scoring.risk_category(score),
        "default_probability": scoring.default_probability(score),
        "recommended_action": scoring.recommended_action(score),
    }


def assess(accounts: DataFrame, observed: DataFrame, policy: RiskPolicy) -> DataFrame:
    """Join accounts with their observation and evaluate the risk rules."""
    return (
        _joined(accounts, observed, policy)
        .withColumn("risk_score", scoring.composite_score(policy))
        .withColumns(_tiers() | {"risk_flags": scoring.risk_flags(policy)})
    )


def _unstorable(policy: RiskPolicy) -> dict[str, Column]:
    """Why the documented contract cannot store a row, on the unrounded ratio.

    What is stored is what none of these holds for, so every row is either stored or rejected
    with a reason. The score is unknown just where one of its inputs is.
    """
    ltv = F.col("current_ltv")
    outside = (ltv < 0) | ltv.try_cast(policy.ltv_type).isNull()
    return {
        "LTV_UNDEFINED": ltv.isNull(),
        "LTV_OUT_OF_RANGE": ltv.isNotNull() & outside,
        "SCORE_MISSING": F.col("latest_credit_score").isNull(),
        "MARKS_MISSING": F.col("derogatory_marks").isNull(),
        "UTILIZATION_MISSING": F.col("credit_utilization_pct").isNull(),
    }


def _storable(rows: DataFrame, policy: RiskPolicy) -> DataFrame:
    if not policy.documented_rules:
        return rows
    for broken in _unstorable(policy).values():
        rows = rows.filter(~broken)
    return rows


def _stored(assessed: DataFrame, policy: RiskPolicy) -> DataFrame:
    """Round to the stored types; the documented contract leaves out what does not fit."""
    score = F.col("risk_score")
    if policy.documented_rules:
        score = scoring.half_up_cents(score)
    return _storable(assessed, policy).withColumns({
        "current_ltv": F.col("current_ltv").cast(policy.ltv_type),
        "risk_score_normalized": score.cast(policy.score_type),
        "default_probability": F.col("default_probability").cast("decimal(5,4)"),
    })


def _shape(rows: DataFrame, calculation_date: Column) -> DataFrame:
    return rows.select(
        scoring.metric_id(calculation_date).alias("metric_id"),
        KEY,
        calculation_date.alias("calculation_date"),
        "current_ltv",
        "latest_credit_score",
        "risk_score_normalized",
        "risk_category",
        "default_probability",
        "recommended_action",
        "risk_flags",
    )


def _observed(scores: DataFrame, as_of: date, policy: RiskPolicy) -> DataFrame:
    if policy.documented_rules:
        return latest_profiles(scores, policy, as_of)
    return latest_scores(scores, as_of)


def build_risk_metrics(
    accounts: DataFrame, scores: DataFrame, as_of: date, policy: RiskPolicy
) -> DataFrame:
    """One metrics row per scored account, from what was known at ``as_of``."""
    return metrics_of(accounts, _observed(scores, as_of, policy), as_of, policy)


def metrics_of(
    accounts: DataFrame, observed: DataFrame, as_of: date, policy: RiskPolicy
) -> DataFrame:
    """The metrics rows of a date from one profile per account."""
    return _shape(_stored(assess(accounts, observed, policy), policy), F.lit(as_of))


def account_tiers(
    accounts: DataFrame, scores: DataFrame, as_of: date, policy: RiskPolicy
) -> DataFrame:
    """The tier of each account that has a metrics row, from its newest observation alone."""
    rows = _storable(_joined(accounts, latest_scores(scores, as_of), policy), policy)
    return rows.withColumns(_tiers()).select(
        KEY,
        F.lit(as_of).alias("calculation_date"),
        "risk_category",
        F.col("default_probability").cast("decimal(5,4)").alias("default_probability"),
    )


def metric_rejects(
    accounts: DataFrame, scores: DataFrame, as_of: date, policy: RiskPolicy
) -> DataFrame:
    """Scored accounts the documented contract cannot store, with the reasons.

    Together with the rows of ``build_risk_metrics`` these are all scored accounts.
    """
    return rejects_of(accounts, latest_scores(scores, as_of), policy)


def rejects_of(accounts: DataFrame, observed: DataFrame, policy: RiskPolicy) -> DataFrame:
    """The same from one profile or newest observation per account."""
    rows = _joined(accounts, observed, policy)
    reasons = (F.when(broken, F.lit(name)) for name, broken in _unstorable(policy).items())
    return rows.select(
        KEY, "score_id", F.array_compact(F.array(*reasons)).alias("reasons")
    ).filter(F.size("reasons") > 0)


def risk_metrics_history(
    accounts: DataFrame, scores: DataFrame, calendar: Calendar, policy: RiskPolicy
) -> DataFrame:
    """Metrics rows for every date of a calendar, in one pass over the observations.

    Row for row what ``build_risk_metrics`` gives at each date on its own.
    """
    if policy.documented_rules:
        intervals = profiles_in_force(scores, calendar, policy)
    else:
        intervals = in_force(scores, calendar)
    # The rules are evaluated once per interval, before it fans out to its dates.
    rows = _stored(assess(accounts, intervals, policy), policy)
    return _shape(at_each_date(rows, calendar), F.col("calculation_date"))


def accounts_without_scores(
    accounts: DataFrame, scores: DataFrame, as_of: date | None = None
) -> DataFrame:
    """Accounts with no observation known at ``as_of``: those a run at that date leaves out."""
    # Distinct first: an account's observations collapse before they are shuffled.
    scored = observations_until(scores, as_of).select(KEY).distinct()
    return accounts.join(scored, KEY, "left_anti")
