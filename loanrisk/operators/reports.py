"""Portfolio reports over one calculation date of the risk metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.functions.scoring import ltv_band, tier_rank
from loanrisk.functions.text import money, percent
from loanrisk.operators.history import KEY
from loanrisk.policy import HIGH_RISK_TIERS


def snapshot(metrics: DataFrame, calculation_date: date | None = None) -> DataFrame:
    """The metrics of one calculation date, by default the latest.

    On the history table the filter selects one partition. Without it every earlier run
    would count again in a report. Finding the latest date reads that column of all rows; of
    a stored table, ``catalog.latest_date`` takes it from the list of partitions instead.
    """
    day = F.col("calculation_date")
    if calculation_date is None:
        return metrics.filter(day == metrics.agg(F.max(day)).scalar())
    return metrics.filter(day == F.lit(calculation_date))


def _average(column: str) -> str:
    return f"CAST(round(avg(CAST({column} AS DECIMAL(10,2))), 2) AS DECIMAL(10,2))"


#: The tier summary's columns over metrics joined with their accounts; the stored view and the
#: function below are both made of these.
SUMMARY = {
    "account_count": "count(1)",
    "total_loan_amount": "CAST(sum(loan_amount) AS DECIMAL(20,2))",
    "avg_credit_score": _average("latest_credit_score"),
    "avg_ltv": _average("current_ltv"),
    "avg_risk_score": _average("risk_score_normalized"),
    "high_risk_flags": "count_if(size(risk_flags) > 0)",
}


def risk_summary(
    metrics: DataFrame, accounts: DataFrame, calculation_date: date | None = None
) -> DataFrame:
    """Accounts, exposure and averages per tier; unordered."""
    joined = snapshot(metrics, calculation_date).join(accounts.select(KEY, "loan_amount"), KEY)
    columns = (F.expr(sql).alias(name) for name, sql in SUMMARY.items())
    return joined.groupBy("risk_category").agg(*columns)


def portfolio_risk_summary(summary: DataFrame) -> DataFrame:
    """The tier summary in report form, best tier first."""
    return summary.orderBy(tier_rank(F.col("risk_category"))).select(
        "risk_category",
        "account_count",
        money(F.col("total_loan_amount")).alias("total_loan_amount"),
        "avg_credit_score",
        percent(F.col("avg_ltv")).alias("avg_ltv"),
        "avg_risk_score",
        "high_risk_flags",
    )


def high_risk(metrics: DataFrame) -> DataFrame:
    return metrics.filter(F.col("risk_category").isin(*HIGH_RISK_TIERS))


def high_risk_accounts(
    metrics: DataFrame,
    accounts: DataFrame,
    calculation_date: date | None = None,
    top: int = 10,
    owned: bool = False,
) -> DataFrame:
    """The riskiest accounts of the two worst tiers, riskiest first.

    A metrics row without an account, which the foreign-key check reports, takes no place in the
    list: only the keys of accounts are read for that, and the rows of accounts meet the
    ``top`` rows alone. ``owned`` is for metrics that come from a join with these accounts: there
    is no such row then, and the keys are not read again.
    """
    listed = high_risk(snapshot(metrics, calculation_date))
    if not owned:
        listed = listed.join(accounts.select(KEY), KEY, "left_semi")
    worst = listed.orderBy(F.desc("risk_score_normalized"), KEY).limit(top)
    owners = accounts.select(KEY, "customer_id", "property_province", "loan_amount")
    # The limit bounds the broadcast side: ``top`` rows.
    return owners.join(F.broadcast(worst), KEY).orderBy(F.desc("risk_score_normalized"), KEY).select(
        KEY,
        "customer_id",
        "property_province",
        money(F.col("loan_amount")).alias("loan_amount"),
        "latest_credit_score",
        percent(F.round("current_ltv", 1)).alias("current_ltv"),
        F.round("risk_score_normalized", 1).alias("risk_score"),
        "risk_category",
        "risk_flags",
        "recommended_action",
    )


def credit_score_trends(
    metrics: DataFrame,
    scores: DataFrame,
    calculation_date: date | None = None,
    top: int = 5,
) -> DataFrame:
    """All observations of the riskiest accounts, newest first within an account."""
    riskiest = (
        snapshot(metrics, calculation_date)
        .orderBy(F.desc("risk_score_normalized"), KEY)
        .limit(top)
        .select(KEY)
    )
    # The limit bounds the broadcast side: ``top`` keys.
    return (
        scores.join(F.broadcast(riskiest), KEY, "left_semi")
        .orderBy(KEY, F.desc("score_date"), F.desc("score_id"))
        .select(
            KEY,
            "score_id",
            "score_date",
            "credit_score",
            "score_source",
            "derogatory_marks",
            percent(F.round("credit_utilization_pct", 1)).alias("credit_utilization"),
        )
    )


def ltv_bands(accounts: DataFrame) -> DataFrame:
    """Accounts and exposure per loan-to-value band, banded on the unrounded ratio."""
    ratio = F.try_divide(
        F.col("loan_amount").cast("double"), F.col("property_value").cast("double")
    )
    return (
        accounts.select(ltv_band(ratio * 100).alias("ltv_band"), "loan_amount")
        .groupBy("ltv_band")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            F.sum("loan_amount").cast("decimal(20,2)").alias("total_loan_amount"),
        )
    )


def _each_flag(metrics: DataFrame) -> DataFrame:
    flags = metrics.select(KEY, "calculation_date", F.explode("risk_flags").alias("risk_flag"))
    return flags.filter(F.col("risk_flag").isNotNull())


def risk_flag_counts(metrics: DataFrame, calculation_date: date | None = None) -> DataFrame:
    """How many accounts carry each flag."""
    flags = _each_flag(snapshot(metrics, calculation_date))
    return flags.groupBy("risk_flag").agg(F.count(F.lit(1)).alias("account_count"))


def flag_actions(
    metrics: DataFrame, flag_policy: DataFrame, calculation_date: date | None = None
) -> DataFrame:
    """The follow-up each raised flag asks for; the policy has one row per flag."""
    flags = _each_flag(snapshot(metrics, calculation_date))
    return flags.join(F.broadcast(flag_policy), "risk_flag").select(
        KEY, "calculation_date", "risk_flag", "flag_action"
    )


def tier_policy_lookup(
    rows: DataFrame, tier_policy: DataFrame, calculation_date: date | None = None
) -> DataFrame:
    """Each account with its tier's probability range and portfolio action.

    ``rows``: stored metrics, or ``metrics.account_tiers``, which needs no history.
    """
    rows = snapshot(rows, calculation_date)
    return rows.join(F.broadcast(tier_policy), "risk_category").select(
        KEY, "risk_category", "tier_rank", "default_probability", "pd_low", "pd_high",
        "portfolio_action",
    )


def high_risk_alerts(metrics: DataFrame, calculation_date: date | None = None) -> DataFrame:
    """One alert per high-risk account and calculation date."""
    return high_risk(snapshot(metrics, calculation_date)).select(
        "calculation_date",
        KEY,
        "risk_category",
        "latest_credit_score",
        "risk_score_normalized",
        "recommended_action",
        "risk_flags",
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    first, *rest = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    )
    for counted in rest:
        first = first.unionByName(counted)
    return first
