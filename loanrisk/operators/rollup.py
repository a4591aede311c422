"""Summaries kept as sums and counts, so that parts add up and a date's report reads a few rows.

A part is a row per calculation date, tier and province. Any coarser summary, of a tier, a province, a
date or several dates, is a sum over parts; averages are divided last. Parts of disjoint sets of accounts
can be added likewise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.operators.history import KEY
from loanrisk.sources.schemas import SUMMARY_PARTS, conform

#: What the summary averages, and the column that holds it.
AVERAGED = {
    "avg_credit_score": "latest_credit_score",
    "avg_ltv": "current_ltv",
    "avg_risk_score": "risk_score_normalized",
}


def _average(column: str) -> str:
    """The average of known values, to six places and then to two, as ``avg`` of decimals rounds."""
    mean = f"sum({column}_sum) / nullif(sum({column}_known), 0)"
    return f"CAST(round(CAST({mean} AS DECIMAL(14,6)), 2) AS DECIMAL(10,2))"


#: The tier summary's columns over parts: the same as those over metrics joined with accounts.
ROLLED_UP = {
    "account_count": "sum(account_count)",
    "total_loan_amount": "CAST(sum(total_loan_amount) AS DECIMAL(20,2))",
    **{name: _average(column) for name, column in AVERAGED.items()},
    "high_risk_flags": "sum(high_risk_flags)",
}


def summary_parts(metrics: DataFrame, accounts: DataFrame) -> DataFrame:
    """Sums and counts per calculation date, tier and province; metrics without an account have no part.

    Loan amounts and provinces are those of ``accounts`` now: parts of a date tell what the accounts were
    when the parts were made.
    """
    joined = metrics.join(accounts.select(KEY, "loan_amount", "property_province"), KEY)
    averaged = []
    for column in AVERAGED.values():
        averaged += [
            F.sum(F.col(column).cast("decimal(10,2)")).alias(f"{column}_sum"),
            F.count(column).alias(f"{column}_known"),
        ]
    parts = joined.groupBy("calculation_date", "risk_category", "property_province").agg(
        F.count(F.lit(1)).alias("account_count"),
        F.sum("loan_amount").alias("total_loan_amount"),
        *averaged,
        F.count_if(F.size("risk_flags") > 0).alias("high_risk_flags"),
    )
    return conform(parts, SUMMARY_PARTS)


def rolled_up(parts: DataFrame, *by: str) -> DataFrame:
    """The summary by any of the parts' keys; ``by`` nothing for one row over all of them."""
    return parts.groupBy(*by).agg(*(F.expr(sql).alias(name) for name, sql in ROLLED_UP.items()))
