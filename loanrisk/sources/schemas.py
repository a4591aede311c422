"""Explicit table contracts; nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _column(name: str, kind: DataType, comment: str, nullable: bool = False) -> StructField:
    return StructField(name, kind, nullable, {"comment": comment})


MORTGAGE_ACCOUNTS = StructType([
    _column("account_id", StringType(), "Key of the mortgage account"),
    _column("customer_id", StringType(), "Customer the account belongs to"),
    _column("property_value", DecimalType(15, 2), "What the property is worth now, in dollars"),
    _column("loan_amount", DecimalType(15, 2), "Principal lent, in dollars"),
    _column("interest_rate", DecimalType(5, 3), "Yearly rate, in percent"),
    _column("loan_term_months", IntegerType(), "Months until the loan is repaid"),
    _column("origination_date", DateType(), "Day the loan was made"),
    _column("property_province", StringType(), "Two-letter code of the province"),
    _column("property_type", StringType(), "Kind of building"),
    _column("employment_status", StringType(), "How the borrower is employed"),
    _column("annual_income", DecimalType(15, 2), "Borrower's income per year, in dollars"),
])

CREDIT_SCORES = StructType([
    _column("score_id", StringType(), "Key of the observation"),
    _column("account_id", StringType(), "Account it is about"),
    _column("score_date", DateType(), "Day of the observation"),
    _column("credit_score", IntegerType(), "Score from 300 to 900"),
    _column("score_source", StringType(), "Bureau that reported it"),
    _column("payment_history_score", IntegerType(), "How reliably payments came in, 0 to 100", True),
    _column("credit_utilization_pct", DecimalType(5, 2), "Used share of the credit granted, in percent", True),
    _column("total_accounts", IntegerType(), "Credit accounts held"),
    _column("derogatory_marks", IntegerType(), "Adverse entries on file"),
])

RISK_METRICS = StructType([
    _column("metric_id", StringType(), "Key of the metrics row"),
    _column("account_id", StringType(), "Account it is about"),
    _column("calculation_date", DateType(), "Day the row describes"),
    _column("current_ltv", DecimalType(6, 2), "Loan as a percentage of the property value"),
    _column("latest_credit_score", IntegerType(), "Score of the newest observation"),
    _column("risk_score_normalized", DecimalType(6, 2), "Weighted score"),
    _column("risk_category", StringType(), "Tier from the newest score"),
    _column("default_probability", DecimalType(5, 4), "Tier's probability of default, 0 to 1", True),
    _column("recommended_action", StringType(), "What the tier calls for"),
    _column("risk_flags", ArrayType(StringType()), "Names of the warnings raised", True),
])

HIGH_RISK_ALERTS = StructType([
    _column("calculation_date", DateType(), "Day the row describes"),
    _column("account_id", StringType(), "Account it is about"),
    _column("risk_category", StringType(), "Tier from the newest score"),
    _column("latest_credit_score", IntegerType(), "Score of the newest observation"),
    _column("risk_score_normalized", DecimalType(6, 2), "Weighted score"),
    _column("recommended_action", StringType(), "What the tier calls for"),
    _column("risk_flags", ArrayType(StringType()), "Names of the warnings raised", True),
])

REJECTED_METRICS = StructType([
    _column("account_id", StringType(), "Account without metrics"),
    _column("score_id", StringType(), "Its newest observation"),
    _column("reasons", ArrayType(StringType()), "Why its metrics cannot be stored"),
    _column("calculation_date", DateType(), "Day the row describes"),
])

SUMMARY_PARTS = StructType([
    _column("risk_category", StringType(), "Tier from the newest score"),
    _column("property_province", StringType(), "Province of the property", True),
    _column("account_count", LongType(), "Accounts"),
    _column("total_loan_amount", DecimalType(20, 2), "Sum of their loans", True),
    _column("latest_credit_score_sum", DecimalType(20, 2), "Sum of newest scores", True),
    _column("latest_credit_score_known", LongType(), "Accounts with a score"),
    _column("current_ltv_sum", DecimalType(20, 2), "Sum of loan-to-value percentages", True),
    _column("current_ltv_known", LongType(), "Accounts with a loan-to-value percentage"),
    _column("risk_score_normalized_sum", DecimalType(20, 2), "Sum of weighted scores", True),
    _column("risk_score_normalized_known", LongType(), "Accounts with a weighted score"),
    _column("high_risk_flags", LongType(), "Accounts with a warning"),
    _column("calculation_date", DateType(), "Day the row describes"),
])

TABLES = {
    "mortgage_accounts": (MORTGAGE_ACCOUNTS, "Accounts, one row each"),
    "credit_scores": (CREDIT_SCORES, "Observations of credit standing, by date"),
    "risk_metrics": (RISK_METRICS, "Metrics of an account at a date"),
}


def staged(schema: StructType) -> StructType:
    """The staging form of a contract: its columns, none required, plus the arrival number."""
    fields = [StructField(f.name, f.dataType, True, f.metadata) for f in schema]
    return StructType([*fields, _column("ingest_seq", IntegerType(), "Order of arrival")])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to the contract's columns and types, in the contract's order."""
    return df.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema)
    )


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
