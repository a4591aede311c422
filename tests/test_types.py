"""Declared types of every registered result, before they are rendered for comparison."""

from __future__ import annotations

import pytest

from loanrisk.plans import registry
from loanrisk.sources.schemas import CREDIT_SCORES, MORTGAGE_ACCOUNTS, RISK_METRICS, staged


def ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


METRICS = ddl(RISK_METRICS)
CONTRACT_METRICS = METRICS.replace("risk_score_normalized decimal(6,2)", "risk_score_normalized decimal(5,2)")
SUMMARY = (
    "risk_category string, account_count bigint, total_loan_amount decimal(20,2), avg_credit_score decimal(10,2), "
    "avg_ltv decimal(10,2), avg_risk_score decimal(10,2), high_risk_flags bigint"
)
VIOLATIONS = "table_name string, row_key string, rule string, column_name string, value string"
ORPHANS = "table_name string, row_key string, missing_parent string"
DATED_SUMMARY = f"calculation_date date, {SUMMARY}"

TYPES = {
    "mortgage_accounts": ddl(MORTGAGE_ACCOUNTS),
    "credit_scores": ddl(CREDIT_SCORES),
    "latest_scores": "account_id string, latest_credit_score int, derogatory_marks int, credit_utilization_pct decimal(5,2)",
    "risk_metrics_as_coded": METRICS,
    "risk_metrics": CONTRACT_METRICS,
    "risk_summary_as_coded": SUMMARY,
    "risk_summary": SUMMARY,
    "portfolio_risk_summary": (
        "risk_category string, account_count bigint, total_loan_amount string, avg_credit_score decimal(10,2), "
        "avg_ltv string, avg_risk_score decimal(10,2), high_risk_flags bigint"
    ),
    "high_risk_accounts_top10": (
        "account_id string, customer_id string, property_province string, loan_amount string, "
        "latest_credit_score int, current_ltv string, risk_score decimal(6,1), risk_category string, "
        "risk_flags array<string>, recommended_action string"
    ),
    "high_risk_top10_with_orphans": (
        "account_id string, customer_id string, property_province string, loan_amount string, "
        "latest_credit_score int, current_ltv string, risk_score decimal(6,1), risk_category string, "
        "risk_flags array<string>, recommended_action string"
    ),
    "risk_metrics_carried": CONTRACT_METRICS,
    "orders_as_of_scores": (
        "order_id bigint, account_id string, order_date date, score_id string, score_date date, credit_score int"
    ),
    "orders_as_of_metrics": (
        "order_id bigint, account_id string, order_date date, metric_id string, risk_category string, "
        "risk_score_normalized decimal(5,2)"
    ),
    "retried_scores": ddl(CREDIT_SCORES),
    "open_rejects": "score_id string, account_id string, reasons array<string>, rejected_on date",
    "credit_score_trends_top5": (
        "account_id string, score_id string, score_date date, credit_score int, score_source string, "
        "derogatory_marks int, credit_utilization string"
    ),
    "load_counts": "table_name string, row_count bigint",
    "ltv_bands": "ltv_band string, account_count bigint, total_loan_amount decimal(20,2)",
    "risk_flag_counts": "risk_flag string, account_count bigint",
    "flag_actions": "account_id string, calculation_date date, risk_flag string, flag_action string",
    "tier_policy_lookup": (
        "account_id string, risk_category string, tier_rank int, default_probability decimal(5,4), "
        "pd_low decimal(5,4), pd_high decimal(5,4), portfolio_action string"
    ),
    "score_decline_90d": (
        "account_id string, score_date date, latest_credit_score int, window_high int, score_drop int"
    ),
    "new_derogatory_marks": (
        "account_id string, score_date date, derogatory_marks int, previous_marks int, new_marks int"
    ),
    "payment_issues": "account_id string, score_id string, score_date date, payment_history_score int",
    "score_trend": (
        "account_id string, observations bigint, first_score int, latest_score int, score_change int, trend string"
    ),
    "score_progression": (
        "account_id string, score_id string, score_date date, credit_score int, previous_score int, "
        "score_change int, days_since_previous int"
    ),
    "high_risk_alerts": (
        "calculation_date date, account_id string, risk_category string, latest_credit_score int, "
        "risk_score_normalized decimal(5,2), recommended_action string, risk_flags array<string>"
    ),
    "accounts_without_scores": "account_id string, customer_id string",
    "normalize_staging": (
        "account_id string, ingest_seq int, property_province string, property_type string, employment_status string"
    ),
    "normalize_staging_scores": "score_id string, ingest_seq int, score_source string",
    "dedupe_scores": ddl(staged(CREDIT_SCORES)),
    "staging_quarantine": "score_id string, account_id string, ingest_seq int, status string, reasons array<string>",
    "metric_rejects": "account_id string, score_id string, reasons array<string>",
    "dq_primary_key_violations": "table_name string, key_value string, copies bigint",
    "dq_foreign_key_violations": ORPHANS,
    "dq_check_violations": VIOLATIONS,
    "dq_metric_check_violations": VIOLATIONS,
    "dq_not_null_violations": "table_name string, column_name string, null_rows bigint",
    "dq_domain_violations": VIOLATIONS,
    "upsert_accounts": ddl(MORTGAGE_ACCOUNTS),
    "append_scores": ddl(CREDIT_SCORES),
    "load_new_scores": ddl(CREDIT_SCORES),
    "load_orphans": ORPHANS,
    "append_orphans": ORPHANS,
    "risk_summary_by_date": DATED_SUMMARY,
    "risk_summary_by_province": DATED_SUMMARY.replace("risk_category", "property_province"),
    "risk_history": CONTRACT_METRICS,
    "risk_point_in_time": METRICS,
}


@pytest.mark.parametrize("name", sorted(registry._QUERIES))
def test_declared_types(spark, sf_dir, name):
    assert ddl(registry._QUERIES[name](spark, sf_dir).schema) == TYPES[name]
