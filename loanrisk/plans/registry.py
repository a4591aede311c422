"""The registered queries, wired onto the given tables.

Each value takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables.
``comparable`` renders the types engines hash differently (decimals, dates, arrays); the
operators themselves keep the declared types.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType

from loanrisk.operators import carried, history, metrics, quality, reports, staging
from loanrisk.operators.asof import as_of_join
from loanrisk.operators.history import KEY, Calendar
from loanrisk.operators.rollup import rolled_up, summary_parts
from loanrisk.policy import AS_CODED, CONTRACT, RiskPolicy, flag_policy, tier_policy
from loanrisk.sources import sample
from loanrisk.sources.schemas import (
    CREDIT_SCORES,
    MORTGAGE_ACCOUNTS,
    RISK_METRICS,
    required_columns,
    staged,
)

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = sample.ANCHOR
BIWEEKLY = Calendar(start=date(2023, 1, 2), count=27)
# What is loaded already when the staged batch arrives.
ACCOUNTS_LOADED_UNTIL = date(2023, 1, 1)
SCORES_LOADED_UNTIL = date(2023, 7, 1)
# Dates that a state is carried over, and the date of the first of two loads.
CARRIED_DATES = (date(2022, 9, 1), date(2023, 5, 1), AS_OF)
FIRST_LOAD = date(2023, 6, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, dates as ISO text, arrays as text with NULL slots spelled out."""

    def render(name: str, kind: object):
        column = F.col(name)
        if isinstance(kind, DecimalType):
            return column.cast("double").alias(name)
        if isinstance(kind, DateType):
            return column.cast("string").alias(name)
        if isinstance(kind, ArrayType):
            return F.array_join(column, "|", "NULL").alias(name)
        return column

    return df.select(*(render(f.name, f.dataType) for f in df.schema))


def _metrics(spark: SparkSession, sf_dir: str, policy: RiskPolicy) -> DataFrame:
    return metrics.build_risk_metrics(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores(spark, sf_dir),
        AS_OF,
        policy,
    )


def _summary(spark: SparkSession, sf_dir: str, policy: RiskPolicy) -> DataFrame:
    accounts = sample.mortgage_accounts(spark, sf_dir)
    return reports.risk_summary(_metrics(spark, sf_dir, policy), accounts, AS_OF)


def _portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.portfolio_risk_summary(_summary(spark, sf_dir, AS_CODED))


def _top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = sample.mortgage_accounts(spark, sf_dir)
    return reports.high_risk_accounts(_metrics(spark, sf_dir, AS_CODED), accounts, AS_OF, owned=True)


def _top5_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = sample.credit_scores(spark, sf_dir)
    return reports.credit_score_trends(_metrics(spark, sf_dir, AS_CODED), scores, AS_OF)


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.load_counts({
        "mortgage_accounts": sample.mortgage_accounts(spark, sf_dir),
        "credit_scores": sample.credit_scores(spark, sf_dir),
        "risk_metrics": _metrics(spark, sf_dir, AS_CODED),
    })


def _latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_scores(sample.credit_scores(spark, sf_dir)).select(
        KEY, "latest_credit_score", "derogatory_marks", "credit_utilization_pct"
    )


def _history(spark: SparkSession, sf_dir: str, policy: RiskPolicy) -> DataFrame:
    return metrics.risk_metrics_history(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores(spark, sf_dir),
        BIWEEKLY,
        policy,
    )


def _rolled_up(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """The summaries of all dates of the calendar, added up from parts."""
    history = _history(spark, sf_dir, CONTRACT)
    parts = summary_parts(history, sample.mortgage_accounts(spark, sf_dir))
    return rolled_up(parts, "calculation_date", by)


def _without_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.accounts_without_scores(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores_misfiled(spark, sf_dir),
        AS_OF,
    )
    return found.select(KEY, "customer_id")


def _clean_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging.normalize(sample.credit_scores_raw(spark, sf_dir))
    return staging.deduplicate(staged, "score_id")


def _judged(scores: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = sample.mortgage_accounts(spark, sf_dir)
    return staging.with_reasons(scores, staging.score_rules(), parent)


def _judged_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging.normalize(sample.mortgage_accounts_raw(spark, sf_dir))
    return staging.with_reasons(
        staging.deduplicate(staged, KEY), staging.account_rules()
    )


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = staging.normalize(sample.mortgage_accounts_raw(spark, sf_dir))
    return accounts.select(
        KEY, "ingest_seq", "property_province", "property_type", "employment_status"
    )


def _normalized_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = staging.normalize(sample.credit_scores_raw(spark, sf_dir))
    return scores.select("score_id", "ingest_seq", "score_source")


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged(_clean_scores(spark, sf_dir), spark, sf_dir)
    status = F.when(F.size("reasons") == 0, "valid").otherwise("rejected")
    return judged.select("score_id", KEY, "ingest_seq", status.alias("status"), "reasons")


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = sample.mortgage_accounts(spark, sf_dir).filter(
        F.col("origination_date") < F.lit(ACCOUNTS_LOADED_UNTIL)
    )
    batch, _ = staging.split(_judged_accounts(spark, sf_dir))
    return staging.upsert(loaded, batch, KEY)


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = sample.credit_scores(spark, sf_dir).filter(
        F.col("score_date") < F.lit(SCORES_LOADED_UNTIL)
    )
    # Known rows go first: the anti join shares the partitioning of the deduplication, and
    # only new rows are checked.
    new = staging.unseen(
        loaded,
        _clean_scores(spark, sf_dir),
        "score_id",
        batch_keys=sample.credit_scores_raw(spark, sf_dir),
    )
    valid, _ = staging.split(_judged(new, spark, sf_dir))
    return loaded.unionByName(valid.select(*loaded.columns))


def _load(spark: SparkSession, sf_dir: str) -> staging.Loaded:
    """The staged batch brought into tables that hold what was loaded before."""
    return staging.load(
        sample.mortgage_accounts(spark, sf_dir).filter(
            F.col("origination_date") < F.lit(ACCOUNTS_LOADED_UNTIL)
        ),
        sample.credit_scores(spark, sf_dir).filter(
            F.col("score_date") < F.lit(SCORES_LOADED_UNTIL)
        ),
        sample.mortgage_accounts_raw(spark, sf_dir),
        sample.credit_scores_raw(spark, sf_dir),
    )


def _loaded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir).new_scores


def _orphans_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New observations without a loaded account: none, as the load checks against these."""
    loaded = _load(spark, sf_dir)
    return quality.foreign_key_violations(
        loaded.new_scores, "credit_scores", "score_id", loaded.accounts, KEY
    )


def _orphans_of_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same if the batch is checked against all accounts instead of the loaded ones."""
    loaded = sample.credit_scores(spark, sf_dir).filter(
        F.col("score_date") < F.lit(SCORES_LOADED_UNTIL)
    )
    new, _ = staging.stage_scores(
        sample.credit_scores_raw(spark, sf_dir), loaded, sample.mortgage_accounts(spark, sf_dir)
    )
    accounts = _load(spark, sf_dir).accounts
    return quality.foreign_key_violations(new, "credit_scores", "score_id", accounts, KEY)


def _number(account: str = KEY):
    """The number in an account's key."""
    return F.substring(account, 4, 20).cast("bigint")


def _carried_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics at the date, from a state carried over earlier dates.

    Observations arrive in loads that have nothing to do with their dates, so every date gets some that
    are late and hands some on.
    """
    scores = sample.credit_scores(spark, sf_dir)
    load = F.pmod(F.xxhash64("score_id"), F.lit(len(CARRIED_DATES)))
    state = waiting = None
    for number, day in enumerate(CARRIED_DATES):
        arrived = scores.filter(load == number)
        if waiting is not None:
            arrived = arrived.unionByName(waiting)
        state = carried.advance(state, arrived, day, CONTRACT)
        waiting = carried.pending(arrived, day)
    accounts = sample.mortgage_accounts(spark, sf_dir)
    return carried.metrics_from_state(accounts, state, CARRIED_DATES[-1], CONTRACT)


def _orders_as_of_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of_join(
        sample.dated_orders(spark, sf_dir), sample.credit_scores(spark, sf_dir), KEY,
        "order_date", "order_id", "score_date", "score_id", ["score_id", "score_date", "credit_score"],
    )


def _orders_as_of_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of_join(
        sample.dated_orders(spark, sf_dir), _history(spark, sf_dir, CONTRACT), KEY,
        "order_date", "order_id", "calculation_date", "metric_id",
        ["metric_id", "risk_category", "risk_score_normalized"],
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[staging.Loaded, staging.Loaded]:
    """All observations come with every other account, the remaining accounts with a second batch."""
    raw_accounts = sample.mortgage_accounts_raw(spark, sf_dir)
    raw_scores = sample.credit_scores_raw(spark, sf_dir)
    nothing = spark.createDataFrame([], staging.rejected(CREDIT_SCORES))
    even = _number() % 2 == 0
    first = staging.load(
        spark.createDataFrame([], staged(MORTGAGE_ACCOUNTS)), spark.createDataFrame([], CREDIT_SCORES),
        raw_accounts.filter(even), staging.with_rejects(raw_scores, nothing),
    )
    kept = staging.since(first.rejected_scores, FIRST_LOAD)
    second = staging.load(
        first.accounts, first.scores, raw_accounts.filter(~even),
        staging.with_rejects(raw_scores.limit(0), kept),
    )
    return first, second


def _retried_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_loads(spark, sf_dir)[1].new_scores


def _open_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = staging.since(_two_loads(spark, sf_dir)[1].rejected_scores, AS_OF)
    return rejects.select("score_id", KEY, "reasons", staging.REJECTED_ON)


def _top10_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = sample.mortgage_accounts(spark, sf_dir).filter(_number() % 3 != 0)
    return reports.high_risk_accounts(_metrics(spark, sf_dir, AS_CODED), owners, AS_OF)


def _rejected_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Unfiltered staging data: undefined ratios and missing utilization reach the rules.
    accounts = staging.deduplicate(sample.mortgage_accounts_raw(spark, sf_dir), KEY)
    return metrics.metric_rejects(accounts, _clean_scores(spark, sf_dir), AS_OF, CONTRACT)


def _primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_accounts = sample.mortgage_accounts_raw(spark, sf_dir)
    raw_scores = sample.credit_scores_raw(spark, sf_dir)
    results = _metrics(spark, sf_dir, AS_CODED)
    return quality.union_all([
        quality.primary_key_violations(raw_accounts, "mortgage_accounts", KEY),
        quality.primary_key_violations(raw_scores, "credit_scores", "score_id"),
        quality.primary_key_violations(results, "risk_metrics", "metric_id"),
    ])


def _foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = sample.mortgage_accounts(spark, sf_dir)
    raw_scores = sample.credit_scores_raw(spark, sf_dir)
    results = _metrics(spark, sf_dir, AS_CODED)
    return quality.union_all([
        quality.foreign_key_violations(raw_scores, "credit_scores", "score_id", accounts, KEY),
        quality.foreign_key_violations(results, "risk_metrics", "metric_id", accounts, KEY),
    ])


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.range_rules(
        "credit_score", "payment_history_score", "credit_utilization_pct"
    )
    raw_scores = sample.credit_scores_raw(spark, sf_dir)
    return quality.violations(raw_scores, "credit_scores", "score_id", rules)


def _metric_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.range_rules("risk_score_normalized", "default_probability")
    return quality.union_all([
        quality.violations(_metrics(spark, sf_dir, policy), policy.name, "metric_id", rules)
        for policy in (AS_CODED, CONTRACT)
    ])


def _not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As coded, an observation with a missing input is scored all the same.
    coded = metrics.build_risk_metrics(
        sample.mortgage_accounts(spark, sf_dir), _clean_scores(spark, sf_dir), AS_OF, AS_CODED
    )
    return quality.union_all([
        quality.not_null_violations(coded, "risk_metrics", required_columns(RISK_METRICS)),
        quality.not_null_violations(
            sample.mortgage_accounts_raw(spark, sf_dir),
            "mortgage_accounts",
            required_columns(MORTGAGE_ACCOUNTS),
        ),
        quality.not_null_violations(
            sample.credit_scores_raw(spark, sf_dir),
            "credit_scores",
            required_columns(CREDIT_SCORES),
        ),
    ])


def _domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_accounts = sample.mortgage_accounts_raw(spark, sf_dir)
    account_rules = quality.domain_rules(
        "property_province", "property_type", "employment_status"
    )
    raw_scores = sample.credit_scores_raw(spark, sf_dir)
    results = _metrics(spark, sf_dir, AS_CODED)
    return quality.union_all([
        quality.violations(raw_accounts, "mortgage_accounts", KEY, account_rules),
        quality.violations(
            raw_scores, "credit_scores", "score_id", quality.domain_rules("score_source")
        ),
        quality.violations(
            results, "risk_metrics", "metric_id", quality.domain_rules("risk_category")
        ),
    ])


def _tier_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = metrics.account_tiers(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores(spark, sf_dir),
        AS_OF,
        CONTRACT,
    )
    return reports.tier_policy_lookup(tiers, tier_policy(spark), AS_OF)


def _on_scores(operator: Callable[..., DataFrame], *args: object) -> Query:
    return lambda spark, sf_dir: operator(sample.credit_scores(spark, sf_dir), *args)


def _on_contract(report: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_metrics(spark, sf_dir, CONTRACT), calculation_date=AS_OF)


_QUERIES: dict[str, Query] = {
    "mortgage_accounts": sample.mortgage_accounts,
    "credit_scores": sample.credit_scores,
    "latest_scores": _latest_scores,
    "risk_metrics_as_coded": lambda s, d: _metrics(s, d, AS_CODED),
    "risk_metrics": lambda s, d: _metrics(s, d, CONTRACT),
    "risk_summary_as_coded": lambda s, d: _summary(s, d, AS_CODED),
    "risk_summary": lambda s, d: _summary(s, d, CONTRACT),
    "portfolio_risk_summary": _portfolio,
    "high_risk_accounts_top10": _top10,
    "credit_score_trends_top5": _top5_trends,
    "load_counts": _load_counts,
    "ltv_bands": lambda s, d: reports.ltv_bands(sample.mortgage_accounts(s, d)),
    "risk_flag_counts": _on_contract(reports.risk_flag_counts),
    "flag_actions": lambda s, d: reports.flag_actions(
        _metrics(s, d, CONTRACT), flag_policy(s), AS_OF
    ),
    "tier_policy_lookup": _tier_policies,
    "score_decline_90d": _on_scores(history.score_declines, CONTRACT),
    "new_derogatory_marks": _on_scores(history.new_derogatory_marks),
    "payment_issues": _on_scores(history.payment_issues, CONTRACT),
    "score_trend": _on_scores(history.score_trends),
    "score_progression": _on_scores(history.score_progression),
    "high_risk_alerts": _on_contract(reports.high_risk_alerts),
    "accounts_without_scores": _without_scores,
    "normalize_staging": _normalized,
    "normalize_staging_scores": _normalized_scores,
    "dedupe_scores": _clean_scores,
    "staging_quarantine": _quarantine,
    "metric_rejects": _rejected_metrics,
    "dq_primary_key_violations": _primary_keys,
    "dq_foreign_key_violations": _foreign_keys,
    "dq_check_violations": _ranges,
    "dq_metric_check_violations": _metric_ranges,
    "dq_not_null_violations": _not_null,
    "dq_domain_violations": _domains,
    "upsert_accounts": _upserted,
    "append_scores": _appended,
    "load_new_scores": _loaded_scores,
    "load_orphans": _orphans_of_load,
    "append_orphans": _orphans_of_append,
    "risk_metrics_carried": _carried_metrics,
    "orders_as_of_scores": _orders_as_of_scores,
    "orders_as_of_metrics": _orders_as_of_metrics,
    "retried_scores": _retried_scores,
    "open_rejects": _open_rejects,
    "high_risk_top10_with_orphans": _top10_with_orphans,
    "risk_summary_by_date": lambda s, d: _rolled_up(s, d, "risk_category"),
    "risk_summary_by_province": lambda s, d: _rolled_up(s, d, "property_province"),
    "risk_history": lambda s, d: _history(s, d, CONTRACT),
    "risk_point_in_time": lambda s, d: _history(s, d, AS_CODED),
}


def queries() -> dict[str, Query]:
    def rendered(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: rendered(query) for name, query in _QUERIES.items()}
