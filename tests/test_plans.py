"""Physical plans: what keeps the queries fast on large and skewed tables."""

from __future__ import annotations

import json
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import history, metrics, reports, staging
from loanrisk.plans.registry import queries
from loanrisk.policy import AS_CODED, CONTRACT
from loanrisk.sources import sample


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as on tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return planned(df).split("+- == Initial Plan ==")[0]


def records_read(spark, action):
    """Records that the scans of an action's tasks gave out, from the session's event log."""
    before = _input_records(spark)
    action()
    return _input_records(spark) - before


def _input_records(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total = 0
    for log in Path(spark.conf.get("spark.eventLog.dir")).iterdir():
        for line in log.read_text().splitlines():
            if line.startswith('{"Event":"SparkListenerTaskEnd"'):
                metrics = json.loads(line).get("Task Metrics") or {}
                total += metrics.get("Input Metrics", {}).get("Records Read", 0)
    return total


def exchanges(plan):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_global_window(spark, sf_dir, name):
    plan = planned(queries()[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan
    for window in re.findall(r"Window(?:GroupLimit)? \[.*", plan):
        assert "account_id" in window or "score_id" in window


def test_latest_scores_prunes_ahead_of_the_exchange(spark, sf_dir):
    plan = planned(history.latest_scores(sample.credit_scores(spark, sf_dir)))
    assert plan.count("WindowGroupLimit") == 2
    assert len(exchanges(plan)) == 1


def test_deduplication_prunes_ahead_of_the_exchange(spark, sf_dir):
    plan = planned(staging.deduplicate(sample.credit_scores_raw(spark, sf_dir), "score_id"))
    assert plan.count("WindowGroupLimit") == 2
    assert len(exchanges(plan)) == 1


def test_coded_metrics_shuffle_each_table_once(spark, sf_dir, no_broadcast):
    built = metrics.build_risk_metrics(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores(spark, sf_dir),
        date(2024, 1, 1),
        AS_CODED,
    )
    assert exchanges(planned(built)) == ["hashpartitioning"] * 2


def test_contract_metrics_shuffle_each_table_once_without_hot_accounts(
    spark, sf_dir, no_broadcast
):
    built = metrics.build_risk_metrics(
        sample.mortgage_accounts(spark, sf_dir),
        sample.credit_scores(spark, sf_dir),
        date(2024, 1, 1),
        CONTRACT,
    )
    assert exchanges(executed(built)) == ["hashpartitioning"] * 2


def test_progression_is_one_window_without_hot_accounts(spark, sf_dir):
    plan = planned(history.score_progression(sample.credit_scores(spark, sf_dir)))
    assert exchanges(plan) == ["hashpartitioning"]
    assert "Union" not in plan


def test_contract_metrics_read_the_scores_twice(spark, sf_dir):
    """Once narrowly for the sizes of keys, once for the work: counted on the tasks' metrics."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    read = records_read(spark, lambda: queries()["risk_metrics"](spark, sf_dir).collect())
    assert read == customers + 2 * orders


def test_the_sizing_job_reads_two_columns(spark, tmp_path, make_scores):
    path = str(tmp_path / "scores")
    make_scores({}).write.parquet(path)
    drawn = spark.read.parquet(path).filter(F.pmod(F.xxhash64("score_id"), F.lit(64)) == 0)
    plan = planned(drawn.groupBy("account_id").agg(F.count(F.lit(1))))
    assert re.findall(r"FileScan parquet \[([^\]]*)\]", plan)[0].count(",") == 1


def test_top_list_leaves_the_accounts_in_place(spark, sf_dir, no_broadcast):
    plan = executed(queries()["high_risk_accounts_top10"](spark, sf_dir))
    owners = [part for part in plan.split("FileScan")[1:] if "c_mktsegment" in part or "c_nationkey" in part]
    assert plan.count("BroadcastHashJoin") == 1 and owners
    # Only what the metrics themselves need of the accounts is exchanged.
    assert len(re.findall("Exchange hashpartitioning", plan)) == 2


def test_tier_lookup_needs_no_history(spark, sf_dir, no_broadcast):
    plan = planned(queries()["tier_policy_lookup"](spark, sf_dir))
    assert exchanges(plan) == ["hashpartitioning"] * 2
    assert "window_high" not in plan and "previous_marks" not in plan


def test_top_lists_do_not_sort_everything(spark, sf_dir):
    for name in ("high_risk_accounts_top10", "credit_score_trends_top5"):
        assert "TakeOrderedAndProject" in planned(queries()[name](spark, sf_dir))


def test_trends_broadcast_the_top_keys_only(spark, sf_dir):
    plan = planned(queries()["credit_score_trends_top5"](spark, sf_dir))
    assert "BroadcastHashJoin [account_id" in plan and "LeftSemi" in plan


def test_small_batch_leaves_the_large_table_in_place(spark, sf_dir, make_scores, tmp_path):
    path = str(tmp_path / "batch")
    make_scores({"score_id": "SCR0000000001"}, {"score_id": "NEW"}).write.parquet(path)
    batch = spark.read.parquet(path)
    new = staging.unseen(sample.credit_scores(spark, sf_dir), batch, "score_id")
    plan = executed(new)
    semi = plan[plan.index("LeftSemi"):]
    large = semi[: semi.index("BroadcastQueryStage")]
    assert "FileScan" in large and "o_orderkey" in large
    assert "Exchange" not in large


def test_filters_and_columns_reach_the_scan(spark, tmp_path, make_scores, make_accounts):
    scores_path, accounts_path = str(tmp_path / "scores"), str(tmp_path / "accounts")
    make_scores({}).write.parquet(scores_path)
    make_accounts(("A", "50.00", "100.00")).write.parquet(accounts_path)
    built = metrics.build_risk_metrics(
        spark.read.parquet(accounts_path),
        spark.read.parquet(scores_path),
        date(2023, 6, 1),
        AS_CODED,
    )
    plan = planned(built)
    assert "LessThanOrEqual(score_date,2023-06-01)" in plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    columns = [sorted(re.sub(r"#\d+L?", "", scan).split(",")) for scan in scans]
    assert columns == [
        ["account_id", "loan_amount", "property_value"],
        ["account_id", "credit_score", "credit_utilization_pct", "derogatory_marks",
         "score_date", "score_id"],
    ]


def test_history_reports_read_one_partition(spark, tmp_path, make_accounts, make_scores):
    path = str(tmp_path / "history")
    accounts, scores = make_accounts(("A", "50.00", "100.00")), make_scores({})
    metrics.build_risk_metrics(accounts, scores, date(2024, 1, 1), CONTRACT).write.partitionBy(
        "calculation_date"
    ).parquet(path)
    alerts = reports.high_risk_alerts(spark.read.parquet(path), date(2024, 1, 1))
    plan = planned(alerts)
    assert re.search(r"PartitionFilters: \[[^\]]*calculation_date[^\]]*2024-01-01", plan)
    assert "PushedFilters: [In(risk_category" in plan
