"""Summaries from sums and counts, and loads told apart by the keys they lie between."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import metrics, reports
from loanrisk.operators.rollup import rolled_up, summary_parts
from loanrisk.policy import AS_CODED, CONTRACT
from loanrisk.sinks import catalog
from loanrisk.sources import sample
from loanrisk.sources.schemas import RISK_METRICS
from tests.conftest import rows_of
from tests.test_cycle import DAY, database, ids, stamped  # noqa: F401
from tests.test_plans import records_read

DAYS = [date(2022, 6, 1), date(2023, 6, 1), date(2024, 1, 1)]


@pytest.mark.parametrize("policy", [AS_CODED, CONTRACT], ids=lambda policy: policy.name)
def test_parts_add_up_to_the_summary_of_every_date(spark, sf_dir, policy):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    even = F.substring("account_id", 4, 20).cast("bigint") % 2 == 0
    for day in DAYS:
        built = metrics.build_risk_metrics(accounts, scores, day, policy)
        expected = reports.risk_summary(built, accounts)
        # Parts of disjoint accounts add up as well.
        halves = [summary_parts(built.filter(half), accounts) for half in (even, ~even)]
        for parts in (summary_parts(built, accounts), halves[0].unionByName(halves[1])):
            summary = rolled_up(parts, "risk_category")
            assert summary.columns == expected.columns and summary.dtypes == expected.dtypes
            assert rows_of(summary) == rows_of(expected)


def test_unknown_values_and_orphans(spark, make_accounts):
    accounts = make_accounts(("A", "80.00", "100.00"), ("B", "80.00", "100.00"))
    rows = spark.createDataFrame(
        [(f"M{a}{k}", a, DAY, None if k else 80, None, None if k else 70, "Low Risk", None, "x", flags)
         for a in "ABX" for k, flags in enumerate(([], ["F"]))],
        "metric_id string, account_id string, calculation_date date, current_ltv int, latest_credit_score int, "
        "risk_score_normalized int, risk_category string, default_probability double, "
        "recommended_action string, risk_flags array<string>",
    )
    (row,) = rolled_up(summary_parts(rows, accounts)).collect()
    assert (row["account_count"], row["total_loan_amount"], row["high_risk_flags"]) == (4, 320, 2)
    assert (row["avg_credit_score"], row["avg_ltv"], row["avg_risk_score"]) == (None, 80, 70)
    assert rolled_up(summary_parts(rows.limit(0), accounts), "risk_category").isEmpty()


def test_readers_of_the_view_open_the_parts_only(spark, database, sf_dir):  # noqa: F811
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    catalog.create_tables(spark, database)
    accounts.write.insertInto(f"{database}.mortgage_accounts")
    for day in DAYS:
        built = metrics.build_risk_metrics(accounts, scores, day, CONTRACT)
        catalog.write_history(built, f"{database}.risk_metrics", RISK_METRICS, [day])
    catalog.create_summary_view(spark, database)
    view = f"{database}.vw_risk_summary"
    joined, columns = rows_of(spark.table(view)), spark.table(view).dtypes
    for _ in range(2):
        catalog.write_summary(spark, database, DAYS)
        catalog.create_summary_view(spark, database)
        assert rows_of(spark.table(view)) == joined and spark.table(view).dtypes == columns
    at = F.col("calculation_date") == F.lit(DAYS[-1])
    parts = spark.table(f"{database}.risk_summary_parts").filter(at).count()
    assert records_read(spark, lambda: spark.table(view).collect()) == parts < 70
    # A date that has metrics but no parts yet is read from the metrics.
    later = date(2024, 2, 1)
    built = metrics.build_risk_metrics(accounts, scores, later, CONTRACT)
    catalog.write_history(built, f"{database}.risk_metrics", RISK_METRICS, [later])
    catalog.create_summary_view(spark, database)
    assert rows_of(spark.table(view)) == rows_of(reports.risk_summary(built, accounts))


def test_an_append_opens_only_loads_that_may_hold_its_keys(spark, database, make_accounts, make_scores):  # noqa: F811
    def batch(*numbers, arrival=0):
        return stamped(make_scores(*({"score_id": f"S{n:06d}", "score_date": DAY} for n in numbers)), arrival)

    accounts = stamped(make_accounts(("A", "80.00", "100.00")))
    none = accounts.limit(0)
    for load, numbers in enumerate((range(1000), range(2000, 2040), range(4000, 4040))):
        day = DAY + timedelta(days=load)
        catalog.run_cycle(spark, database, none if load else accounts, batch(*numbers), day)
    loads = f"{database}.credit_scores__loads"
    assert catalog.loads_with(batch(500, 4001), loads) == [1, 3]
    assert catalog.loads_with(batch(1500, 5000), loads) == catalog.loads_with(batch().limit(0), loads) == []

    # Known keys are not stored again, new ones are, also between two keys of a load; 1,000 rows stay unread.
    again = batch(2001, 2039, 4100)
    stored = len(ids(spark, f"{database}.credit_scores", "score_id"))
    read = records_read(spark, lambda: catalog._store_scores(spark, database, again, DAY))
    assert read < 500
    after = ids(spark, f"{database}.credit_scores", "score_id")
    assert len(after) == len(set(after)) == stored + 1 and "S004100" in after
    # Loads without a note are always opened.
    spark.sql(f"ALTER TABLE {loads} UNSET TBLPROPERTIES ('{catalog._LEAST}1')")
    assert catalog.loads_with(batch(2001), loads) == [1, 2]
