from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import metrics, reports
from loanrisk.operators.history import Calendar
from loanrisk.policy import AS_CODED, CONTRACT
from loanrisk.sources import sample
from loanrisk.sources.schemas import CREDIT_SCORES, RISK_METRICS, conform, staged
from tests.conftest import rows_of

AS_OF = date(2024, 1, 1)


@pytest.mark.parametrize(
    "score, tier, probability, action",
    [
        (300, "Very High Risk", "0.2000", "Immediate review required - Consider workout options"),
        (599, "Very High Risk", "0.2000", "Immediate review required - Consider workout options"),
        (600, "High Risk", "0.1100", "Enhanced monitoring - Weekly check-ins"),
        (649, "High Risk", "0.1100", "Enhanced monitoring - Weekly check-ins"),
        (650, "Medium Risk", "0.0500", "Standard monitoring with monthly reviews"),
        (699, "Medium Risk", "0.0500", "Standard monitoring with monthly reviews"),
        (700, "Low Risk", "0.0200", "Continue routine monitoring"),
        (749, "Low Risk", "0.0200", "Continue routine monitoring"),
        (750, "Very Low Risk", "0.0050", "Continue routine monitoring"),
        (900, "Very Low Risk", "0.0050", "Continue routine monitoring"),
    ],
)
def test_tier_cuts(make_accounts, make_scores, score, tier, probability, action):
    accounts = make_accounts(("A", "50.00", "100.00"))
    scores = make_scores({"credit_score": score})
    for policy in (AS_CODED, CONTRACT):
        row = metrics.build_risk_metrics(accounts, scores, AS_OF, policy).first()
        assert row["risk_category"] == tier
        assert row["default_probability"] == Decimal(probability)
        assert row["recommended_action"] == action
        assert ("LOW_CREDIT" in row["risk_flags"]) == (score < 650)


def test_score_formula(make_accounts, make_scores):
    accounts = make_accounts(("A", "80.00", "100.00"))
    scores = make_scores({
        "credit_score": 720, "derogatory_marks": 2, "credit_utilization_pct": Decimal("50.00")
    })
    # (1 - 720/900) * 40 + 0.8 * 35 + 0.2 * 15 + 0.5 * 10 = 8 + 28 + 3 + 5
    coded = metrics.build_risk_metrics(accounts, scores, AS_OF, AS_CODED).first()
    contract = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).first()
    assert coded["risk_score_normalized"] == Decimal("4400.00")
    assert contract["risk_score_normalized"] == Decimal("44.00")
    assert coded["metric_id"] == "RISK20240101A"


def test_contract_score_is_clamped(make_accounts, make_scores):
    accounts = make_accounts(("A", "95.00", "100.00"))
    scores = make_scores({"credit_score": 300, "derogatory_marks": 60})
    row = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).first()
    assert row["risk_score_normalized"] == Decimal("100.00")


def test_contract_score_rounds_halves_up(make_accounts, make_scores):
    accounts = make_accounts(("A", "92.36", "100.00"))
    scores = make_scores({
        "credit_score": 801, "derogatory_marks": 2, "credit_utilization_pct": Decimal("65.29")
    })
    # 4.4 + 32.326 + 3 + 6.529 = 46.255
    row = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).first()
    assert row["risk_score_normalized"] == Decimal("46.26")


@pytest.mark.parametrize(
    "loan, flagged, stored",
    [("79.99", False, "79.99"), ("80.00", False, "80.00"), ("80.01", True, "80.01")],
)
def test_ltv_limit(make_accounts, make_scores, loan, flagged, stored):
    accounts = make_accounts(("A", loan, "100.00"))
    row = metrics.build_risk_metrics(accounts, make_scores({}), AS_OF, CONTRACT).first()
    assert ("HIGH_LTV" in row["risk_flags"]) == flagged
    assert row["current_ltv"] == Decimal(stored)


def test_flags_use_the_unrounded_ltv(make_accounts, make_scores):
    accounts = make_accounts(("A", "800.04", "1000.00"))
    row = metrics.build_risk_metrics(accounts, make_scores({}), AS_OF, CONTRACT).first()
    assert row["current_ltv"] == Decimal("80.00")
    assert row["risk_flags"] == ["HIGH_LTV"]


def test_coded_flags_keep_their_slots(make_accounts, make_scores):
    accounts = make_accounts(("A", "50.00", "100.00"))
    scores = make_scores({"credit_score": 800})
    coded = metrics.build_risk_metrics(accounts, scores, AS_OF, AS_CODED).first()
    contract = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).first()
    assert coded["risk_flags"] == [None, None, None, None]
    assert contract["risk_flags"] == []


@pytest.mark.parametrize(
    "values, flag, raised",
    [
        ({"credit_utilization_pct": Decimal("75.00")}, "HIGH_UTILIZATION", False),
        ({"credit_utilization_pct": Decimal("75.01")}, "HIGH_UTILIZATION", True),
        ({"payment_history_score": 59}, "PAYMENT_ISSUES", True),
        ({"payment_history_score": 60}, "PAYMENT_ISSUES", False),
        ({"payment_history_score": None}, "PAYMENT_ISSUES", False),
        ({"derogatory_marks": 0}, "DEROGATORY_MARKS", False),
        ({"derogatory_marks": 1}, "DEROGATORY_MARKS", True),
    ],
)
def test_flag_thresholds(make_accounts, make_scores, values, flag, raised):
    accounts = make_accounts(("A", "50.00", "100.00"))
    row = metrics.build_risk_metrics(accounts, make_scores(values), AS_OF, CONTRACT).first()
    assert (flag in row["risk_flags"]) == raised


def test_marks_flag_differs_by_policy(make_accounts, make_scores):
    accounts = make_accounts(("A", "50.00", "100.00"))
    scores = make_scores(
        {"score_date": date(2023, 6, 1), "derogatory_marks": 2},
        {"score_date": date(2023, 7, 1), "derogatory_marks": 2},
    )
    coded = metrics.build_risk_metrics(accounts, scores, AS_OF, AS_CODED).first()
    contract = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).first()
    assert "DEROGATORY_MARKS" in coded["risk_flags"]
    assert "DEROGATORY_MARKS" not in contract["risk_flags"]


def test_unusable_rows(make_accounts, make_scores):
    accounts = make_accounts(
        ("A", "50.00", "100.00"), ("B", "50.00", "0.00"), ("C", "50.00", "100.00"),
        ("D", "9000000.00", "0.01"),
    )
    scores = make_scores(
        {"account_id": "A"}, {"account_id": "B"},
        {"account_id": "C", "credit_utilization_pct": None}, {"account_id": "D"},
    )
    built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    assert [r["account_id"] for r in built.collect()] == ["A"]
    rejects = metrics.metric_rejects(accounts, scores, AS_OF, CONTRACT)
    assert rows_of(rejects.select("account_id", F.array_join("reasons", ","))) == [
        ("B", "LTV_UNDEFINED"), ("C", "UTILIZATION_MISSING"), ("D", "LTV_OUT_OF_RANGE"),
    ]
    # As coded, a missing utilization leaves the score unknown.
    coded = metrics.build_risk_metrics(
        accounts.filter("account_id = 'C'"), scores, AS_OF, AS_CODED
    ).first()
    assert coded["risk_score_normalized"] is None


@pytest.mark.parametrize("account, values, reason", [
    (("A", None, "100.00"), {}, "LTV_UNDEFINED"),
    (("A", "50.00", None), {}, "LTV_UNDEFINED"),
    (("A", "50.00", "0.00"), {}, "LTV_UNDEFINED"),
    (("A", "50.00", "-100.00"), {}, "LTV_UNDEFINED"),
    (("A", "-50.00", "-100.00"), {}, "LTV_UNDEFINED"),
    (("A", "-50.00", "100.00"), {}, "LTV_OUT_OF_RANGE"),
    (("A", "9000000.00", "0.01"), {}, "LTV_OUT_OF_RANGE"),
    (("A", "50.00", "100.00"), {"credit_score": None}, "SCORE_MISSING"),
    (("A", "50.00", "100.00"), {"derogatory_marks": None}, "MARKS_MISSING"),
    (("A", "50.00", "100.00"), {"credit_utilization_pct": None}, "UTILIZATION_MISSING"),
    (("A", "50.00", "100.00"), {"payment_history_score": None}, None),
    (("A", "50.00", "100.00"), {"credit_score": -5}, None),
    (("A", "50.00", "100.00"), {"derogatory_marks": -5}, None),
    (("A", None, None), {"credit_score": None, "derogatory_marks": None, "credit_utilization_pct": None},
     "LTV_UNDEFINED,SCORE_MISSING,MARKS_MISSING,UTILIZATION_MISSING"),
])
def test_every_scored_account_is_stored_or_rejected(spark, make_accounts, make_scores, account, values, reason):
    key, loan, value = account
    accounts = make_accounts((key, loan or "1.00", value or "1.00"), ("B", "50.00", "100.00"))
    broken = F.col("account_id") == key
    for name, given in (("loan_amount", loan), ("property_value", value)):
        if given is None:
            known = F.when(F.col("account_id") != key, F.col(name))
            accounts = accounts.withColumn(name, known)
    scores = make_scores(
        {"account_id": "A", "ingest_seq": 0, **values}, {"account_id": "B", "ingest_seq": 0},
        schema=staged(CREDIT_SCORES),
    )
    stored = [r["account_id"] for r in metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT).collect()]
    rejected = {
        r["account_id"]: ",".join(r["reasons"])
        for r in metrics.metric_rejects(accounts, scores, AS_OF, CONTRACT).collect()
    }
    assert sorted([*stored, *rejected]) == ["A", "B"]
    assert rejected == ({"A": reason} if reason else {})
    tiers = metrics.account_tiers(accounts, scores, AS_OF, CONTRACT)
    assert sorted(r["account_id"] for r in tiers.collect()) == sorted(stored)


def test_tiers_are_those_of_the_metrics(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    columns = ["account_id", "calculation_date", "risk_category", "default_probability"]
    assert rows_of(built.select(columns)) == rows_of(
        metrics.account_tiers(accounts, scores, AS_OF, CONTRACT).select(columns)
    )


def test_an_orphan_takes_no_place_in_the_top_list(make_accounts, make_scores):
    accounts = make_accounts(("A", "50.00", "100.00"), ("B", "50.00", "100.00"), ("C", "50.00", "100.00"))
    scores = make_scores(*(
        {"account_id": name, "credit_score": score} for name, score in (("A", 500), ("B", 510), ("C", 520))
    ))
    built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    top = reports.high_risk_accounts(built, accounts, AS_OF, top=2)
    assert [r["account_id"] for r in top.collect()] == ["A", "B"]
    owned = reports.high_risk_accounts(built, accounts.filter("account_id <> 'A'"), AS_OF, top=2)
    assert [r["account_id"] for r in owned.collect()] == ["B", "C"]


def test_metrics_of_the_same_accounts_need_no_second_look_at_keys(make_accounts, make_scores):
    accounts = make_accounts(("A", "50.00", "100.00"), ("B", "50.00", "100.00"), ("B", "60.00", "100.00"))
    scores = make_scores(*({"account_id": name, "credit_score": 500} for name in ("A", "B", "Z")))
    built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    top, owned = (reports.high_risk_accounts(built, accounts, AS_OF, 3, owned) for owned in (False, True))
    assert rows_of(top) == rows_of(owned) and {r["account_id"] for r in owned.collect()} == {"A", "B"}


def test_accounts_without_scores(make_accounts, make_scores):
    accounts = make_accounts(("A", "50.00", "100.00"), ("B", "50.00", "100.00"))
    scores = make_scores({"account_id": "A", "score_date": date(2023, 5, 1)})
    missing = metrics.accounts_without_scores(accounts, scores)
    assert [r["account_id"] for r in missing.collect()] == ["B"]
    earlier = metrics.accounts_without_scores(accounts, scores, date(2023, 4, 30))
    assert sorted(r["account_id"] for r in earlier.collect()) == ["A", "B"]


def test_one_metric_per_account_and_date(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    calendar = Calendar(date(2023, 1, 2), 27)
    for policy in (AS_CODED, CONTRACT):
        rows = metrics.risk_metrics_history(accounts, scores, calendar, policy)
        pairs = rows.select("account_id", "calculation_date")
        assert pairs.distinct().count() == rows.count()
        assert rows.select("metric_id").distinct().count() == rows.count()


@pytest.mark.parametrize("policy", [AS_CODED, CONTRACT], ids=lambda p: p.name)
def test_history_equals_single_runs(spark, sf_dir, policy):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    calendar = Calendar(date(2023, 10, 1), 4)
    history = metrics.risk_metrics_history(accounts, scores, calendar, policy)
    runs = [
        metrics.build_risk_metrics(accounts, scores, day, policy)
        for day in (date(2023, 10, 1), date(2023, 10, 15), date(2023, 10, 29), date(2023, 11, 12))
    ]
    single = runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3])
    assert sorted(map(repr, history.collect())) == sorted(map(repr, single.collect()))


def test_contract_keeps_the_coded_order(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    coded = metrics.build_risk_metrics(accounts, scores, AS_OF, AS_CODED)
    contract = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    both = coded.select("account_id", F.col("risk_score_normalized").alias("coded")).join(
        contract.select("account_id", F.col("risk_score_normalized").alias("contract")),
        "account_id",
    )
    ranked = [r["contract"] for r in both.orderBy("coded").collect()]
    assert ranked == sorted(ranked)
    assert all(0 <= value <= 100 for value in ranked)


def test_summary_adds_up(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    summary = reports.risk_summary(built, accounts, AS_OF)
    totals = summary.agg(F.sum("account_count"), F.sum("total_loan_amount")).first()
    assert totals[0] == built.count()
    expected = built.join(accounts, "account_id").agg(F.sum("loan_amount")).first()[0]
    assert totals[1] == expected
    assert dict(summary.dtypes)["total_loan_amount"] == "decimal(20,2)"
    assert dict(summary.dtypes)["avg_ltv"] == "decimal(10,2)"
    assert dict(summary.dtypes)["account_count"] == "bigint"


def test_metrics_follow_the_table_contract(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    coded = metrics.build_risk_metrics(accounts, scores, AS_OF, AS_CODED)
    stored = conform(coded, RISK_METRICS)
    assert [d for d in coded.dtypes] == [d for d in stored.dtypes]
    contract = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
    assert dict(contract.dtypes)["risk_score_normalized"] == "decimal(5,2)"
    assert contract.schema["risk_flags"].dataType.containsNull is False


@pytest.mark.parametrize("partitions", ["1", "32"])
def test_result_does_not_depend_on_partitioning(spark, sf_dir, partitions):
    def run(repartition):
        accounts = sample.mortgage_accounts(spark, sf_dir)
        scores = sample.credit_scores(spark, sf_dir)
        if repartition:
            accounts = accounts.orderBy(F.desc("account_id"))
            scores = scores.repartition(7, F.col("score_source"), F.col("credit_score"))
        built = metrics.build_risk_metrics(accounts, scores, AS_OF, CONTRACT)
        return sorted(map(repr, built.collect()))

    expected = run(False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert run(True) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_reports_take_one_calculation_date(spark, sf_dir):
    accounts, scores = sample.mortgage_accounts(spark, sf_dir), sample.credit_scores(spark, sf_dir)
    calendar = Calendar(date(2023, 12, 4), 3)
    history = metrics.risk_metrics_history(accounts, scores, calendar, CONTRACT)
    latest = metrics.build_risk_metrics(accounts, scores, date(2024, 1, 1), CONTRACT)
    assert rows_of(reports.risk_summary(history, accounts)) == rows_of(
        reports.risk_summary(latest, accounts, date(2024, 1, 1))
    )
    assert reports.high_risk_alerts(history).count() == reports.high_risk_alerts(latest).count()


def test_ltv_bands(make_accounts):
    accounts = make_accounts(
        ("A", "64.99", "100.00"), ("B", "65.00", "100.00"), ("C", "80.00", "100.00"),
        ("D", "80.01", "100.00"), ("E", "95.00", "100.00"), ("F", "95.01", "100.00"),
    )
    bands = {r["ltv_band"]: r["account_count"] for r in reports.ltv_bands(accounts).collect()}
    assert bands == {"excellent": 1, "standard": 2, "elevated": 2, "high": 1}
