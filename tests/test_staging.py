from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import quality, staging
from loanrisk.sources import sample
from loanrisk.sources.schemas import (
    CREDIT_SCORES,
    MORTGAGE_ACCOUNTS,
    required_columns,
    staged,
)
from tests.conftest import rows_of


@pytest.mark.parametrize(
    "given, expected",
    [
        (" equifax", "Equifax"),
        ("TRANSUNION ", "TransUnion"),
        ("Equifax", "Equifax"),
        (" Experian ", "Experian"),
        (None, None),
    ],
)
def test_normalize_source(make_scores, given, expected):
    scores = make_scores({"score_source": given, "ingest_seq": 0}, schema=staged(CREDIT_SCORES))
    assert staging.normalize(scores).first()["score_source"] == expected


def test_normalize_account_columns(spark, sf_dir):
    raw = sample.mortgage_accounts_raw(spark, sf_dir)
    broken = raw.filter(F.col("property_province") != F.upper(F.trim("property_province")))
    assert broken.count() > 0
    normal = staging.normalize(raw)
    outside = quality.domain_rules("property_province", "employment_status")
    assert quality.violations(normal, "t", "account_id", outside).count() == 0


def test_deduplicate_takes_the_last_arrival(make_scores):
    schema = staged(CREDIT_SCORES)
    copies = [{"score_id": "S1", "credit_score": 600, "ingest_seq": 0}] * 50
    scores = make_scores(
        *copies,
        {"score_id": "S1", "credit_score": 650, "ingest_seq": 2},
        {"score_id": "S1", "credit_score": 640, "ingest_seq": 1},
        {"score_id": "S2", "credit_score": 700, "ingest_seq": 0},
        schema=schema,
    )
    unique = staging.deduplicate(scores.repartition(5), "score_id")
    assert rows_of(unique.select("score_id", "credit_score")) == [("S1", 650), ("S2", 700)]


def test_deduplicate_is_deterministic_on_equal_arrivals(make_scores):
    schema = staged(CREDIT_SCORES)
    conflict = [
        {"score_id": "S1", "credit_score": score, "ingest_seq": 0} for score in (610, 640, 620)
    ]
    results = {
        staging.deduplicate(make_scores(*order, schema=schema), "score_id").first()["credit_score"]
        for order in (conflict, conflict[::-1])
    }
    assert results == {640}


def test_split_is_complete(spark, sf_dir):
    raw = sample.credit_scores_raw(spark, sf_dir)
    clean = staging.deduplicate(staging.normalize(raw), "score_id")
    judged = staging.with_reasons(
        clean, staging.score_rules(), sample.mortgage_accounts(spark, sf_dir)
    )
    valid, rejects = staging.split(judged)
    assert valid.count() + rejects.count() == clean.count()
    assert rejects.count() > 0
    assert valid.columns == clean.columns


@pytest.mark.parametrize(
    "values, reasons",
    [
        ({"credit_score": 299}, ["RANGE:credit_score"]),
        ({"credit_score": 300}, []),
        ({"credit_score": 900}, []),
        ({"credit_score": 901}, ["RANGE:credit_score"]),
        ({"payment_history_score": None}, []),
        ({"payment_history_score": 101}, ["RANGE:payment_history_score"]),
        ({"credit_utilization_pct": None}, ["NOT_NULL:credit_utilization_pct"]),
        ({"credit_utilization_pct": Decimal("100.01")}, ["RANGE:credit_utilization_pct"]),
        ({"score_source": "Experian"}, ["DOMAIN:score_source"]),
        ({"account_id": "Z"}, ["FOREIGN_KEY:account_id"]),
        ({"account_id": None}, ["NOT_NULL:account_id", "FOREIGN_KEY:account_id"]),
    ],
)
def test_reasons(make_accounts, make_scores, values, reasons):
    scores = make_scores({**values, "ingest_seq": 0}, schema=staged(CREDIT_SCORES))
    judged = staging.with_reasons(
        scores, staging.score_rules(), make_accounts(("A", "1.00", "2.00"))
    )
    assert judged.first()["reasons"] == reasons


def test_account_rules(make_accounts):
    accounts = make_accounts(("A", "1.00", "0.00"), ("B", "1.00", "2.00"))
    judged = staging.with_reasons(accounts, staging.account_rules())
    assert rows_of(judged.select("account_id", F.array_join("reasons", ","))) == [
        ("A", "POSITIVE:property_value"), ("B", ""),
    ]


def test_upsert_replaces_and_inserts_and_is_idempotent(make_accounts):
    existing = make_accounts(("A", "1.00", "10.00"), ("B", "2.00", "10.00"))
    batch = make_accounts(("B", "3.00", "10.00"), ("C", "4.00", "10.00"))
    once = staging.upsert(existing, batch, "account_id")
    loans = [("A", Decimal("1.00")), ("B", Decimal("3.00")), ("C", Decimal("4.00"))]
    assert rows_of(once.select("account_id", "loan_amount")) == loans
    twice = staging.upsert(once, batch, "account_id")
    assert rows_of(twice) == rows_of(once)


def test_upsert_takes_the_last_arrival(make_accounts):
    def version(seq, *rows):
        return make_accounts(*rows).withColumn("ingest_seq", F.lit(seq))

    batch = version(1, ("A", "1.00", "10.00")).unionByName(version(2, ("A", "2.00", "10.00")))
    stored = staging.upsert(version(0, ("A", "9.00", "10.00"), ("B", "5.00", "10.00")), batch, "account_id")
    loans = stored.select("account_id", "loan_amount", "ingest_seq")
    assert rows_of(loans) == [("A", Decimal("2.00"), 2), ("B", Decimal("5.00"), 0)]
    # Replaying an older batch changes nothing, but its new accounts come in.
    older = version(1, ("A", "1.00", "10.00"), ("C", "7.00", "10.00"))
    again = staging.upsert(stored, older, "account_id").select("account_id", "loan_amount")
    assert rows_of(again) == [("A", Decimal("2.00")), ("B", Decimal("5.00")), ("C", Decimal("7.00"))]
    twice = make_accounts(("A", "1.00", "10.00"), ("A", "1.00", "10.00"))
    assert staging.upsert(make_accounts(("B", "1.00", "2.00")), twice, "account_id").count() == 2


def test_a_parent_that_occurs_twice_does_not_multiply_rows(make_accounts, make_scores):
    scores = make_scores({"ingest_seq": 0}, schema=staged(CREDIT_SCORES))
    parents = make_accounts(("A", "1.00", "2.00"), ("A", "3.00", "4.00"))
    judged = staging.with_reasons(scores, staging.score_rules(), parents)
    assert [r["reasons"] for r in judged.collect()] == [[]]


def test_load_checks_against_loaded_accounts(make_accounts, make_scores):
    raw_accounts = make_accounts(("A", "1.00", "2.00"), ("B", "1.00", "0.00")).withColumn("ingest_seq", F.lit(0))
    raw_scores = make_scores(
        {"account_id": "A", "ingest_seq": 0}, {"account_id": "B", "ingest_seq": 0},
        {"account_id": "C", "ingest_seq": 0}, schema=staged(CREDIT_SCORES),
    )
    loaded = staging.load(
        make_accounts(("C", "5.00", "6.00")), make_scores({"score_id": "OLD", "account_id": "C"}),
        raw_accounts, raw_scores,
    )
    assert rows_of(loaded.accounts.select("account_id")) == [("A",), ("C",)]
    assert rows_of(loaded.new_scores.select("account_id")) == [("A",), ("C",)]
    assert loaded.scores.count() == 3
    assert rows_of(loaded.rejected_scores.select("account_id", F.array_join("reasons", ","))) == [
        ("B", "FOREIGN_KEY:account_id"),
    ]
    assert rows_of(loaded.rejected_accounts.select("account_id")) == [("B",)]


def test_unseen_adds_only_new_keys(make_scores):
    existing = make_scores({"score_id": "S1"}, {"score_id": "S2"})
    batch = make_scores({"score_id": "S2"}, {"score_id": "S3"})
    new = staging.unseen(existing, batch, "score_id")
    assert [r["score_id"] for r in new.collect()] == ["S3"]
    assert staging.unseen(existing, batch.unionByName(batch), "score_id").count() == 1
    assert staging.unseen(existing.unionByName(new), batch, "score_id").count() == 0


def test_primary_key_violations(make_scores):
    scores = make_scores({"score_id": "S1"}, {"score_id": "S1"}, {"score_id": "S2"})
    found = quality.primary_key_violations(scores, "credit_scores", "score_id")
    assert rows_of(found) == [("credit_scores", "S1", 2)]


def test_foreign_key_violations(make_accounts, make_scores):
    scores = make_scores({"account_id": "A"}, {"account_id": "Z"}, {"account_id": "Z"})
    found = quality.foreign_key_violations(
        scores, "credit_scores", "score_id", make_accounts(("A", "1.00", "2.00")), "account_id"
    )
    assert rows_of(found) == [
        ("credit_scores", "S0001", "Z"), ("credit_scores", "S0002", "Z"),
    ]


def test_not_null_violations(make_scores):
    scores = make_scores(
        {"account_id": None, "ingest_seq": 0},
        {"account_id": None, "score_date": None, "ingest_seq": 0},
        schema=staged(CREDIT_SCORES),
    )
    found = quality.not_null_violations(scores, "credit_scores", required_columns(CREDIT_SCORES))
    assert rows_of(found) == [
        ("credit_scores", "account_id", 2), ("credit_scores", "score_date", 1),
    ]


def test_required_columns():
    assert len(required_columns(MORTGAGE_ACCOUNTS)) == 11
    assert "credit_utilization_pct" not in required_columns(CREDIT_SCORES)


def test_range_and_domain_violations_pass_null(make_scores):
    scores = make_scores(
        {"credit_score": 250, "payment_history_score": None, "ingest_seq": 0},
        {"score_source": None, "score_date": date(2023, 1, 1), "ingest_seq": 0},
        schema=staged(CREDIT_SCORES),
    )
    rules = [
        *quality.range_rules("credit_score", "payment_history_score"),
        *quality.domain_rules("score_source"),
    ]
    found = quality.violations(scores, "credit_scores", "score_id", rules)
    assert rows_of(found) == [("credit_scores", "S0000", "RANGE", "credit_score", "250")]
