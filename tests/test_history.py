from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanrisk.operators import history
from loanrisk.operators.history import Calendar
from loanrisk.operators.hotkeys import HotKeyLimits, split_by_size, with_chunk
from loanrisk.policy import CONTRACT
from tests.conftest import rows_of

# Every key with more than four rows counts as hot, so the hot plans are exercised.
ALL_HOT = HotKeyLimits(rows=4, draw_one_in=1)
NONE_HOT = HotKeyLimits()
SOME_HOT = HotKeyLimits(rows=100, draw_one_in=1)
# More hot keys than may be broadcast.
MANY_HOT = HotKeyLimits(rows=4, draw_one_in=1, broadcast_keys=2, salts=3)
EVERY_LIMIT = [NONE_HOT, ALL_HOT, SOME_HOT, MANY_HOT]


def test_same_day_tie_goes_to_the_higher_id(make_scores):
    scores = make_scores(
        {"score_id": "S2", "credit_score": 610},
        {"score_id": "S1", "credit_score": 790},
        {"score_id": "S9", "credit_score": 500, "score_date": date(2023, 12, 31)},
    )
    assert history.latest_scores(scores).first()["latest_credit_score"] == 610


def test_as_of_hides_later_observations(make_scores):
    scores = make_scores(
        {"score_date": date(2023, 5, 1), "credit_score": 600},
        {"score_date": date(2023, 5, 2), "credit_score": 700},
    )
    row = history.latest_scores(scores, date(2023, 5, 1)).first()
    assert row["latest_credit_score"] == 600
    assert history.latest_scores(scores, date(2023, 4, 30)).count() == 0


@pytest.mark.parametrize("limits", [NONE_HOT, ALL_HOT])
@pytest.mark.parametrize(
    "drop, days, declined", [(50, 90, False), (51, 90, True), (51, 91, False), (51, 0, True)]
)
def test_decline_window(make_scores, drop, days, declined, limits):
    newest = date(2024, 1, 1)
    padding = [
        {"score_id": f"P{n}", "score_date": newest - timedelta(days=500 + n), "credit_score": 300}
        for n in range(5)
    ]
    scores = make_scores(
        {"score_id": "S1", "score_date": newest - timedelta(days=days), "credit_score": 700},
        {"score_id": "S2", "score_date": newest, "credit_score": 700 - drop},
        *padding,
    )
    found = history.score_declines(scores, CONTRACT, limits=limits)
    assert (found.count() == 1) == declined
    profile = history.latest_profiles(scores, CONTRACT, limits=limits).first()
    above = profile["window_high"] - profile["latest_credit_score"] > CONTRACT.decline_points
    assert above == declined


def test_new_marks(make_scores):
    scores = make_scores(
        {"account_id": "A", "score_date": date(2023, 1, 1), "derogatory_marks": 1},
        {"account_id": "A", "score_date": date(2023, 2, 1), "derogatory_marks": 3},
        {"account_id": "B", "derogatory_marks": 2},
        {"account_id": "C", "score_date": date(2023, 1, 1), "derogatory_marks": 4},
        {"account_id": "C", "score_date": date(2023, 2, 1), "derogatory_marks": 4},
    )
    found = history.new_derogatory_marks(scores).select("account_id", "new_marks")
    assert rows_of(found) == [("A", 2), ("B", 2)]


def test_trend(make_scores):
    scores = make_scores(
        {"account_id": "A", "score_date": date(2023, 1, 1), "credit_score": 600},
        {"account_id": "A", "score_date": date(2023, 2, 1), "credit_score": 601},
        {"account_id": "B", "score_date": date(2023, 1, 1), "credit_score": 600},
        {"account_id": "B", "score_date": date(2023, 2, 1), "credit_score": 599},
        {"account_id": "C"},
    )
    trends = history.score_trends(scores).select("account_id", "trend")
    assert rows_of(trends) == [("A", "improving"), ("B", "deteriorating"), ("C", "stable")]


def _skewed(count, seed):
    """One account with a third of all rows, half of those on a single day."""
    chance = random.Random(seed)
    rows = []
    for number in range(count):
        hot = number % 3 == 0
        day = 40 if hot and number % 2 == 0 else chance.randrange(120)
        rows.append({
            "score_id": f"S{chance.randrange(10**6):06d}{number:04d}",
            "account_id": "HOT" if hot else f"A{chance.randrange(60)}",
            "score_date": date(2023, 1, 1) + timedelta(days=day),
            "credit_score": chance.randrange(300, 901),
            "derogatory_marks": chance.randrange(6),
            "credit_utilization_pct": Decimal(chance.randrange(0, 10001)) / 100,
        })
    return rows


def _by_account(rows):
    accounts = {}
    for row in sorted(rows, key=lambda r: (r["score_date"], r["score_id"])):
        accounts.setdefault(row["account_id"], []).append(row)
    return accounts


@pytest.mark.parametrize("limits", EVERY_LIMIT)
@pytest.mark.parametrize("seed", [1, 2])
def test_progression_equals_brute_force(make_scores, limits, seed):
    rows = _skewed(900, seed)
    expected = []
    for account, ordered in _by_account(rows).items():
        for before, row in zip([None, *ordered], ordered):
            expected.append((
                account,
                row["score_id"],
                row["score_date"],
                row["credit_score"],
                before and before["credit_score"],
                row["credit_score"] - before["credit_score"] if before else None,
                (row["score_date"] - before["score_date"]).days if before else None,
            ))
    actual = history.score_progression(make_scores(*rows), limits=limits).collect()
    assert sorted(map(repr, map(tuple, actual))) == sorted(map(repr, expected))


@pytest.mark.parametrize("limits", EVERY_LIMIT)
def test_daily_profiles_equal_brute_force(make_scores, limits):
    rows = _skewed(900, 3)
    expected = []
    for account, ordered in _by_account(rows).items():
        for position, row in enumerate(ordered):
            following = ordered[position + 1] if position + 1 < len(ordered) else None
            if following and following["score_date"] == row["score_date"]:
                continue
            start = row["score_date"] - timedelta(days=CONTRACT.decline_days)
            high = max(
                r["credit_score"] for r in ordered if start <= r["score_date"] <= row["score_date"]
            )
            before = ordered[position - 1]["derogatory_marks"] if position else None
            days = (following["score_date"] - date(1970, 1, 1)).days if following else None
            expected.append((account, row["score_id"], before, high, days))
    profiles = history.daily_profiles(make_scores(*rows), CONTRACT, limits)
    actual = profiles.select(
        "account_id", "score_id", "previous_marks", "window_high", "next_day"
    ).collect()
    assert sorted(map(repr, map(tuple, actual))) == sorted(map(repr, expected))


def test_hot_keys_are_those_over_the_limit(make_scores):
    rows = make_scores(*_skewed(900, 5))
    split = split_by_size(rows, "account_id", "score_id", SOME_HOT)
    assert {r["account_id"] for r in split.hot.collect()} == {"HOT"}
    assert split.hot.count() == 300 and split.ordinary.count() == 600
    assert split_by_size(rows, "account_id", "score_id", NONE_HOT).hot is None
    many = split_by_size(rows, "account_id", "score_id", MANY_HOT)
    assert many.hot.count() + many.ordinary.count() == 900
    assert many.hot.columns == many.ordinary.columns == rows.columns


@pytest.mark.parametrize("cuts", [0, 1, 2, 3, 10, 64, 101])
def test_chunks_count_the_cuts(spark, cuts):
    values = [f"S{3 * k:04d}" for k in range(cuts)]
    rows = spark.range(3 * cuts + 4).select(
        F.lit("A").alias("key"), F.format_string("S%04d", F.col("id") - 1).alias("value")
    )
    listed = spark.createDataFrame([("A", values)] if values else [], "key string, cuts array<string>")
    found = with_chunk(rows, listed, ["key"], "value")
    assert found.columns == ["key", "value", "chunk"] and found.count() == rows.count()
    for row in found.collect():
        assert row["chunk"] == sum(cut <= row["value"] for cut in values)


def test_in_force_equals_brute_force(make_scores):
    rows = _skewed(300, 4)
    calendar = Calendar(date(2022, 12, 20), 11)
    dates = [calendar.start + timedelta(days=14 * n) for n in range(calendar.count)]
    assert calendar.last == dates[-1]
    expected = []
    for account, ordered in _by_account(rows).items():
        for day in dates:
            known = [r for r in ordered if r["score_date"] <= day]
            if known:
                expected.append((account, day, known[-1]["score_id"]))
    scores = make_scores(*rows)
    for intervals in (
        history.in_force(scores, calendar),
        history.profiles_in_force(scores, calendar, CONTRACT),
        history.profiles_in_force(scores, calendar, CONTRACT, ALL_HOT),
    ):
        dated = history.at_each_date(intervals, calendar)
        actual = dated.select("account_id", "calculation_date", "score_id")
        assert rows_of(actual) == sorted(expected)
