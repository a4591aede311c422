"""State carried from date to date against metrics built from all observations."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanrisk.operators import carried, metrics
from loanrisk.policy import AS_CODED, CONTRACT
from loanrisk.sources.schemas import CREDIT_SCORES
from tests.conftest import rows_of

START = date(2023, 1, 2)


def fixed(df):
    """df's rows, as a date's run would have stored them."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def observations(make_scores, seed, count=400, accounts=6):
    """Observations of few accounts over few days, so that days, ties and windows collide; in no order."""
    random = np.random.default_rng(seed)
    return make_scores(*(
        {
            "score_id": f"S{k:04d}",
            "account_id": f"A{random.integers(accounts)}",
            "score_date": START + timedelta(days=int(random.integers(0, 300))),
            "credit_score": int(random.integers(560, 800)),
            "derogatory_marks": int(random.integers(0, 4)),
            "payment_history_score": int(random.integers(50, 70)),
            "credit_utilization_pct": Decimal(int(random.integers(0, 100))),
        }
        for k in range(count)
    ))


@pytest.mark.parametrize("policy", [AS_CODED, CONTRACT], ids=lambda policy: policy.name)
def test_dates_in_turn_equal_dates_from_scratch(spark, make_accounts, make_scores, policy):
    accounts = make_accounts(*((f"A{k}", "80.00", "100.00") for k in range(7)))
    scores = observations(make_scores, seed=3)
    # What arrives with a load has nothing to do with its date: late and early rows in each.
    loads = [fixed(scores.filter(F.pmod(F.xxhash64("score_id"), F.lit(4)) == k)) for k in range(4)]
    state, waiting, known = None, None, None
    for step, load in enumerate(loads):
        as_of = START + timedelta(days=80 * (step + 1))
        arrived = load if waiting is None else load.unionByName(waiting)
        state = fixed(carried.advance(state, arrived, as_of, policy))
        waiting = fixed(carried.pending(arrived, as_of))
        known = load if known is None else known.unionByName(load)
        expected = rows_of(metrics.build_risk_metrics(accounts, known, as_of, policy))
        assert rows_of(carried.metrics_from_state(accounts, state, as_of, policy)) == expected
        assert len(expected) == 6
    assert state.agg(F.max(F.size("highs"))).first()[0] > 1


def test_an_observation_counts_once(spark, make_accounts, make_scores):
    """Handed in again it is not the observation before itself, from which marks are counted."""
    accounts = make_accounts(("A", "80.00", "100.00"))
    scores = make_scores(
        {"score_id": "S1", "score_date": START, "derogatory_marks": 1},
        {"score_id": "S2", "score_date": START, "derogatory_marks": 2},
    )
    state = carried.advance(None, scores, START, CONTRACT)
    again = carried.advance(state, scores.filter("score_id = 'S2'"), START, CONTRACT)
    for found in (state, again):
        row = carried.metrics_from_state(accounts, found, START, CONTRACT).first()
        assert "DEROGATORY_MARKS" in row["risk_flags"]
    assert rows_of(again.select("newest", "highs")) == rows_of(state.select("newest", "highs"))


def test_only_days_that_can_matter_are_kept(spark, make_scores):
    """Of falling scores every day of the window, of rising ones the last day; 90 days back counts, 91 does not."""

    def highs(*scores):
        rows = make_scores(*({"score_date": START + timedelta(days=d), "credit_score": s} for d, s in scores))
        state = carried.advance(None, rows, START + timedelta(days=365), CONTRACT).first()
        return [(found["day"] - START).days for found in state["highs"]]

    assert highs((0, 700), (1, 690), (90, 680)) == [90, 1, 0]
    assert highs((0, 700), (1, 690), (91, 680)) == [91, 1]
    assert highs((0, 600), (1, 610), (2, 610)) == [2]


def test_nothing_arrived(spark, make_accounts, make_scores):
    nothing = spark.createDataFrame([], CREDIT_SCORES)
    empty = carried.advance(None, nothing, START, CONTRACT)
    assert empty.count() == 0
    state = carried.advance(empty, make_scores({"score_date": START}), START, CONTRACT)
    later = carried.advance(state, nothing, START + timedelta(days=400), CONTRACT)
    assert rows_of(later.select("account_id", "newest", "highs")) == rows_of(
        state.select("account_id", "newest", "highs")
    )


def test_pending_is_what_the_date_does_not_know(spark, make_scores):
    scores = observations(make_scores, seed=4, count=50)
    as_of = START + timedelta(days=100)
    known = scores.filter(F.col("score_date") <= F.lit(as_of)).count()
    assert carried.pending(scores, as_of).count() + known == 50
    assert carried.advance(None, carried.pending(scores, as_of), as_of, CONTRACT).count() == 0
