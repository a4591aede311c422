"""The as-of join against the rows in force found one by one, on colliding dates and hot keys."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest

from loanrisk.operators.asof import as_of_join
from loanrisk.operators.hotkeys import HotKeyLimits
from loanrisk.plans.registry import queries
from tests.test_plans import executed, exchanges

START = date(2023, 1, 1)
LEFT = "account string, at date, id string, value int"
RIGHT = "account string, since date, id string, value int, day__x string"


def tables(spark, seed, left=200, right=300, keys=4, days=25):
    random = np.random.default_rng(seed)

    def key():
        drawn = int(random.integers(keys + 1))
        return None if drawn == keys else f"K{min(drawn, 1)}"

    def day():
        return None if random.random() < 0.05 else START + timedelta(days=int(random.integers(days)))

    lefts = [(key(), day(), f"L{k}", k) for k in range(left)]
    rights = [(key(), day(), f"R{k:03d}", None if k % 7 == 0 else k, "x") for k in range(right)]
    return lefts, rights, spark.createDataFrame(lefts, LEFT), spark.createDataFrame(rights, RIGHT)


def one_by_one(lefts, rights):
    rows = []
    for account, at, number, value in lefts:
        known = [r for r in rights if None not in (account, at, r[1]) and r[0] == account and r[1] <= at]
        best = max(known, key=lambda r: (r[1], r[2]), default=(None,) * 5)
        rows.append(repr((account, at, number, value, best[2], best[3])))
    return sorted(rows)


@pytest.mark.parametrize("limits", [HotKeyLimits(), HotKeyLimits(rows=9, draw_one_in=1),
                                    HotKeyLimits(rows=9, draw_one_in=1, broadcast_keys=0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_join(spark, limits, seed):
    lefts, rights, left, right = tables(spark, seed)
    right = right.withColumnsRenamed({"id": "right_id", "value": "right_value"})
    joined = as_of_join(left, right, "account", "at", "id", "since", "right_id", ["right_id", "right_value"], limits)
    assert sorted(repr(tuple(row)) for row in joined.collect()) == one_by_one(lefts, rights)


def test_nothing_to_join(spark):
    _, _, left, right = tables(spark, 3)
    right = right.withColumnRenamed("value", "known")
    joined = as_of_join(left, right.limit(0), "account", "at", "id", "since", "id", ["known"])
    assert joined.count() == 200 and joined.filter("known is not null").isEmpty()
    assert as_of_join(left.limit(0), right, "account", "at", "id", "since", "id", ["known"]).isEmpty()


def test_one_exchange_and_no_inequality_join(spark, sf_dir):
    plan = executed(queries()["orders_as_of_scores"](spark, sf_dir))
    assert "Join" not in plan and len(exchanges(plan)) == 1
