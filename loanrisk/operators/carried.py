"""State that is carried from one calculation date to the next, so that old observations are not read again.

All that the rules need of an account's past is its two newest observations and the best scores of the
days that a trailing window may still cover. That is one short row per account, and it is mergeable: the
state at a later date is the earlier state and whatever arrived since, in any order. An observation that
arrives late, dated before the state, finds its place as if it had been there; one dated after the date is
handed on as pending. ``metrics_from_state`` therefore gives row for row what ``build_risk_metrics`` gives
from all observations.

An account's new observations are reduced on the map side, to two rows and to one row per day, so no
account is too large; what meets per account is bounded by the days of the calendar.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
)

from loanrisk.operators.history import KEY, newest_rows, observations_until
from loanrisk.operators.metrics import metrics_of
from loanrisk.policy import RiskPolicy

#: An observation as the state keeps it: in the order that decides which is newer.
_OBSERVATION = StructType([
    StructField("score_date", DateType()),
    StructField("score_id", StringType()),
    StructField("credit_score", IntegerType()),
    StructField("derogatory_marks", IntegerType()),
    StructField("credit_utilization_pct", DecimalType(5, 2)),
    StructField("payment_history_score", IntegerType()),
])
_DAY = StructType([StructField("day", DateType()), StructField("high", IntegerType())])

#: ``newest`` holds an account's one or two newest observations, the newest first. ``highs`` holds, the
#: newest first, the days of the window that ends with it whose best score no later day reaches: a window
#: that ends there or later takes its maximum among these.
SCORE_STATE = StructType([
    StructField("account_id", StringType()),
    StructField("newest", ArrayType(_OBSERVATION)),
    StructField("highs", ArrayType(_DAY)),
    StructField("through_load", LongType()),
    StructField("calculation_date", DateType()),
])

_FIELDS = _OBSERVATION.names


def _observation() -> Column:
    return F.struct(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in _OBSERVATION))


def _reduced(rows: DataFrame) -> DataFrame:
    """Per account its two newest rows and the best score of each of its days."""
    newest = newest_rows(rows, 2, KEY).groupBy(KEY).agg(F.collect_list(_observation()).alias("newest"))
    days = rows.groupBy(KEY, "score_date").agg(F.max("credit_score").cast("int").alias("high"))
    highs = days.filter("high is not null").groupBy(KEY).agg(
        F.collect_list(F.struct(F.col("score_date").alias("day"), "high")).alias("highs")
    )
    return newest.join(highs, KEY, "left")


def _still_needed(highs: Column, last: Column, policy: RiskPolicy) -> Column:
    """Days of the window that ends with ``last``, newest first, without those a later day outdoes."""
    newest_first = F.sort_array(F.coalesce(highs, F.array().cast(ArrayType(_DAY))), asc=False)
    inside = F.filter(newest_first, lambda d: d["day"] >= F.date_sub(last, policy.decline_days))
    return F.aggregate(
        inside,
        F.array().cast(ArrayType(_DAY)),
        lambda kept, d: F.when(
            (F.size(kept) == 0) | (d["high"] > F.element_at(kept, -1)["high"]), F.concat(kept, F.array(d))
        ).otherwise(kept),
    )


def advance(
    state: DataFrame | None, arrived: DataFrame, as_of: date, policy: RiskPolicy, through_load: int = 0
) -> DataFrame:
    """The state at ``as_of`` from an earlier one and the observations that it has not seen.

    ``arrived``: all of these, whatever their dates; those after ``as_of`` are left to ``pending``.
    Without an earlier state, ``arrived`` is all there is. An observation counts once, also if it is
    handed in again. ``through_load`` is noted on the state for the caller.
    """
    new = _reduced(observations_until(arrived, as_of))
    newest, highs = F.col("newest"), F.col("highs")
    if state is not None:
        none = F.array().cast(ArrayType(_OBSERVATION))
        before = state.select(KEY, newest.alias("newest_before"), highs.alias("highs_before"))
        new = new.join(before, KEY, "full")
        newest = F.concat(F.coalesce("newest_before", none), F.coalesce("newest", none))
        no_days = F.array().cast(ArrayType(_DAY))
        highs = F.concat(F.coalesce("highs_before", no_days), F.coalesce("highs", no_days))
    # Seen twice is seen once: a repeated row must not pass for the observation before it.
    two = F.slice(F.sort_array(F.array_distinct(newest), asc=False), 1, 2)
    merged = new.select(KEY, two.alias("newest"), highs.alias("highs"))
    last = F.get("newest", F.lit(0))["score_date"]
    return merged.select(
        KEY, "newest", _still_needed(F.col("highs"), last, policy).alias("highs"),
        F.lit(through_load).cast("long").alias("through_load"), F.lit(as_of).alias("calculation_date"),
    )


def pending(arrived: DataFrame, as_of: date) -> DataFrame:
    """Observations that are dated after ``as_of``: not known yet, to be handed to the next date."""
    return arrived.filter(F.col("score_date") > F.lit(as_of))


def profiles(state: DataFrame) -> DataFrame:
    """The state as the profiles that the rules are evaluated on; see ``history.latest_profiles``."""
    newest, previous = F.get("newest", F.lit(0)), F.get("newest", F.lit(1))
    columns = {name: newest[name].alias(name) for name in _FIELDS if name != "credit_score"}
    return state.select(
        KEY,
        columns["score_id"],
        columns["score_date"],
        newest["credit_score"].alias("latest_credit_score"),
        columns["derogatory_marks"],
        columns["credit_utilization_pct"],
        columns["payment_history_score"],
        previous["derogatory_marks"].alias("previous_marks"),
        F.array_max(F.col("highs.high")).alias("window_high"),
    )


def metrics_from_state(accounts: DataFrame, state: DataFrame, as_of: date, policy: RiskPolicy) -> DataFrame:
    """One metrics row per scored account, from the state at ``as_of`` alone."""
    return metrics_of(accounts, profiles(state), as_of, policy)
