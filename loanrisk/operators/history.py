"""Operators over the dated credit observations of an account.

Skew: one account may hold a large share of all observations, and no operator here sends
that many rows to one task. Most first reduce them on the map side: to the newest one or two
rows (rank limit before the exchange), to one row per account and day, or to one row per
account and calculation date. What then meets in a per-account window is bounded by the
number of days or dates. Where the rows themselves are needed in order, hot accounts are
split off and take such a plan, while all others take one plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.operators.hotkeys import HotKeyLimits, split_by_size, with_previous
from loanrisk.policy import RiskPolicy

KEY = "account_id"

_OBSERVED = (
    "score_id",
    "score_date",
    "credit_score",
    "derogatory_marks",
    "credit_utilization_pct",
    "payment_history_score",
)


def observations_until(scores: DataFrame, as_of: date | None) -> DataFrame:
    """Observations known at ``as_of``; the filter reaches the scan."""
    return scores if as_of is None else scores.filter(F.col("score_date") <= F.lit(as_of))


def newest_rows(scores: DataFrame, count: int, *key: str) -> DataFrame:
    """The ``count`` newest rows per key with their ``position``, newest first.

    A same-day tie goes to the higher score id. Spark plans the rank filter as a group limit
    ahead of the exchange, so each map task ships at most ``count`` rows per key.
    """
    order = Window.partitionBy(*key).orderBy(F.desc("score_date"), F.desc("score_id"))
    ranked = scores.withColumn("position", F.row_number().over(order))
    return ranked.filter(F.col("position") <= count)


def latest_scores(scores: DataFrame, as_of: date | None = None) -> DataFrame:
    """The newest observation of each account."""
    newest = newest_rows(observations_until(scores, as_of), 1, KEY)
    return newest.select(
        KEY,
        "score_id",
        "score_date",
        F.col("credit_score").alias("latest_credit_score"),
        "derogatory_marks",
        "credit_utilization_pct",
        "payment_history_score",
    )


def _newest_with_previous_marks(scores: DataFrame, *key: str) -> DataFrame:
    """The newest row per key, plus the marks of the row before it within the key."""
    newest = newest_rows(scores, 2, *key)
    first = F.when(F.col("position") == 1, F.struct(*_OBSERVED))
    second = F.when(F.col("position") == 2, F.col("derogatory_marks"))
    grouped = newest.groupBy(*key).agg(
        F.max(first).alias("newest"), F.max(second).alias("previous_marks")
    )
    columns = [F.col(f"newest.{c}").alias(c) for c in _OBSERVED if c not in key]
    return grouped.select(*key, *columns, "previous_marks")


def _days_in_order(rows: DataFrame, policy: RiskPolicy) -> DataFrame:
    """Daily profiles from one exchange by account: windows over its rows, then its days."""
    by_row = Window.partitionBy(KEY).orderBy("day_number", "score_id")
    by_day = Window.partitionBy(KEY).orderBy("day_number")
    trailing = by_day.rangeBetween(-policy.decline_days, Window.currentRow)
    day_high = F.max("credit_score").over(Window.partitionBy(KEY, "day_number"))
    closings = (
        rows.withColumns({
            "previous_marks": F.lag("derogatory_marks").over(by_row),
            "next_day": F.lead("day_number").over(by_row),
        })
        .withColumn("day_high", day_high)
        .filter(F.col("next_day").isNull() | (F.col("next_day") > F.col("day_number")))
    )
    return closings.withColumn("window_high", F.max("day_high").over(trailing))


def _days_grouped(rows: DataFrame, policy: RiskPolicy) -> DataFrame:
    """The same from rows reduced to days first, so that an account's rows never meet."""
    day = [KEY, "day_number"]
    closings = _newest_with_previous_marks(rows, *day).withColumnRenamed(
        "previous_marks", "earlier_same_day"
    )
    highs = rows.groupBy(*day).agg(F.max("credit_score").alias("day_high"))
    by_day = Window.partitionBy(KEY).orderBy("day_number")
    trailing = by_day.rangeBetween(-policy.decline_days, Window.currentRow)
    previous_day = F.lag("derogatory_marks").over(by_day)
    return closings.join(highs, day).withColumns({
        "previous_marks": F.coalesce("earlier_same_day", previous_day),
        "next_day": F.lead("day_number").over(by_day),
        "window_high": F.max("day_high").over(trailing),
    })


def daily_profiles(
    scores: DataFrame, policy: RiskPolicy, limits: HotKeyLimits = HotKeyLimits()
) -> DataFrame:
    """The last observation of each account and day, with what the documented flags need.

    ``previous_marks`` is the mark count one observation earlier, ``window_high`` the best
    score dated within the decline window that ends with the day, ``next_day`` the account's
    next day with an observation. Days are counted as integers for the range frame.
    """
    rows = scores.select(KEY, *_OBSERVED, F.unix_date("score_date").alias("day_number"))
    split = split_by_size(rows, KEY, "score_id", limits)
    columns = [
        KEY,
        "score_id",
        "score_date",
        F.col("credit_score").alias("latest_credit_score"),
        "derogatory_marks",
        "credit_utilization_pct",
        "payment_history_score",
        "previous_marks",
        "window_high",
        "next_day",
    ]
    ordinary = _days_in_order(split.ordinary, policy).select(*columns)
    if split.hot is None:
        return ordinary
    return ordinary.unionByName(_days_grouped(split.hot, policy).select(*columns))


def latest_profiles(
    scores: DataFrame,
    policy: RiskPolicy,
    as_of: date | None = None,
    limits: HotKeyLimits = HotKeyLimits(),
) -> DataFrame:
    """The daily profile of each account's newest day."""
    days = daily_profiles(observations_until(scores, as_of), policy, limits)
    return days.filter(F.col("next_day").isNull()).drop("next_day")


def score_declines(
    scores: DataFrame,
    policy: RiskPolicy,
    as_of: date | None = None,
    limits: HotKeyLimits = HotKeyLimits(),
) -> DataFrame:
    """Accounts whose newest score fell by more than the allowed points in the window."""
    drop = F.col("window_high") - F.col("latest_credit_score")
    return (
        latest_profiles(scores, policy, as_of, limits)
        .select(KEY, "score_date", "latest_credit_score", "window_high", drop.alias("score_drop"))
        .filter(F.col("score_drop") > policy.decline_points)
    )


def new_derogatory_marks(scores: DataFrame, as_of: date | None = None) -> DataFrame:
    """Accounts whose newest observation shows more marks than the one before."""
    newest = _newest_with_previous_marks(observations_until(scores, as_of), KEY)
    before = F.coalesce("previous_marks", F.lit(0))
    return newest.select(
        KEY,
        "score_date",
        "derogatory_marks",
        "previous_marks",
        (F.col("derogatory_marks") - before).alias("new_marks"),
    ).filter(F.col("new_marks") > 0)


def payment_issues(
    scores: DataFrame, policy: RiskPolicy, as_of: date | None = None
) -> DataFrame:
    """Accounts whose newest payment history score is too low."""
    low = F.col("payment_history_score") < policy.payment_floor
    return (
        latest_scores(scores, as_of)
        .select(KEY, "score_id", "score_date", "payment_history_score")
        .filter(low)
    )


def score_trends(scores: DataFrame, as_of: date | None = None) -> DataFrame:
    """First against newest score per account: improving, deteriorating or stable."""
    moment = F.struct("score_date", "score_id")
    change = F.col("latest_score") - F.col("first_score")
    return (
        observations_until(scores, as_of)
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.min_by("credit_score", moment).alias("first_score"),
            F.max_by("credit_score", moment).alias("latest_score"),
        )
        .select(
            "*",
            change.alias("score_change"),
            F.when(change > 0, "improving")
            .when(change < 0, "deteriorating")
            .otherwise("stable")
            .alias("trend"),
        )
    )


def score_progression(
    scores: DataFrame, as_of: date | None = None, limits: HotKeyLimits = HotKeyLimits()
) -> DataFrame:
    """Every observation with its change against the account's previous one."""
    rows = observations_until(scores, as_of).select(
        KEY, "score_id", "score_date", "credit_score"
    )
    lagged = with_previous(
        rows, KEY, "score_date", "score_id", ("score_date", "credit_score"), limits
    )
    return lagged.select(
        KEY,
        "score_id",
        "score_date",
        "credit_score",
        F.col("previous.credit_score").alias("previous_score"),
        (F.col("credit_score") - F.col("previous.credit_score")).alias("score_change"),
        F.datediff("score_date", "previous.score_date").alias("days_since_previous"),
    )


@dataclass(frozen=True)
class Calendar:
    """Calculation dates: ``count`` of them from ``start`` on, every ``step_days``."""

    start: date
    count: int
    step_days: int = 14

    @property
    def last(self) -> date:
        return self.start + timedelta(days=self.step_days * (self.count - 1))

    def first_index(self, day: Column) -> Column:
        """Index of the first calculation date on or after ``day``."""
        ahead = F.ceil(F.datediff(day, F.lit(self.start)) / self.step_days)
        return F.greatest(F.lit(0), ahead).cast("int")

    def date_at(self, index: Column) -> Column:
        return F.date_add(F.lit(self.start), index * self.step_days)


def in_force(scores: DataFrame, calendar: Calendar) -> DataFrame:
    """Which observation is in force at which calculation dates, as index intervals.

    All observations that fall between two calculation dates compete for the same date, so
    only the newest of them is kept, already on the map side.
    """
    known = observations_until(scores, calendar.last)
    moment = F.struct("score_date", "score_id", *_OBSERVED[2:])
    order = Window.partitionBy(KEY).orderBy("from_index")
    return (
        known.groupBy(KEY, calendar.first_index(F.col("score_date")).alias("from_index"))
        .agg(F.max(moment).alias("newest"))
        .select(KEY, "from_index", "newest.*")
        .withColumnRenamed("credit_score", "latest_credit_score")
        .withColumn("to_index", F.lead("from_index", 1, calendar.count).over(order))
    )


def profiles_in_force(
    scores: DataFrame,
    calendar: Calendar,
    policy: RiskPolicy,
    limits: HotKeyLimits = HotKeyLimits(),
) -> DataFrame:
    """Like ``in_force``, with what the documented flags need at every date."""
    days = daily_profiles(observations_until(scores, calendar.last), policy, limits)
    superseded = calendar.first_index(F.date_from_unix_date("next_day"))
    intervals = days.withColumns({
        "from_index": calendar.first_index(F.col("score_date")),
        "to_index": F.when(F.col("next_day").isNull(), calendar.count).otherwise(superseded),
    })
    # A day superseded before the next calculation date is in force at none.
    return intervals.filter(F.col("from_index") < F.col("to_index")).drop("next_day")


def at_each_date(intervals: DataFrame, calendar: Calendar) -> DataFrame:
    """One row per calculation date an interval covers; work is linear in the output."""
    index = F.explode(F.sequence("from_index", F.col("to_index") - 1))
    return (
        intervals.withColumn("date_index", index)
        .withColumn("calculation_date", calendar.date_at(F.col("date_index")))
        .drop("from_index", "to_index", "date_index")
    )
