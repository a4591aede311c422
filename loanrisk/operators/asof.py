"""As-of join of two dated tables at arbitrary dates.

Every row of the left table gets the right table's last row at or before its own date, per key. Both time
lines are put into one, and a running last value carries the right side along it: one exchange by key and
one sort, no inequality join, whatever dates either side has.

A key may hold any share of the rows. Hot keys are cut into chunks that keep the order, as in
``hotkeys.with_previous``; a chunk carries its own running value, and the last value of all chunks before
it, found among one row per chunk, fills its beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.operators.hotkeys import HotKeyLimits, split_by_size, with_chunk


_DAY, _SIDE, _ID, _ROW, _VALUE = "day__", "side__", "id__", "row__", "value__"


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_date: str,
    left_id: str,
    right_date: str,
    right_id: str,
    carried: list[str],
    limits: HotKeyLimits = HotKeyLimits(),
) -> DataFrame:
    """All rows and columns of ``left`` and the ``carried`` columns of the right row in force.

    That is the row of the key with the greatest (date, id) not dated after the left row; its columns are
    NULL if there is none. A left row whose key or date is NULL has none either; right rows without a key
    or date are in force nowhere. The ids tell a table's rows apart.
    """
    # Names of either side cannot clash: the left row travels as one value, the right one as another.
    # At equal dates the right side (0) comes first, so that a left row (1) sees its own day.
    mine = left.select(
        key, F.col(left_date).cast("date").alias(_DAY), F.lit(1).alias(_SIDE),
        F.col(left_id).cast("string").alias(_ID), F.struct(*left.columns).alias(_ROW),
    )
    theirs = right.select(
        key, F.col(right_date).cast("date").alias(_DAY), F.lit(0).alias(_SIDE),
        F.col(right_id).cast("string").alias(_ID), F.struct(*carried).alias(_VALUE),
    )
    line = mine.unionByName(theirs, allowMissingColumns=True)
    # Rows that can meet nothing stay out of the windows: all without a key would be one group.
    meets = F.col(key).isNotNull() & F.col(_DAY).isNotNull()

    split = split_by_size(line.filter(meets), key, _ID, limits)
    plain = Window.partitionBy(key).orderBy(_DAY, _SIDE, _ID)
    filled = _only_left(split.ordinary.withColumn(_VALUE, F.last(_VALUE, True).over(plain)))
    filled = filled.unionByName(_only_left(line.filter(~meets)))
    if split.hot is not None:
        filled = filled.unionByName(_only_left(_filled_by_chunks(split.hot, key, limits)))
    return filled.select(f"{_ROW}.*", *(F.col(f"{_VALUE}.{name}").alias(name) for name in carried))


def _only_left(line: DataFrame) -> DataFrame:
    return line.filter(F.col(_SIDE) == 1).select(_ROW, _VALUE)


def _filled_by_chunks(line: DataFrame, key: str, limits: HotKeyLimits) -> DataFrame:
    """The running last value of hot keys: a day and side at a time, cut further at ids drawn by hash."""
    stretch = [key, _DAY, _SIDE]
    cuts = (
        line.filter(F.pmod(F.xxhash64(_DAY, _ID), F.lit(limits.rows)) == 0)
        .groupBy(*stretch)
        .agg(F.sort_array(F.collect_set(_ID)).alias("cuts"))
    )
    chunked = with_chunk(line, cuts, stretch, _ID)
    last = F.max_by(_VALUE, F.when(F.col(_VALUE).isNotNull(), F.col(_ID)))
    link = Window.partitionBy(key).orderBy(_DAY, _SIDE, "chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        chunked.groupBy(*stretch, "chunk").agg(last.alias("last"))
        .select(*stretch, "chunk", F.last("last", True).over(link).alias("before_chunk"))
    )
    inside = Window.partitionBy(*stretch, "chunk").orderBy(_ID)
    return (
        chunked.withColumn("in_chunk", F.last(_VALUE, True).over(inside))
        .join(before, [*stretch, "chunk"])
        .withColumn(_VALUE, F.coalesce("in_chunk", "before_chunk"))
    )
