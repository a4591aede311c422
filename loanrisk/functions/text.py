"""Text forms used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def percent(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))


def canonical(column: Column, domain: tuple[str, ...]) -> Column:
    """The domain's spelling of a value that differs by case or outer blanks only."""
    trimmed = F.trim(column)
    spelling = F.create_map(*(F.lit(x) for v in domain for x in (v.lower(), v)))
    return F.coalesce(spelling[F.lower(trimmed)], trimmed)
