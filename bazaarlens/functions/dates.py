"""Calendar-day expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = date | str


def as_day(day: Day) -> date:
    """Accept a ``date`` or an ISO ``yyyy-mm-dd`` string."""
    return date.fromisoformat(day) if isinstance(day, str) else day


def within_days(column: str, first: Day, last: Day) -> Column:
    """True for moments from the start of ``first`` to the end of ``last``.

    Equal to ``to_date(column) BETWEEN first AND last``, but the column stays
    bare, so the range reaches the Parquet scan and can skip row groups.
    """
    start = as_day(first)
    end = as_day(last) + timedelta(days=1)
    return (F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end))


def day_of(column: str) -> Column:
    return F.to_date(F.col(column))


def each_day(first: Day, last: Day) -> Column:
    """One row per day from ``first`` to ``last``, both included."""
    days = F.sequence(F.lit(as_day(first)), F.lit(as_day(last)), F.expr("INTERVAL 1 DAY"))
    return F.explode(days)
