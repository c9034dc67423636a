"""Dates: the market's local day and the relative periods of the question bank.

``as_of`` stands for "today". It is a date, or a column such as a scalar subquery, so that answers
can be reproduced on old data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: market time is UTC+10 all year, without daylight saving.
MARKET_OFFSET_SECONDS = 10 * 3600


def as_date(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def _column(day: Column | str) -> Column:
    return F.col(day) if isinstance(day, str) else day


def market_date(instant: Column) -> Column:
    """Local calendar day of an instant. Counts seconds, so the session time zone has no say."""
    days = F.floor((F.unix_seconds(instant) + MARKET_OFFSET_SECONDS) / 86400)
    return F.date_from_unix_date(days.cast("int"))


def market_midnight(day: Column) -> Column:
    """Instant at which a local calendar day starts."""
    return F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 - MARKET_OFFSET_SECONDS)


def in_last_days(day: Column | str, as_of, days: int) -> Column:
    """Inclusive look-back: as_of minus ``days`` and everything after it."""
    return _column(day) >= F.date_sub(as_date(as_of), days)


def in_years(day: Column | str, first: int | Column, last: int | Column) -> Column:
    """Whole calendar years as a date range, which prunes files where YEAR(day) would not."""
    first, last = (y if isinstance(y, Column) else F.lit(y) for y in (first, last))
    return _column(day).between(F.make_date(first, F.lit(1), F.lit(1)), F.make_date(last, F.lit(12), F.lit(31)))


def in_last_full_year(day: Column | str, as_of) -> Column:
    year = F.year(as_date(as_of)) - 1
    return in_years(day, year, year)
