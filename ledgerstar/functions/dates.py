"""Date parts, year differences and day arithmetic."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365


def as_date(value: datetime.date | str | Column | None) -> Column:
    """A date column from a date, ISO text or column; today when None."""
    if value is None:
        return F.current_date()
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def day_parts(ts: str | Column) -> dict[str, Column]:
    """Zero-padded year, month and day, cut from the ISO form of text, a date or a timestamp."""
    text = (F.col(ts) if isinstance(ts, str) else ts).cast("string")
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 6, 2),
        "day": F.substring(text, 9, 2),
    }


def year_diff(start: str | Column, end: datetime.date | str | Column | None = None) -> Column:
    """Calendar-year boundaries between two dates: 2000-12-31 to 2001-01-01 is 1."""
    start = F.col(start) if isinstance(start, str) else start
    return F.year(as_date(end)) - F.year(start)


def add_years(start: str | Column, years: int | Column) -> Column:
    """``start`` plus ``years`` times 365 days; leap days are not counted."""
    years = F.lit(years) if isinstance(years, int) else years
    return F.date_add(start, (years * DAYS_PER_YEAR).cast("int"))
