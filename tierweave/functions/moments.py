from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierweave.functions.numbers import _col

_SECONDS = {"hours": 3600, "days": 86400}


def as_timestamp(column: str | Column) -> Column:
    """ISO text (or a date / timestamp) to TIMESTAMP; text that does not parse becomes NULL."""
    return F.try_to_timestamp(_col(column))


def seconds_of(column: str | Column) -> Column:
    """Whole epoch seconds. The cast first: TIMESTAMP_NTZ has no direct conversion to a number."""
    return F.unix_seconds(_col(column).cast("timestamp"))


def elapsed(start: str | Column, end: str | Column, unit: str) -> Column:
    """Fractional hours or days between two times, negative when ``end`` precedes ``start``."""
    return (seconds_of(end) - seconds_of(start)) / F.lit(_SECONDS[unit])


def day_of(column: str | Column) -> Column:
    return F.to_date(_col(column))


def weekday(column: str | Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_col(column)).cast("tinyint")


def is_weekend(column: str | Column) -> Column:
    return F.dayofweek(_col(column)).isin(1, 7)


def booking_lead_days(departure: str | Column, booked: str | Column) -> Column:
    """Days between booking and departure; a booking after departure counts as 0.

    ``greatest`` skips NULLs, so an unknown date gives 0 as well.
    """
    return F.greatest(F.date_diff(_col(departure), _col(booked)), F.lit(0))
