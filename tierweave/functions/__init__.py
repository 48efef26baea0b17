"""Column expressions shared by the operators. All of them stay inside JVM codegen."""

from tierweave.functions.keys import surrogate_key
from tierweave.functions.moments import (
    as_timestamp,
    booking_lead_days,
    day_of,
    elapsed,
    is_weekend,
    seconds_of,
    weekday,
)
from tierweave.functions.numbers import MONEY, discounted, money, share, zero_if_null
from tierweave.functions.text import normal

__all__ = [
    "MONEY",
    "as_timestamp",
    "booking_lead_days",
    "day_of",
    "discounted",
    "elapsed",
    "is_weekend",
    "money",
    "normal",
    "seconds_of",
    "share",
    "surrogate_key",
    "weekday",
    "zero_if_null",
]
