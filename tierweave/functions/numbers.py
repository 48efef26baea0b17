from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: str | Column) -> Column:
    """Two-decimal amount. Sums and rounds widen decimals, so results are cast back with this too."""
    return _col(column).cast(MONEY)


def zero_if_null(column: str | Column, dtype: str) -> Column:
    """NULL becomes a zero *of the column's own type*, so decimals never decay to double."""
    return F.coalesce(_col(column).cast(dtype), F.lit(0).cast(dtype))


def discounted(price: str | Column, discount: str | Column) -> Column:
    """Price after a fractional discount, rounded half-up to cents."""
    return money(F.round(_col(price) * (F.lit(1) - _col(discount)), 2))


def share(part: str | Column, whole: str | Column, places: int) -> Column:
    """``part / whole`` rounded; NULL when the whole is zero (ANSI division would raise)."""
    return F.round(F.try_divide(_col(part), _col(whole)), places)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
