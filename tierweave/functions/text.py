from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal(column: str | Column, default: str | None = None) -> Column:
    """Lower-case, trimmed text; NULL becomes ``default`` when one is given."""
    text = F.trim(F.lower(column))
    return text if default is None else F.coalesce(text, F.lit(default))
