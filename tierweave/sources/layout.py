"""Table properties, and the partition columns and file order that follow from them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layout:
    """Physical layout of a stored table.

    ``by_day`` / ``by_month`` name a time column to partition by, ``bucket`` a column whose hash gives a
    further partition level, ``order`` the columns that files are sorted by.
    """

    by_day: str | None = None
    by_month: str | None = None
    bucket: str | None = None
    buckets: int = 8
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    """``kind``: ``raw`` replaces whole partitions; the others are merged on ``keys``.

    ``indexed`` names time columns whose first and last day are kept for every written partition. A merge of a table with a
    ``log`` marks the rows it adds or changes and keeps those columns as they were before, so that what was made from the
    table can follow it. ``moment`` is the column of the first dependency whose day is the first of a summary's keys;
    a summary that ``needs_moment`` leaves out rows where it is NULL. ``references`` are (column, table, key): what a batch's
    column has to find in a stored silver dimension before the table may run.
    """

    name: str
    layer: str
    kind: str
    keys: tuple[str, ...]
    ddl: str
    tracked: tuple[str, ...] = ()
    window_field: str | None = None
    depends_on: tuple[str, ...] = ()
    layout: Layout = field(default_factory=Layout)
    indexed: tuple[str, ...] = ()
    log: tuple[str, ...] = ()
    moment: str | None = None
    needs_moment: bool = False
    references: tuple[tuple[str, str, str], ...] = ()


def partition_columns(layout: Layout) -> list[str]:
    return [f.name for f in partition_fields(layout)]


def with_partition_columns(df: DataFrame, layout: Layout) -> DataFrame:
    """Day, month and hash-bucket columns derived from the layout's source columns."""
    derived = {}
    if layout.by_day:
        derived[f"{layout.by_day}_day"] = F.to_date(layout.by_day)
    if layout.by_month:
        derived[f"{layout.by_month}_month"] = F.trunc(layout.by_month, "month")
    if layout.bucket:
        bucket = F.pmod(F.xxhash64(layout.bucket), F.lit(layout.buckets))
        derived[f"{layout.bucket}_bucket"] = bucket.cast("int")
    return df.withColumns(derived) if derived else df


def lay_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Partition columns, file distribution and file order.

    ``rebalance`` brings the rows of a partition together but lets adaptive execution split one that is
    too large for a task, so a hot day is written by many tasks. A table without partitions is sorted
    by range, which splits a hot key along the further order columns.
    """
    parts = partition_columns(layout)
    laid = with_partition_columns(df, layout)
    if not parts:
        return laid.sort(*layout.order) if layout.order else laid
    return laid.hint("rebalance", *parts).sortWithinPartitions(*parts, *layout.order)


def distinct_partitions(df: DataFrame, layout: Layout) -> list[tuple]:
    parts = partition_columns(layout)
    return [tuple(r) for r in df.select(*parts).distinct().collect()] if parts else []


def partition_fields(layout: Layout) -> list[StructField]:
    ddl = [f"{c}_day DATE" for c in (layout.by_day,) if c]
    ddl += [f"{c}_month DATE" for c in (layout.by_month,) if c]
    ddl += [f"{c}_bucket INT" for c in (layout.bucket,) if c]
    return StructType.fromDDL(", ".join(ddl)).fields if ddl else []


def partition_sources(layout: Layout) -> list[str]:
    return [c for c in (layout.by_day, layout.by_month, layout.bucket) if c]


def any_of(names: Sequence[str], wanted: Iterable[Sequence]) -> Column:
    """Condition for a set of partitions, compact enough for thousands of them.

    Values of the first column that share the same further values become one term.
    """
    rests: dict = {}
    for head, *rest in wanted:
        rests.setdefault(head, set()).add(tuple(rest))
    alike: dict = {}
    for head, rest in rests.items():
        alike.setdefault(frozenset(rest), []).append(head)
    terms = [
        _among(names[0], heads) & any_of(names[1:], rest) if len(names) > 1 else _among(names[0], heads)
        for rest, heads in alike.items()
    ]
    return _either(terms)


def _among(name: str, values: Sequence) -> Column:
    known = F.col(name).isin([v for v in values if v is not None])
    return known | F.col(name).isNull() if None in values else known


def _either(terms: list[Column]) -> Column:
    """A balanced OR: a chain of thousands would overflow the optimizer's stack."""
    if not terms:
        return F.lit(False)
    while len(terms) > 1:
        terms = [a | b for a, b in zip_longest(terms[::2], terms[1::2], fillvalue=F.lit(False))]
    return terms[0]


def partition_folder(layout: Layout, values: Sequence) -> str:
    pairs = zip(partition_columns(layout), values)
    return "/".join(f"{name}={NULL_PARTITION if v is None else v}" for name, v in pairs)
