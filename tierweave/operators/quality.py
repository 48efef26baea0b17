"""Data-quality rules. All row rules of a table are evaluated in one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ERROR = "error"
WARNING = "warning"


class QualityError(RuntimeError):
    """Raised by ``gate`` with the rules that block publishing."""


@dataclass(frozen=True)
class Rule:
    """One constraint.

    ``good`` is a predicate per row and ``least`` the share of rows that must meet it. ``unique`` lists
    key columns instead. ``measure`` is an aggregate reported as the metric in place of the share, and
    must not be NULL for the rule to pass.
    """

    name: str
    kind: str
    level: str = ERROR
    good: Column | None = None
    null_passes: bool = True
    least: float = 1.0
    below: bool = False
    measure: Column | None = None
    unique: tuple[str, ...] = field(default=())

    def warn(self) -> Rule:
        return replace(self, level=WARNING)


REPORT = "rule STRING, kind STRING, level STRING, checked BIGINT, violations BIGINT, metric DOUBLE, passed BOOLEAN"


# --- rule constructors -------------------------------------------------------------------------------


def complete(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is complete", "complete", good=F.col(c).isNotNull()) for c in columns]


def any_complete(*columns: str) -> Rule:
    return Rule(f"{' or '.join(columns)} is complete", "any_complete", good=F.coalesce(*columns).isNotNull())


def unique(*columns: str) -> Rule:
    """No two rows share the key; rows with an all-NULL key are not compared."""
    return Rule(f"{', '.join(columns)} is unique", "unique" if len(columns) == 1 else "grain", unique=columns)


def one_active(key: str) -> Rule:
    """At most one active version per key."""
    return Rule(f"one active row per {key}", "one_active", unique=(key,), good=F.col("is_active"))


def contained(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column} in {', '.join(values)}", "contained", good=F.col(column).isin(*values))


def at_least(column: str, bound: float) -> Rule:
    return _extreme(column, F.min(column), F.col(column) >= bound, f"min {column} >= {bound}", "min")


def above(column: str, bound: float) -> Rule:
    return _extreme(column, F.min(column), F.col(column) > bound, f"min {column} > {bound}", "min")


def at_most(column: str, bound: float) -> Rule:
    return _extreme(column, F.max(column), F.col(column) <= bound, f"max {column} <= {bound}", "max")


def min_length(column: str, bound: int) -> Rule:
    size = F.length(column)
    return _extreme(column, F.min(size), size >= bound, f"{column} has {bound} or more characters", "min_length")


def max_length(column: str, bound: int) -> Rule:
    size = F.length(column)
    return _extreme(column, F.max(size), size <= bound, f"{column} has {bound} or fewer characters", "max_length")


def positive(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is positive", "positive", good=F.col(c) > 0) for c in columns]


def non_negative(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is not negative", "non_negative", good=F.col(c) >= 0) for c in columns]


def satisfies(name: str, predicate: str | Column, least: float = 1.0) -> Rule:
    """Share of rows that meet a predicate; a NULL outcome does not meet it."""
    good = F.expr(predicate) if isinstance(predicate, str) else predicate
    return Rule(name, "satisfies", good=good, null_passes=False, least=least)


def matches(name: str, column: str, pattern: str) -> Rule:
    """Text format of the non-NULL values."""
    return Rule(name, "matches", good=F.col(column).rlike(pattern))


def not_empty() -> Rule:
    return Rule("table is not empty", "size", good=F.lit(True), measure=F.nullif(F.count(F.lit(1)), F.lit(0)))


def fresh(column: str = "updated_at", days: int = 2, stale_below: float = 0.5) -> Rule:
    """Less than ``stale_below`` of the rows are older than ``days``."""
    limit = F.current_timestamp() - F.make_dt_interval(F.lit(days))
    recent = F.coalesce(F.col(column) >= limit, F.lit(True))
    return Rule(f"{column} within {days} days", "fresh", good=recent, least=1 - stale_below, below=True)


def _extreme(column: str, measure: Column, good: Column, name: str, kind: str) -> Rule:
    return Rule(name, kind, good=good, measure=measure.cast("double"))


# --- evaluation --------------------------------------------------------------------------------------


def evaluate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One report row per rule.

    Row rules share a single global aggregate whose result is turned into rows with ``inline``. Each
    uniqueness rule needs its own grouping; it reads only its key columns and counts map-side first.
    """
    rules = list(rules)
    by_row = [r for r in rules if not r.unique]
    reports = [_row_report(df, by_row)] if by_row else []
    reports += [_unique_report(df, r) for r in rules if r.unique]
    return reduce(DataFrame.unionByName, reports)


def _row_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.agg(*_sums(rules)).select(F.inline(F.array(*[_entry(r, i) for i, r in enumerate(rules)])))


def _sums(rules: Sequence[Rule]) -> list[Column]:
    sums: list[Column] = [F.count(F.lit(1)).alias("checked")]
    for i, rule in enumerate(rules):
        met = F.coalesce(rule.good, F.lit(rule.null_passes))
        sums.append(F.count_if(~met).alias(f"bad_{i}"))
        if rule.measure is not None:
            sums.append(rule.measure.cast("double").alias(f"measure_{i}"))
    return sums


def _entry(rule: Rule, i: int) -> Column:
    bad = F.col(f"bad_{i}")
    met_share = F.lit(1.0) - F.coalesce(F.try_divide(bad, F.col("checked")), F.lit(0.0))
    enough = met_share > rule.least if rule.below else met_share >= rule.least
    if rule.measure is None:
        return _line(rule, F.col("checked"), bad, met_share, enough)
    measured = F.col(f"measure_{i}")
    return _line(rule, F.col("checked"), bad, measured, measured.isNotNull() & (bad == 0))


def _unique_report(df: DataFrame, rule: Rule) -> DataFrame:
    keys = list(rule.unique)
    keyed = df.where(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    if rule.good is not None:
        keyed = keyed.where(rule.good)
    groups = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("bad"),
    )
    met = F.lit(1.0) - F.coalesce(F.try_divide("bad", "checked"), F.lit(0.0))
    line = _line(rule, F.col("checked"), F.col("bad"), met, F.col("bad") == 0)
    return counted.select(F.inline(F.array(line)))


def _line(rule: Rule, checked: Column, bad: Column, metric: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.kind).alias("kind"),
        F.lit(rule.level).alias("level"),
        checked.alias("checked"),
        bad.alias("violations"),
        metric.cast("double").alias("metric"),
        passed.alias("passed"),
    )


# --- states that add up ------------------------------------------------------------------------------

#: How measures of parts become the measure of the whole; rules without one only count.
_COMBINED = {"min": min, "min_length": min, "max": max, "max_length": max, "size": lambda values: sum(values)}


def by_parts(rules: Iterable[Rule]) -> list[Rule]:
    """The rules whose outcome for a table follows from their outcomes for its parts: those over rows. Unique keys may meet across parts,
    and how fresh rows are changes by itself."""
    return [r for r in rules if not r.unique and r.kind != "fresh" and (r.measure is None or r.kind in _COMBINED)]


def state_columns(rules: Iterable[Rule]) -> dict[str, Column]:
    """Aggregates that hold all that ``report_of_states`` needs to know of a part, by name."""
    rules = by_parts(rules)
    names = [f"{kind}:{r.name}" for r in rules for kind in (["bad", "measure"] if r.measure is not None else ["bad"])]
    return dict(zip(["checked", *names], _sums(rules)))


def report_of_states(states: Iterable[Mapping[str, float | None]], rules: Iterable[Rule]) -> list[Row]:
    """The report that ``evaluate`` would give for the rows of all parts, from their states alone."""
    states, lines = list(states), []
    checked = sum(int(s["checked"]) for s in states)
    for rule in by_parts(rules):
        bad = sum(int(s[f"bad:{rule.name}"]) for s in states)
        if rule.measure is None:
            metric = 1.0 - (bad / checked if checked else 0.0)
            passed = metric > rule.least if rule.below else metric >= rule.least
        else:
            found = [s[f"measure:{rule.name}"] for s in states]
            found = [m for m in found if m is not None]
            metric = float(_COMBINED[rule.kind](found)) if found else None
            passed = metric is not None and bad == 0
        lines.append(Row(rule=rule.name, kind=rule.kind, level=rule.level, checked=checked, violations=bad, metric=metric, passed=passed))
    return lines


# --- rules over two tables ---------------------------------------------------------------------------


def resolves(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, level: str = ERROR
) -> DataFrame:
    """Every non-NULL foreign key has a dimension row."""
    return resolves_each(facts, [(fact_key, dim, dim_key)], level)


def resolves_each(facts: DataFrame, references: Sequence[tuple[str, DataFrame, str]], level: str = ERROR) -> DataFrame:
    """``resolves`` for several (column, dimension, key), in one pass over the facts. Keys are compared as text, counted
    map-side, and only different ones are shuffled."""
    entries = [F.struct(F.lit(i).alias("_nth"), F.col(c).cast("string").alias("_key")) for i, (c, _, _) in enumerate(references)]
    keys = facts.select(F.inline(F.array(*entries))).where(F.col("_key").isNotNull()).groupBy("_nth", "_key").agg(F.count(F.lit(1)).alias("_n"))
    stored = [dim.select(F.lit(i).alias("_nth"), F.col(k).cast("string").alias("_key")) for i, (_, dim, k) in enumerate(references)]
    known = reduce(DataFrame.unionByName, stored).distinct().withColumn("_known", F.lit(True))
    sums, lines = [], []
    for i, (column, _, key) in enumerate(references):
        own = F.col("_nth") == i
        sums.append(F.coalesce(F.sum(F.when(own, F.col("_n"))), F.lit(0)).alias(f"checked_{i}"))
        sums.append(F.coalesce(F.sum(F.when(own & F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias(f"bad_{i}"))
        rule = Rule(f"{column} resolves to {key}", "foreign_key", level)
        bad = F.col(f"bad_{i}")
        met = F.lit(1.0) - F.coalesce(F.try_divide(bad, f"checked_{i}"), F.lit(0.0))
        lines.append(_line(rule, F.col(f"checked_{i}"), bad, met, bad == 0))
    return keys.join(known, ["_nth", "_key"], "left").agg(*sums).select(F.inline(F.array(*lines)))


def same_size(table: DataFrame, source: DataFrame, level: str = ERROR) -> DataFrame:
    """The table holds as many rows as its source; violations is the difference."""
    rule = _row_count(level)
    rows = table.select(F.lit(True).alias("_mine")).unionAll(source.select(F.lit(False)))
    both = rows.agg(F.count_if("_mine").alias("checked"), F.count_if(~F.col("_mine")).alias("expected"))
    gap = F.abs(F.col("checked") - F.col("expected"))
    line = _line(rule, F.col("checked"), gap, F.col("expected"), gap == 0)
    return both.select(F.inline(F.array(line)))


def same_count(spark: SparkSession, checked: int, expected: int, level: str = ERROR) -> DataFrame:
    """The report of ``same_size`` for two counts that are known already."""
    gap = abs(checked - expected)
    line = _line(_row_count(level), *[F.lit(x).cast("long") for x in (checked, gap, expected)], F.lit(gap == 0))
    return spark.range(1).select(F.inline(F.array(line)))


def _row_count(level: str) -> Rule:
    return Rule("row count equals source", "row_count", level)


# --- schema and gate ---------------------------------------------------------------------------------


def schema_differences(df: DataFrame, ddl: str) -> list[str]:
    """Columns whose type differs from the declaration, or that only one side has. Runs no job."""
    declared = {f.name.lower(): f.dataType.simpleString() for f in StructType.fromDDL(ddl)}
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    return [
        f"{name}: declared {declared.get(name, 'nothing')}, found {actual.get(name, 'nothing')}"
        for name in sorted({*declared, *actual})
        if declared.get(name) != actual.get(name)
    ]


def gate(report: DataFrame, strict: bool = False) -> list:
    """Run the checks and raise on failed error rules; ``strict`` lets warnings block too.

    Returns the report, one row per rule, as the only data that reaches the driver.
    """
    lines = report.collect()
    blocking = [r for r in lines if not r.passed and (strict or r.level == ERROR)]
    if blocking:
        raise QualityError("; ".join(f"{r.rule}: {r.violations} of {r.checked}" for r in blocking))
    return lines
