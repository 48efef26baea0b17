"""Merges as joins: plain parquet has no MERGE, so each function returns the table after the merge."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.operators.skew import HOT_ROWS, SLOT, hot_ranges, neighbour, only_hot, with_range_slots


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    null_safe: bool = True,
    match_null_keys: bool = True,
    keep_absent: bool = True,
    log: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys, replace rows whose ``compare`` columns changed, leave the others untouched.

    ``compare`` defaults to all non-key columns; an audit column left out of it moves only together with
    a real change. The batch holds one row per key. ``null_safe=False`` compares with ``<>``, which
    cannot see a change from or to NULL; ``match_null_keys=False`` matches keys with ``=``, which inserts
    a NULL-key row again on every run. Both exist to reproduce tables built that way. ``keep_absent=False`` takes the
    batch as complete: stored keys that it lacks go away. ``log`` adds ``_changed`` and, for changed rows, those
    columns as they were in ``_before``.
    """
    compare = [c for c in target.columns if c not in keys] if compare is None else compare
    paired = _pair(target, batch, keys, match_null_keys)
    if not keep_absent:
        paired = paired.where(F.col("_new_here").isNotNull())
    take_new = _only_new() | (_both() & _differs(compare, null_safe))
    settled = {c: F.when(take_new, _new(c)).otherwise(_old(c)) for c in target.columns}
    return paired.select(*[v.alias(c) for c, v in settled.items()], *_log(settled, log))


def changed_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Stored and new rows, in the target's columns, of all keys that were added, changed or lost."""
    paired = _pair(target, batch, keys)
    differ = paired.where(~(_both() & ~_differs(compare, null_safe=True)) | F.col("_new_here").isNull())
    rows = [F.when(F.col(f"_{side}_here"), F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in target.columns])) for side in ("old", "new")]
    return differ.select(F.inline(F.array_compact(F.array(*rows))))


def fold_history(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    order: str,
    milestones: Sequence[str],
    log: Sequence[str] = (),
    earliest: Sequence[str] = (),
) -> DataFrame:
    """Fold collapsed increments into the stored fact without reading the event history again.

    Latest row and milestone times are maxima, so combining the stored row with the increment gives what
    collapsing all events would: the later of the two rows, and the later of each milestone. An older
    increment only adds milestones. Columns that are ``earliest`` times are minima. ``log`` is that of ``upsert``.
    """
    paired = _pair(target, batch, [key])
    newer = F.coalesce(_new(order) >= _old(order), _new(order).isNotNull())
    take_new = _only_new() | (_both() & newer)
    settled = {c: F.when(take_new, _new(c)).otherwise(_old(c)) for c in target.columns}
    settled |= {c: F.greatest(_old(c), _new(c)) for c in milestones} | {c: F.least(_old(c), _new(c)) for c in earliest}
    return paired.select(*[v.alias(c) for c, v in settled.items()], *_log(settled, log))


def scd1_merge(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    null_safe: bool = True,
    full_snapshot: bool = False,
) -> DataFrame:
    """Overwrite changed rows in place; the surrogate key of the first insert stays.

    A deleted row that reappears is overwritten and undeleted. Only a ``full_snapshot`` batch says
    anything about absent rows: those become ``is_deleted``. An incremental batch leaves them alone.
    """
    paired = _pair(target, batch, [key])
    overwrite = _both() & (_differs(tracked, null_safe) | F.coalesce(_old("is_deleted"), F.lit(False)))
    moving = {*tracked, "is_deleted"}

    def settled(column: str) -> Column:
        value = F.when(_only_new(), _new(column))
        if column in moving:
            value = value.when(overwrite, _new(column))
        if column == "is_deleted" and full_snapshot:
            value = value.when(F.col("_new_here").isNull(), F.lit(True))
        return value.otherwise(_old(column))

    return paired.select(*[settled(c).alias(c) for c in target.columns])


def soft_delete(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Mark the rows whose key is absent from a full snapshot; nothing else changes."""
    present = batch.select(F.col(key).alias("_present")).distinct()
    joined = target.join(present, F.col(key) == F.col("_present"), "left")
    return joined.withColumn(
        "is_deleted", F.col("is_deleted") | F.col("_present").isNull()
    ).select(*target.columns)


def scd2_expire_and_open(
    target: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """One new version per key: close the active row when a tracked column changed, open the new one.

    Closed history is passed through without a shuffle; active rows and batch meet in one full outer
    join that yields up to two rows per key. Two batch rows for one key are ambiguous here and fail the
    job; ``scd2_merge`` accepts them.
    """
    columns = target.columns
    is_open = F.coalesce(F.col("is_active"), F.lit(False))
    paired = _pair(target.where(is_open), _one_row_per(batch, key), [key])
    changed = _both() & _differs(tracked, null_safe)

    before = F.struct(
        *[
            F.when(changed, F.lit(False)).otherwise(_old(c)).alias(c)
            if c == "is_active"
            else F.when(changed, _new("start_date")).otherwise(_old(c)).alias(c)
            if c == "end_date"
            else _old(c).alias(c)
            for c in columns
        ]
    )
    after = F.struct(
        *[
            F.lit(True).alias(c)
            if c == "is_active"
            else F.lit(None).cast(target.schema[c].dataType).alias(c)
            if c == "end_date"
            else _new(c).alias(c)
            for c in columns
        ]
    )
    rows = F.array_compact(
        F.array(F.when(F.col("_old_here"), before), F.when(_only_new() | changed, after))
    )
    return target.where(~is_open).unionByName(paired.select(F.inline(rows)))


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    hot_rows: int = HOT_ROWS,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Versioned merge for any number of versions per key, in any order of arrival.

    The stored versions of the touched keys and the batch form one chain per key ordered by
    ``start_date``: a batch version equal to its predecessor is dropped, every other one ends where its
    successor starts, and the last is active. A batch version with the start of a stored one replaces
    its content. Stored versions are never dropped, and keys outside the batch are not rewritten.

    Closed history stays closed: a batch version that starts inside a stored interval ends with it at the
    latest, and one that repeats its predecessor is dropped only while the predecessor is still in force.

    The chain of a key with ``hot_rows`` rows or more is cut into ranges of start dates, within one day too; ranges are chained on their
    own and pass values on at their edges. ``stage`` may store a frame under a name and return the stored copy: then the list of hot
    keys is looked at first, without one the chains are plain windows, and with one no pass computes the passes before it again.
    """
    columns = target.columns
    touched = batch.select(key).distinct()
    untouched = target.join(touched, key, "left_anti")
    pool = target.join(touched, key, "left_semi").select(F.lit(0).alias("_source"), *columns)
    pool = pool.unionByName(batch.select(F.lit(1).alias("_source"), *columns))

    body = [c for c in columns if c not in (key, "start_date", "is_active", "end_date")]
    at_start = pool.groupBy(key, "start_date").agg(
        F.max(F.struct("_source", *body)).alias("_row"),
        F.min("_source").alias("_origin"),
        F.max("end_date").alias("_stored_end"),
    )
    versions = at_start.select(key, "start_date", "_origin", "_stored_end", *[f"_row.{c}" for c in body])
    hot = hot_ranges(pool.select(key, "start_date"), hot_rows)
    if stage is not None:
        hot = stage(hot, "hot_keys")
        hot = None if hot.isEmpty() else hot
    step = stage if stage is not None and hot is not None else lambda df, name: df
    versions = step(with_range_slots(versions, key, "start_date", hot), "versions")

    linked = _linked(versions, key, tracked, hot)
    unchanged = reduce(
        lambda a, b: a & b, [F.col(f"_before.{c}").eqNullSafe(F.col(c)) for c in tracked]
    )
    reaches = F.col("_before._until").isNull() | (F.col("_before._until") > F.col("start_date"))
    redundant = (F.col("_origin") == 1) & F.col("_before").isNotNull() & unchanged & reaches
    kept = step(linked.where(~redundant).drop("_before"), "kept")

    chained = neighbour(kept, key, hot, "start_date", F.col("start_date"), "_next", ahead=True)
    ended = chained.withColumn("end_date", F.least("_next", "_until"))
    rebuilt = ended.withColumn("is_active", F.col("end_date").isNull())
    return untouched.select(*columns).unionByName(rebuilt.select(*columns))


def _linked(versions: DataFrame, key: str, tracked: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Adds ``_until``, the latest end a version can have, and ``_before``, that and the content of the version before it.

    A stored version ends where it did; one of the batch at the latest with the stored interval it starts in. Both follow from what
    came before in the range of a hot key, and from what the ranges before pass on: the last stored end, and their last version.
    """
    ordered = Window.partitionBy(key, SLOT).orderBy("start_date")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(F.col("_origin") == 0, F.struct("_stored_end"))

    def until(origin: Column, own: Column, around: Column, start: Column) -> Column:
        return F.when(origin == 0, own).otherwise(F.when(around["_stored_end"] > start, around["_stored_end"]))

    linked = versions.withColumn("_around", F.last(held, ignorenulls=True).over(earlier))
    if hot is not None:
        across = Window.partitionBy(key).orderBy(SLOT)
        edges = (
            only_hot(versions, key, hot)
            .groupBy(key, SLOT)
            .agg(
                F.max_by(held, F.when(held.isNotNull(), F.col("start_date"))).alias("_held"),
                F.max_by(F.struct("_origin", "start_date", *tracked), F.col("start_date")).alias("_last"),
            )
            .withColumn("_carried", F.last("_held", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)))
        )
        last = F.col("_last")
        its_end = until(last["_origin"], F.col("_held._stored_end"), F.coalesce("_held", "_carried"), last["start_date"])
        passed = F.struct(its_end.alias("_until"), *[last[c].alias(c) for c in tracked])
        edges = edges.select(key, SLOT, "_carried", F.lag(passed).over(across).alias("_passed"))
        linked = linked.join(edges, [key, SLOT], "left").withColumn("_around", F.coalesce("_around", "_carried")).drop("_carried")
    linked = linked.withColumn("_until", until(F.col("_origin"), F.col("_stored_end"), F.col("_around"), F.col("start_date"))).drop("_around")
    before = F.lag(F.struct("_until", *tracked)).over(ordered)
    if hot is None:
        return linked.withColumn("_before", before)
    return linked.withColumn("_before", before).withColumn("_before", F.coalesce("_before", "_passed")).drop("_passed")


def new_rows(target: DataFrame, batch: DataFrame, key: str, active_only: bool = False) -> DataFrame:
    """Batch rows whose key has no (active) row in the target."""
    known = target.where(F.col("is_active")) if active_only else target
    return batch.join(known.select(key), key, "left_anti").select(*batch.columns)


def _pair(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], match_null_keys: bool = True
) -> DataFrame:
    old = target.select(
        F.lit(True).alias("_old_here"), *[F.col(c).alias(f"_old_{c}") for c in target.columns]
    )
    new = batch.select(
        F.lit(True).alias("_new_here"), *[F.col(c).alias(f"_new_{c}") for c in batch.columns]
    )
    on = [_old(k).eqNullSafe(_new(k)) if match_null_keys else _old(k) == _new(k) for k in keys]
    return old.join(new, on, "full_outer")


def _log(settled: Mapping[str, Column], log: Sequence[str]) -> list[Column]:
    """Whether a pair ends other than it was stored, and what the logged columns were then."""
    if not log:
        return []
    changed = _only_new() | reduce(or_, [~_old(c).eqNullSafe(v) for c, v in settled.items()])
    before = F.when(F.col("_old_here") & changed, F.struct(*[_old(c).alias(c) for c in log]))
    return [changed.alias("_changed"), before.alias("_before")]


def of_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], inside: bool = True) -> DataFrame:
    """Rows whose keys are (or are not) among the groups; NULL keys are equal to each other."""
    wanted = groups.select(*[F.col(k).alias(f"_group_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
    return rows.join(wanted, same, "left_semi" if inside else "left_anti")


def _old(column: str) -> Column:
    return F.col(f"_old_{column}")


def _new(column: str) -> Column:
    return F.col(f"_new_{column}")


def _both() -> Column:
    return F.col("_old_here").isNotNull() & F.col("_new_here").isNotNull()


def _only_new() -> Column:
    return F.col("_old_here").isNull()


def _differs(columns: Sequence[str], null_safe: bool) -> Column:
    tests = [
        ~_old(c).eqNullSafe(_new(c)) if null_safe else F.coalesce(_old(c) != _new(c), F.lit(False))
        for c in columns
    ]
    return reduce(or_, tests)


def _one_row_per(batch: DataFrame, key: str) -> DataFrame:
    counted = batch.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*batch.columns)).alias("_row")
    )
    message = F.concat(F.lit(f"more than one batch row for {key} "), F.col(key).cast("string"))
    return counted.where(F.assert_true(F.col("_rows") == 1, message).isNull()).select("_row.*")
