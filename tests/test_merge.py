import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tierweave.operators import merge, skew
from tierweave.operators.history import TICKET_MILESTONES, collapse_history


def day(n: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(days=n)


STATION = "sk_id BIGINT, id INT, name STRING, city STRING, is_deleted BOOLEAN"
STORED_STATIONS = [
    (1, 1, "same", "x", False),
    (2, 2, "old", "x", False),
    (3, 3, "absent", "x", False),
    (4, 4, "back", "x", True),
    (5, 5, "gains", None, False),
    (6, 6, "loses", "x", False),
]
STATION_BATCH = [
    (91, 1, "same", "x", False),
    (92, 2, "new", "x", False),
    (94, 4, "back", "x", False),
    (95, 5, "gains", "y", False),
    (96, 6, "loses", None, False),
    (97, 7, "first", "x", False),
]


def stations(spark):
    return spark.createDataFrame(STORED_STATIONS, STATION), spark.createDataFrame(STATION_BATCH, STATION)


def test_scd1_incremental_and_snapshot(spark):
    stored, batch = stations(spark)
    expected = [
        (1, 1, "same", "x", False),
        (2, 2, "new", "x", False),
        (3, 3, "absent", "x", False),
        (4, 4, "back", "x", False),
        (5, 5, "gains", "y", False),
        (6, 6, "loses", None, False),
        (97, 7, "first", "x", False),
    ]
    tracked = ["name", "city"]
    assert rows(merge.scd1_merge(stored, batch, "id", tracked)) == sorted(expected, key=repr)
    expected[2] = (3, 3, "absent", "x", True)
    once = merge.scd1_merge(stored, batch, "id", tracked, full_snapshot=True)
    assert rows(once) == sorted(expected, key=repr)
    assert rows(merge.scd1_merge(once, batch, "id", tracked, full_snapshot=True)) == rows(once)


def test_scd1_null_unsafe_misses_null_changes(spark):
    stored, batch = stations(spark)
    got = {r.id: r.city for r in merge.scd1_merge(stored, batch, "id", ["name", "city"], null_safe=False).collect()}
    assert got[5] is None and got[6] == "x"


def test_soft_delete_alone(spark):
    stored, batch = stations(spark)
    got = {r.id: r.is_deleted for r in merge.soft_delete(stored, batch, "id").collect()}
    assert got == {1: False, 2: False, 3: True, 4: True, 5: False, 6: False}


FACT = "k INT, d STRING, amount INT, updated_at TIMESTAMP"


def test_upsert_moves_audit_column_only_with_a_change(spark):
    stored = spark.createDataFrame([(1, "a", 5, day(0)), (2, "b", 5, day(0)), (None, "n", 1, day(0))], FACT)
    batch = spark.createDataFrame([(1, "a", 5, day(9)), (2, "b", 6, day(9)), (3, "c", 1, day(9)), (None, "n", 1, day(9))], FACT)
    got = merge.upsert(stored, batch, ["k", "d"], ["amount"])
    assert rows(got) == sorted(
        [(1, "a", 5, day(0)), (2, "b", 6, day(9)), (3, "c", 1, day(9)), (None, "n", 1, day(0))], key=repr
    )
    assert rows(merge.upsert(got, batch, ["k", "d"], ["amount"])) == rows(got)
    plain = merge.upsert(stored, batch, ["k", "d"], ["amount"], match_null_keys=False)
    assert rows(plain).count((None, "n", 1, day(0))) == 1 and rows(plain).count((None, "n", 1, day(9))) == 1


def test_fold_equals_collapsing_everything(spark):
    rng = random.Random(4)
    events = [
        (str(rng.randint(1, 15)), n, day(rng.randint(0, 60)) + timedelta(minutes=n), rng.choice(["paid", "unpaid", "cancelled", "refunded"]))
        for n in range(200)
    ]
    df = spark.createDataFrame(events, "ticket_id STRING, id INT, created_at TIMESTAMP, status STRING")
    whole = collapse_history(df, "ticket_id", "created_at", "id")
    parts = [
        collapse_history(df.where(f"id % 3 = {i}"), "ticket_id", "created_at", "id") for i in (1, 0, 2)
    ]
    folded = parts[0]
    for part in parts[1:]:
        folded = merge.fold_history(folded, part, "ticket_id", "created_at", list(TICKET_MILESTONES))
    assert rows(folded) == rows(whole)


PERSON = "sk_id BIGINT, id INT, name STRING, phone STRING, is_active BOOLEAN, start_date TIMESTAMP, end_date TIMESTAMP"
TRACKED = ["name", "phone"]


def version(sk, id, name, phone, start, end=None):
    return (sk, id, name, phone, end is None, day(start), None if end is None else day(end))


STORED = [
    version(1, 1, "same", "1", 0),
    version(2, 2, "old", "1", 0),
    version(3, 3, "gains", None, 0),
    version(4, 4, "loses", "1", 0),
    version(5, 5, "absent", "1", 0),
    version(6, 6, "first", "1", 0, 5),
    version(7, 6, "second", "1", 5),
]
BATCH = [
    version(91, 1, "same", "1", 10),
    version(92, 2, "new", "1", 10),
    version(93, 3, "gains", "1", 10),
    version(94, 4, "loses", None, 10),
    version(97, 7, "born", "1", 10),
]
MERGED = [
    version(1, 1, "same", "1", 0),
    version(2, 2, "old", "1", 0, 10),
    version(92, 2, "new", "1", 10),
    version(3, 3, "gains", None, 0, 10),
    version(93, 3, "gains", "1", 10),
    version(4, 4, "loses", "1", 0, 10),
    version(94, 4, "loses", None, 10),
    version(5, 5, "absent", "1", 0),
    version(6, 6, "first", "1", 0, 5),
    version(7, 6, "second", "1", 5),
    version(97, 7, "born", "1", 10),
]


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_scd2_single_versions(spark, hot_rows):
    stored, batch = spark.createDataFrame(STORED, PERSON), spark.createDataFrame(BATCH, PERSON)
    chained = merge.scd2_merge(stored, batch, "id", TRACKED, hot_rows)
    assert rows(chained) == sorted(MERGED, key=repr)
    assert rows(merge.scd2_merge(chained, batch, "id", TRACKED, hot_rows)) == sorted(MERGED, key=repr)
    stepped = merge.scd2_expire_and_open(stored, batch, "id", TRACKED)
    assert rows(stepped) == sorted(MERGED, key=repr)
    assert rows(merge.scd2_expire_and_open(stepped, batch, "id", TRACKED)) == sorted(MERGED, key=repr)


def test_scd2_null_unsafe_keeps_the_old_version(spark):
    stored, batch = spark.createDataFrame(STORED, PERSON), spark.createDataFrame(BATCH, PERSON)
    got = merge.scd2_expire_and_open(stored, batch, "id", TRACKED, null_safe=False)
    assert rows(got.where("id IN (3, 4)")) == sorted([STORED[2], STORED[3]], key=repr)


def test_scd2_late_and_several_versions(spark):
    stored = spark.createDataFrame([version(6, 6, "first", "1", 0, 5), version(7, 6, "second", "1", 5)], PERSON)
    batch = spark.createDataFrame(
        [
            version(20, 6, "late", "1", 2),
            version(21, 6, "third", "1", 8),
            version(22, 6, "third", "1", 9),
            version(23, 6, "fourth", "1", 12),
            version(24, 8, "x", "1", 3),
            version(25, 8, "y", "1", 4),
        ],
        PERSON,
    )
    assert rows(merge.scd2_merge(stored, batch, "id", TRACKED)) == sorted(
        [
            version(6, 6, "first", "1", 0, 2),
            version(20, 6, "late", "1", 2, 5),
            version(7, 6, "second", "1", 5, 8),
            version(21, 6, "third", "1", 8, 12),
            version(23, 6, "fourth", "1", 12),
            version(24, 8, "x", "1", 3, 4),
            version(25, 8, "y", "1", 4),
        ],
        key=repr,
    )


def test_scd2_two_step_refuses_two_versions_of_a_key(spark):
    stored = spark.createDataFrame(STORED, PERSON)
    batch = spark.createDataFrame([version(20, 8, "x", "1", 2), version(21, 8, "y", "1", 3)], PERSON)
    with pytest.raises(PySparkException, match="more than one batch row for id 8"):
        merge.scd2_expire_and_open(stored, batch, "id", TRACKED).collect()


def _chain(stored, batch):
    """Plain-Python reading of the chain rule."""
    out = []
    far = datetime.max
    touched = {r[1] for r in batch}
    out += [r for r in stored if r[1] not in touched]
    for key in touched:
        ends = {r[5]: r[6] or far for r in stored if r[1] == key}
        by_start = {r[5]: r for r in stored if r[1] == key}
        by_start |= {r[5]: r for r in sorted((r for r in batch if r[1] == key), key=repr)}
        kept = []
        for start in sorted(by_start):
            # Until when a version that starts here is in force, if no other follows.
            inside = [e for s, e in ends.items() if s <= start < e]
            until = ends.get(start) or (max(inside) if inside else far)
            in_force = kept and kept[-1][0][2:4] == by_start[start][2:4] and kept[-1][1] > start
            if start in ends or not in_force:
                kept.append((by_start[start], until))
        for (row, until), following in zip(kept, [*kept[1:], None]):
            end = min(until, following[0][5] if following else far)
            end = None if end == far else end
            out.append((*row[:4], end is None, row[5], end))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("hot_rows", [1, 12, 10**9])
def test_scd2_matches_plain_python_on_random_loads(spark, seed, hot_rows):
    rng = random.Random(seed)
    sk, stored = 0, []
    for load in range(2):
        batch, used = [], set()
        for _ in range(60):
            id, start = rng.choice([1, 1, 1, 2, 3, 4]), rng.randint(-30, 30)
            if (id, start) in used:
                continue
            used.add((id, start))
            sk += 1
            batch.append(version(sk, id, rng.choice("ab"), rng.choice(["1", None]), start))
        before = spark.createDataFrame(stored, PERSON)
        got = merge.scd2_merge(before, spark.createDataFrame(batch, PERSON), "id", TRACKED, hot_rows)
        expected = _chain(stored, batch)
        assert rows(got) == expected
        stored = expected
        if load == 0:
            # Every third version is closed early, so that the next load meets gaps.
            stored = [r if i % 3 else close(r) for i, r in enumerate(stored)]
    active = [r[1] for r in stored if r[4]]
    assert len(active) == len(set(active))


def close(row):
    end = row[5] + (((row[6] or row[5] + timedelta(days=8)) - row[5]) / 2)
    return (*row[:4], False, row[5], end)


def test_scd2_gap_keeps_what_starts_after_it(spark):
    stored = spark.createDataFrame([version(6, 6, "a", "1", 0, 5)], PERSON)
    both = [version(20, 6, "a", "1", 3), version(21, 6, "a", "1", 7)]
    got = merge.scd2_merge(stored, spark.createDataFrame(both, PERSON), "id", TRACKED)
    assert rows(got) == sorted([version(6, 6, "a", "1", 0, 5), version(21, 6, "a", "1", 7)], key=repr)
    late = spark.createDataFrame([version(22, 6, "b", "1", 3)], PERSON)
    got = merge.scd2_merge(stored, late, "id", TRACKED)
    assert rows(got) == sorted([version(6, 6, "a", "1", 0, 3), version(22, 6, "b", "1", 3, 5)], key=repr)


def test_new_rows_only(spark):
    stored, batch = spark.createDataFrame(STORED, PERSON), spark.createDataFrame(BATCH, PERSON)
    assert rows(merge.new_rows(stored, batch, "id"), "id") == [(7,)]
    closed = spark.createDataFrame([version(6, 2, "first", "1", 0, 5)], PERSON)
    assert rows(merge.new_rows(closed, batch, "id", active_only=True), "id") == [(1,), (2,), (3,), (4,), (7,)]


@pytest.mark.parametrize("staged", [False, True])
def test_scd2_chain_of_one_key_within_one_day(spark, staged, tmp_path):
    """Ranges split a day: the chain is that of plain windows, and no task gets much more than the rows of a range."""
    at = F.expr("timestamp'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id * 10)")
    content = F.concat(F.lit("n"), F.floor(F.col("id") / 3).cast("string"))
    rest = [F.lit(True).alias("is_active"), at.alias("start_date"), F.lit(None).cast("timestamp").alias("end_date")]
    batch = spark.range(4000).select(F.col("id").cast("int").alias("sk_id"), F.lit(1).alias("id"), content.alias("name"), F.lit(None).cast("string").alias("phone"), *rest)
    batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(PERSON)])
    stored = spark.createDataFrame([], PERSON)
    calls = []

    def stage(df, name):
        calls.append(name)
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    got = merge.scd2_merge(stored, batch, "id", TRACKED, hot_rows=100, stage=stage if staged else None)
    assert rows(got) == rows(merge.scd2_merge(stored, batch, "id", TRACKED)) and got.count() == 1334
    assert calls == (["hot_keys", "versions", "kept"] if staged else [])
    hot = skew.hot_ranges(batch.select("id", "start_date"), 100)
    slots = skew.with_range_slots(batch, "id", "start_date", hot).groupBy(skew.SLOT).count().collect()
    assert len(slots) == 40 and max(r["count"] for r in slots) <= 200


def test_range_slots_of_equal_and_missing_times(spark):
    df = spark.createDataFrame([(1, None)] * 5 + [(1, day(1))] * 30 + [(1, day(2))] * 5 + [(2, day(1))] + [(None, day(1))] * 50, "k INT, t TIMESTAMP")
    hot = skew.hot_ranges(df, 10)
    assert rows(hot, "k") == [(1,)]
    slots = skew.with_range_slots(df, "k", "t", hot).groupBy("k", skew.SLOT).count().collect()
    assert {(r.k, r[skew.SLOT]) for r in slots if r.k != 1} == {(2, None), (None, None)}
    assert sum(r["count"] for r in slots if r.k == 1) == 40 and len([r for r in slots if r.k == 1]) >= 2
    nothing = skew.hot_ranges(df.where("k = 2"), 10)
    assert nothing.isEmpty() and rows(skew.hot_ranges(spark.createDataFrame([(3, None)] * 20, "k INT, t TIMESTAMP"), 10)) == [(3, [])]
