import shutil
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierweave.operators import merge, quality, rollups
from tierweave.plans import suites
from tierweave.plans.tables import SOURCE, SPECS
from tierweave.plans.warehouse import Warehouse, source_from
from tierweave.sources.incremental import DateWindow
from tierweave.sources.layout import Layout, TableSpec
from tierweave.sources.readers import read_dependencies
from tierweave.sources.store import PublishConflict, TableStore, folders_of

JAN = DateWindow("2024-01-01", "2024-02-01")
FEB = DateWindow("2024-02-01", "2024-03-01")
ALL = DateWindow("2024-01-01", "2024-03-01")
T0 = "2024-01-01T00:00:00Z"
FEB1 = "2024-02-01T00:00:00Z"


def ticket(n, ticket_id, status, created, price="100.00", discount=None, method="credit_card", extra=None, cls="Regular", route=1, passenger=1):
    return (
        n, ticket_id, route, passenger, route, None if discount is None else Decimal(discount), Decimal(price), cls, "A1", status,
        "2024-02-20T10:00:00Z", extra, (method, None, None), ["meal"], created,
    )


TICKETS = [
    ticket(1, "TKT-1", "paid", "2024-01-05T09:00:00Z", discount="0.10"),
    ticket(2, "TKT-2", "unpaid", "2024-01-06T09:00:00Z", method="direct"),
    ticket(3, "TKT-2", "refunded", "2024-02-02T09:00:00Z", method="direct"),
    ticket(4, " tkt-3 ", "Paid", "2024-01-07T09:00:00Z", extra=(True, 3, "P", "web"), cls=" VIP", passenger=2),
    ticket(5, "TKT-3", "cancelled", "2024-02-03T09:00:00Z", extra=(True, 3, "P", "web"), cls="VIP", passenger=2),
    ticket(6, "TKT-4", "paid", "2024-02-04T09:00:00Z", price="33.35", discount="0.15", route=2),
]


def frames(spark, february: bool):
    """Source collections; in February one passenger changed and one station is gone."""
    people = [(1, "Ann ", "Female", "0811111111", "Ann@Example.com", T0, T0), (2, "Budi", None, "0822222222", None, T0, T0)]
    if february:
        people.append((2, "Budi", None, "0833333333", None, T0, FEB1))
    stations = [(i, f"Station {i}", None if i == 1 else "Bandung", f"ST{i}", T0, T0) for i in (1, 2, 3)]
    trains = [(i, f"Train {i}", "Economy", 50, T0, T0) for i in (1, 2)]
    routes = [(1, "st1", "ST2 ", 1, 120, 90, T0, T0), (2, "ST2", "st3", 2, 200, 120, T0, T0)]
    data = {"passengers": people, "stations": stations, "trains": trains, "routes": routes, "tickets": TICKETS}
    return {name: spark.createDataFrame(given, SOURCE[name]) for name, given in data.items()}


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def table(store, layer, name):
    return store.read(SPECS[layer, name])


def run_all(warehouse, window, gold=None):
    warehouse.run_stage("bronze", window)
    warehouse.run_stage("silver", window)
    warehouse.run_stage("gold", window, gold)


def test_folding_and_rebuilding_agree(spark, tmp_path):
    made = []
    for rebuild in (False, True):
        store = TableStore(spark, str(tmp_path / str(rebuild)))
        warehouse = Warehouse(store, source_from(frames(spark, False)), rebuild_history=rebuild)
        for window in (JAN, FEB):
            warehouse.run_table("bronze", "tickets", window, check=False)
            warehouse.run_table("silver", "tickets", window, check=False)
        made.append(rows(table(store, "silver", "tickets")))
    assert made[0] == made[1] and len(made[0]) == 4
    first = table(store, "silver", "tickets").selectExpr("ticket_id", "string(first_created_at)", "string(created_at)")
    assert rows(first)[1:3] == [("tkt-2", "2024-01-06 09:00:00", "2024-02-02 09:00:00"), ("tkt-3", "2024-01-07 09:00:00", "2024-02-03 09:00:00")]


def test_two_months_through_all_layers(spark, store):
    warehouse = Warehouse(store, source_from(frames(spark, False)))
    warehouse.bootstrap()
    warehouse.bootstrap()
    assert table(store, "silver", "status").count() == 4
    run_all(warehouse, JAN, ["cancellation_summary", "revenue_daily", "train_performance"])
    with pytest.raises(quality.QualityError, match="table is not empty"):
        warehouse.run_table("gold", "refund_loss", JAN)
    assert rows(table(store, "silver", "tickets"), "ticket_id", "active_status_id") == [("tkt-1", 1), ("tkt-2", 2), ("tkt-3", 1)]

    warehouse.source = source_from(frames(spark, True))
    run_all(warehouse, FEB)
    at = datetime
    facts = table(store, "silver", "tickets")
    assert rows(facts, "ticket_id", "active_status_id", "class_id", "payment_id", "paid_at", "cancelled_at", "refunded_at", "created_at") == [
        ("tkt-1", 1, 3, 1, at(2024, 1, 5, 9), None, None, at(2024, 1, 5, 9)),
        ("tkt-2", 4, 3, None, None, None, at(2024, 2, 2, 9), at(2024, 2, 2, 9)),
        ("tkt-3", 3, 1, 1, at(2024, 1, 7, 9), at(2024, 2, 3, 9), None, at(2024, 2, 3, 9)),
        ("tkt-4", 1, 3, 1, at(2024, 2, 4, 9), None, None, at(2024, 2, 4, 9)),
    ]
    assert rows(facts, "ticket_id", "final_price", "family_flag", "has_child", "has_promo", "day_of_week", "is_weekend", "booking_lead_days")[2:] == [
        ("tkt-3", Decimal("100.00"), True, True, True, 3, False, 17),
        ("tkt-4", Decimal("28.35"), False, False, False, 3, False, 16),
    ]
    people = table(store, "silver", "passengers")
    assert rows(people, "id", "phone", "gender", "is_active", "start_date", "end_date") == [
        (1, "0811111111", "female", True, at(2024, 1, 1), None),
        (2, "0822222222", "unknown", False, at(2024, 1, 1), at(2024, 2, 1)),
        (2, "0833333333", "unknown", True, at(2024, 2, 1), None),
    ]
    current = {r.sk_id for r in people.where("is_active").collect()}
    assert {r.passenger_sk_id for r in facts.where("ticket_id IN ('tkt-3', 'tkt-4')").collect()} <= current
    revenue = table(store, "gold", "revenue_daily")
    assert rows(revenue.selectExpr("string(revenue_date)", "total_tickets", "net_revenue", "refunded_revenue")) == [
        ("2024-01-05", 1, Decimal("90.00"), Decimal("0.00")),
        ("2024-01-07", 1, Decimal("100.00"), Decimal("0.00")),
        ("2024-02-04", 1, Decimal("28.35"), Decimal("0.00")),
    ]

    booked = table(store, "gold", "cancellation_summary")
    assert booked.agg(F.sum("total_tickets_created")).first()[0] == facts.count()
    assert rows(booked.selectExpr("string(booking_date)", "total_tickets_created")) == [
        ("2024-01-05", 1), ("2024-02-02", 1), ("2024-02-03", 1), ("2024-02-04", 1),
    ]

    before = {name: rows(table(store, "silver", name)) for name in ("passengers", "trains", "stations", "routes", "tickets")}
    gold = {name: rows(table(store, "gold", name).drop("updated_at")) for layer, name in SPECS if layer == "gold"}
    stamps = rows(revenue)
    warehouse.run_stage("silver", FEB)
    warehouse.run_stage("gold", FEB)
    for name, kept in before.items():
        assert rows(table(store, "silver", name)) == kept, name
    for name, kept in gold.items():
        assert rows(table(store, "gold", name).drop("updated_at")) == kept, name
    assert rows(table(store, "gold", "revenue_daily")) == stamps
    assert not store.exists(f"{store.root}/_staging/silver_tickets")


def test_snapshot_deletes_absent_stations_and_increment_does_not(spark, store):
    given = frames(spark, False)
    warehouse = Warehouse(store, source_from(given))
    warehouse.run_table("bronze", "stations", JAN)
    warehouse.run_table("silver", "stations", JAN)
    given["stations"] = given["stations"].where("_id < 3").withColumn("updated_at", F.lit(FEB1))
    warehouse.run_table("bronze", "stations", FEB)
    warehouse.run_table("silver", "stations", FEB)
    assert rows(table(store, "silver", "stations").where("is_deleted"), "id") == []
    Warehouse(store, full_snapshot=True).run_table("silver", "stations", FEB)
    assert rows(table(store, "silver", "stations").where("is_deleted"), "id") == [(3,)]


def files_of(store, layer, name):
    folder = Path(store.path(SPECS[layer, name]))
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_failed_check_leaves_the_table_byte_identical(spark, store):
    given = frames(spark, False)
    warehouse = Warehouse(store, source_from(given))
    warehouse.run_table("bronze", "trains", JAN)
    warehouse.run_table("silver", "trains", JAN)
    before = files_of(store, "silver", "trains")
    given["trains"] = given["trains"].withColumn("capacity", F.lit(9999)).withColumn("updated_at", F.lit(FEB1))
    warehouse.run_table("bronze", "trains", FEB)
    with pytest.raises(quality.QualityError, match="max capacity <= 2000: 2 of 2"):
        warehouse.run_table("silver", "trains", FEB)
    assert files_of(store, "silver", "trains") == before
    assert not store.exists(store.staging(SPECS["silver", "trains"]))
    report = warehouse.run_table("silver", "trains", FEB, rules=[quality.not_empty()])
    assert [r.rule for r in report] == ["table is not empty"]
    assert rows(table(store, "silver", "trains").where("is_active"), "capacity") == [(9999,), (9999,)]


def parts_of(store, layer, name):
    return {p.partition: p.folder for p in store.snapshot(SPECS[layer, name]).parts}


def test_gold_rewrites_only_months_that_changed(spark, store):
    warehouse = Warehouse(store, source_from(frames(spark, False)))
    warehouse.bootstrap()
    run_all(warehouse, JAN, ["revenue_daily"])
    before = parts_of(store, "gold", "revenue_daily")
    run_all(warehouse, FEB, ["revenue_daily"])
    after = parts_of(store, "gold", "revenue_daily")
    assert set(before) == {"revenue_date_month=2024-01-01"} and before.items() <= after.items()
    assert set(after) == {"revenue_date_month=2024-01-01", "revenue_date_month=2024-02-01"}


def test_transform_with_wrong_schema_is_refused(spark, store, monkeypatch):
    warehouse = Warehouse(store, source_from(frames(spark, False)))
    plain = warehouse._transform
    for change in (lambda df: df.withColumn("capacity", F.col("capacity").cast("double")), lambda df: df.withColumn("extra", F.lit(1))):
        monkeypatch.setattr(warehouse, "_transform", lambda spec, batch: change(plain(spec, batch)))
        with pytest.raises(quality.QualityError, match="declared"):
            warehouse.run_table("bronze", "trains", JAN)


def test_empty_window_runs_nothing(spark, store):
    warehouse = Warehouse(store, source_from(frames(spark, False)))
    assert warehouse.run_table("bronze", "trains", FEB) is None
    assert warehouse.run_table("silver", "trains", FEB) is None
    assert not store.exists(store.path(SPECS["bronze", "trains"]))


SPEC = TableSpec(
    "moves",
    "silver",
    "fact",
    ("ticket_id",),
    "ticket_id STRING, created_at TIMESTAMP, v INT",
    layout=Layout(by_month="created_at", order=("ticket_id",)),
)


def moves(spark, *data):
    return spark.createDataFrame(list(data), SPEC.ddl)


def merged(store, batch):
    """Publish a batch that replaces the stored rows of its keys."""
    affected = store.affected_partitions(SPEC, batch)
    kept = store.read_partitions(SPEC, affected).join(batch, "ticket_id", "left_anti").unionByName(batch)
    written = store.write(SPEC, kept)
    store.publish(SPEC, written, folders_of(SPEC, affected))
    return affected, written


def test_emptied_partition_disappears(spark, store):
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    store.replace(SPEC, moves(spark, ("x", a, 1), ("y", b, 1), ("n", None, 1)))
    affected, written = merged(store, moves(spark, ("x", b, 2), ("n", b, 2)))
    assert len(affected) == 3 and sum(p.rows for p in written.parts) == 3
    assert rows(store.read(SPEC)) == [("n", b, 2), ("x", b, 2), ("y", b, 1)]
    assert [p.partition for p in store.snapshot(SPEC).parts] == ["created_at_month=2024-02-01"]


@pytest.mark.parametrize("step", ["write", "_parts", "_add_snapshot"])
def test_a_run_that_dies_leaves_the_old_snapshot(spark, store, monkeypatch, step):
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    store.replace(SPEC, moves(spark, ("x", a, 1)))
    monkeypatch.setattr(store, step, lambda *_, **__: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        merged(store, moves(spark, ("x", b, 2)))
    monkeypatch.undo()
    assert rows(store.read(SPEC)) == [("x", a, 1)] and store.version(SPEC) == 1
    merged(store, moves(spark, ("x", b, 3)))
    assert rows(store.read(SPEC)) == [("x", b, 3)]
    # What the dead run had written is in no snapshot, and goes.
    stored = {p.name for p in Path(store.path(SPEC)).glob("_write=*")}
    store.vacuum(SPEC)
    named = {p.folder.split("/")[0] for v in store.versions(SPEC) for p in store.snapshot(SPEC, v).parts}
    assert {p.name for p in Path(store.path(SPEC)).glob("_write=*")} == named <= stored
    assert len(stored) == 2 + (step != "write")


def test_a_draft_of_a_snapshot_is_no_snapshot(spark, store, monkeypatch):
    store.replace(SPEC, moves(spark, ("x", datetime(2024, 1, 5), 1)))
    (Path(store.path(SPEC)) / "_snapshots" / "_00000002.json.dead").write_text('{"half')
    assert store.versions(SPEC) == [1] and store.read(SPEC).count() == 1


def test_readers_keep_their_snapshot(spark, store):
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    store.replace(SPEC, moves(spark, ("x", a, 1), ("y", b, 1)))
    reader = store.read(SPEC)
    merged(store, moves(spark, ("x", b, 2)))
    store.truncate(SPEC)
    assert rows(reader) == [("x", a, 1), ("y", b, 1)]
    assert rows(store.read(SPEC, version=2)) == [("x", b, 2), ("y", b, 1)] and store.read(SPEC).isEmpty()


def test_second_writer_of_a_snapshot_fails(spark, store, monkeypatch):
    a = datetime(2024, 1, 5)
    first, second = store.write(SPEC, moves(spark, ("x", a, 1))), store.write(SPEC, moves(spark, ("y", a, 1)))
    store.publish(SPEC, first, None)
    with pytest.raises(PublishConflict):
        store.publish(SPEC, second, None)
    # Both saw the same newest snapshot, and the other one was faster.
    third = store.write(SPEC, moves(spark, ("z", a, 1)))
    stale = store.snapshot(SPEC)
    store.append(SPEC, moves(spark, ("w", a, 1)))
    monkeypatch.setattr(store, "snapshot", lambda *_: stale)
    with pytest.raises(PublishConflict):
        store.publish(SPEC, third, ())
    monkeypatch.undo()
    assert rows(store.read(SPEC), "ticket_id") == [("w",), ("x",)]


def test_only_kept_snapshots_stay(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), kept_snapshots=2)
    for i in range(5):
        store.replace(SPEC, moves(spark, ("x", datetime(2024, 1, 5), i)))
    assert store.versions(SPEC) == [4, 5] and len(list(Path(store.path(SPEC)).glob("_write=*"))) == 2
    assert rows(store.read(SPEC, version=4), "v") == [(3,)] and rows(store.read(SPEC), "v") == [(4,)]


def test_affected_partitions_are_pruned(spark, store):
    days = [(f"t{i}", datetime(2024, 1 + i % 6, 3), i) for i in range(60)]
    store.replace(SPEC, moves(spark, *days))
    affected = store.affected_partitions(SPEC, moves(spark, ("t1", datetime(2024, 2, 9), 9)))
    files = store.read_partitions(SPEC, affected).inputFiles()
    assert len(affected) == 1 and files and all("created_at_month=2024-02-01" in f for f in files)
    plan = store.read(SPEC, with_partitions=True).where("created_at_month = DATE'2024-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_at_month" in plan


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("layout", [SPEC.layout, Layout(), Layout(bucket="ticket_id", buckets=3)])
def test_write_modes(spark, store, mode, layout):
    spec = replace(SPEC, layout=layout)
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        store.replace(spec, moves(spark, ("x", a, 1), ("y", b, 1), ("n", None, 1)))
        store.replace(spec, moves(spark, ("x", a, 1), ("y", b, 1)))
        store.append(spec, moves(spark, ("z", a, 1)))
        assert rows(store.read(spec)) == [("x", a, 1), ("y", b, 1), ("z", a, 1)]
        if layout == SPEC.layout:
            store.replace_partitions(spec, moves(spark, ("w", a, 2)))
            assert rows(store.read(spec)) == [("w", a, 2), ("y", b, 1)]
        store.stage(spec, moves(spark, ("s", a, 1)), "batch")
        assert rows(store.stage(spec, moves(spark, ("t", b, 1)), "batch"), "ticket_id") == [("t",)]
        store.truncate(spec)
        assert store.read(spec).isEmpty() and store.read(spec).columns == ["ticket_id", "created_at", "v"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


# --- change log and summaries ------------------------------------------------------------------------

LOGGED = replace(SPEC, indexed=("created_at",), log=("created_at", "v"))


def folded(store, batch):
    affected = store.affected_partitions(LOGGED, batch)
    result = merge.upsert(store.read_partitions(LOGGED, affected), batch, ["ticket_id"], log=LOGGED.log)
    return store.publish(LOGGED, store.write(LOGGED, result), folders_of(LOGGED, affected), whole=True)


def test_changes_are_told_with_what_was_before(spark, store):
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    folded(store, moves(spark, ("x", a, 1), ("y", b, 1), ("n", None, None)))
    folded(store, moves(spark, ("x", b, 2), ("n", None, None)))
    folded(store, moves(spark, ("x", b, 3), ("z", a, 0)))
    told = lambda since: sorted(((r.ticket_id, r.v, r._before and tuple(r._before)) for r in store.changes(LOGGED, since).collect()), key=repr)
    assert told(1) == [("x", 2, (a, 1)), ("x", 3, (b, 2)), ("z", 0, None)]
    assert told(2) == [("x", 3, (b, 2)), ("z", 0, None)] and told(3) == []
    assert store.changes(LOGGED, 0) is None
    assert rows(store.read(LOGGED)) == [("n", None, None), ("x", b, 3), ("y", b, 1), ("z", a, 0)]
    store.replace(LOGGED, moves(spark, ("q", a, 1)))
    assert store.changes(LOGGED, 3) is None


def test_parts_know_their_days(spark, store):
    folded(store, moves(spark, ("x", datetime(2024, 1, 5, 23), 1), ("y", datetime(2024, 1, 9), 1), ("n", None, 1)))
    null, january = sorted(store.snapshot(LOGGED).parts, key=lambda p: p.rows)
    assert january.days == {"created_at": ("2024-01-05", "2024-01-09", 0)} and null.days == {"created_at": (None, None, 1)}
    assert january.may_hold("created_at", ["2024-01-09"]) and not january.may_hold("created_at", [None, "2024-01-04", "2024-01-10"])
    assert null.may_hold("created_at", [None]) and not null.may_hold("created_at", ["2024-01-05"]) and null.may_hold("v", ["x"])


MONTHS = [DateWindow(f"2024-{m:02}-01", f"2024-{m + 1:02}-01") for m in range(1, 5)]


def life_of_tickets(n):
    """Tickets booked in one month whose later events fall in others: pay, cancel, refund, or change only their price."""
    for i in range(n):
        booked, step = 1 + i % 3, 1 + i % 2
        when = lambda k: f"2024-{min(booked + k * step, 4):02}-{1 + (i * 7 + k) % 27:02}T0{i % 9}:30:00Z"
        states = [["paid"], ["unpaid", "paid"], ["paid", "cancelled"], ["paid", "cancelled", "refunded"], ["unpaid", "unpaid"], ["paid", "paid"]][i % 6]
        for k, status in enumerate(states):
            more = {"price": f"{100 + i + k}.00", "route": 1 + i % 2, "passenger": 1 + i % 2, "cls": ("VIP", "Regular", None)[i % 3]}
            yield ticket(10 * i + k, f"T{i}", status, when(k), **more)


def summaries(store):
    return {name: rows(table(store, "gold", name).drop("updated_at")) for layer, name in SPECS if layer == "gold"}


def test_summaries_follow_the_change_log(spark, tmp_path):
    """After every window each summary equals one made from the whole fact, in a store that has no summary yet."""
    given = frames(spark, False)
    given["tickets"] = spark.createDataFrame(list(life_of_tickets(120)), SOURCE["tickets"])
    store = TableStore(spark, str(tmp_path / "a"))
    warehouse = Warehouse(store, source_from(given))
    warehouse.bootstrap()
    scans = []
    for window in MONTHS:
        for layer in ("bronze", "silver"):
            warehouse.run_stage(layer, window, check=False)
        taken = []
        plain = store.changes
        store.changes = lambda spec, since: taken.append(plain(spec, since)) or taken[-1]
        warehouse.run_stage("gold", window, check=False)
        store.changes = plain
        scans.append([c is None for c in taken])
        fact, trains = table(store, "silver", "tickets"), table(store, "silver", "trains")
        whole = {
            "cancellation_summary": rollups.cancellation_summary(fact), "refund_loss": rollups.refund_loss(fact),
            "revenue_daily": rollups.revenue_daily(fact), "train_performance": rollups.train_performance(fact, trains),
        }
        for name, made in whole.items():
            assert rows(table(store, "gold", name).drop("updated_at")) == rows(made.drop("updated_at").select(*table(store, "gold", name).drop("updated_at").columns)), (window, name)
    assert scans[0] == [True] * 4 and all(s == [False] * 4 for s in scans[1:])
    kept = summaries(store)
    versions = [store.version(SPECS["gold", n]) for n in kept]
    assert warehouse.run_stage("gold", MONTHS[-1]) == dict.fromkeys(kept)
    warehouse.run_table("silver", "tickets", MONTHS[-1], check=False)
    assert warehouse.run_stage("gold", MONTHS[-1]) == dict.fromkeys(kept)
    assert summaries(store) == kept and [store.version(SPECS["gold", n]) for n in kept] == versions


def test_files_without_a_touched_day_are_not_read(spark, store):
    """The files of all other days are taken away before the summaries run, and nobody misses them."""
    given = frames(spark, False)
    events = [ticket(n, f"T{n}", "paid", f"2024-{1 + n % 3:02}-05T09:00:00Z", passenger=1 + n % 2) for n in range(60)]
    events.append(ticket(900, "T2", "cancelled", "2024-04-02T09:00:00Z"))
    given["tickets"] = spark.createDataFrame(events, SOURCE["tickets"])
    warehouse = Warehouse(store, source_from(given))
    warehouse.bootstrap()
    run = lambda window: [warehouse.run_stage(layer, window, check=False) for layer in ("bronze", "silver")]
    for window in MONTHS[:3]:
        run(window)
    warehouse.run_stage("gold", MONTHS[2], ["cancellation_summary", "revenue_daily"], check=False)
    run(MONTHS[3])
    spec = SPECS["silver", "tickets"]
    needed = [p for p in store.snapshot(spec).parts if p.may_hold("paid_at", ["2024-03-05"]) or p.may_hold("created_at", ["2024-03-05", "2024-04-02"])]
    hidden = [Path(store.path(spec)) / p.folder for p in store.snapshot(spec).parts if p not in needed]
    assert len(hidden) >= 2 and needed
    for folder in hidden:
        shutil.rmtree(folder)
    warehouse.run_stage("gold", MONTHS[3], ["cancellation_summary", "revenue_daily"], check=False)
    booked = table(store, "gold", "cancellation_summary")
    assert booked.agg(F.sum("total_tickets_created"), F.sum("total_tickets_cancelled")).first() == (60, 1)
    assert table(store, "gold", "revenue_daily").agg(F.sum("total_tickets")).first() == (60,)


def test_renamed_train_reaches_its_summary(spark, store):
    given = frames(spark, False)
    warehouse = Warehouse(store, source_from(given))
    warehouse.bootstrap()
    run_all(warehouse, ALL, ["train_performance"])
    before = rows(table(store, "gold", "train_performance"), "train_sk_id", "departure_date", "name", "capacity")
    spec = SPECS["silver", "trains"]
    renamed = store.read(spec).withColumn("name", F.when(F.col("id") == 1, "night train").otherwise(F.col("name")))
    store.replace(spec, renamed)
    warehouse.run_table("gold", "train_performance", ALL, check=False)
    after = rows(table(store, "gold", "train_performance"), "train_sk_id", "departure_date", "name", "capacity")
    first = store.read(spec).where("id = 1").first().sk_id
    assert before != after and [(*r[:2], "night train", r[3]) if r[0] == first else r for r in before] == after


def test_reports_from_states_equal_full_evaluations(spark, store):
    """After two windows, with some partitions written unchecked, and for an empty table."""
    warehouse = Warehouse(store, source_from(frames(spark, True)))
    warehouse.bootstrap()
    for window, check in ((JAN, True), (FEB, False)):
        for layer in ("bronze", "silver"):
            warehouse.run_stage(layer, window, check=check)
        warehouse.run_stage("gold", window, ["cancellation_summary", "revenue_daily", "train_performance"], check=check)
    kept = 0
    for (layer, name), spec in SPECS.items():
        if spec.kind == "lookup":
            continue
        rules = quality.by_parts(suites.SUITES[layer, name]())
        full = {r.rule: tuple(r) for r in quality.evaluate(store.read(spec), rules).collect()} if rules else {}
        assert {r.rule: tuple(r) for r in warehouse.table_report(layer, name)} == full, name
        kept += sum(bool(p.states) for p in store.snapshot(spec).parts)
    assert kept >= 15


# --- bucketed dimensions -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["passengers", "stations"])
def test_a_merge_touches_only_the_buckets_of_its_batch(spark, store, name):
    """Files of other buckets keep their bytes, and are not even read: without them the merge runs all the same."""
    given = frames(spark, False)
    if name == "passengers":
        raw = [(i, f"P{i}", "Male", "0811111111", None, T0, T0) for i in range(1, 41)]
    else:
        raw = [(i, f"Station {i}", "Bandung", f"ST{i}", T0, T0) for i in range(1, 41)]
    later = [(*r[:1], "Changed", *r[2:-1], FEB1) if name == "passengers" else (*r[:1], "Changed", *r[2:4], FEB1, T0) for r in raw[:1]]
    given[name] = spark.createDataFrame(raw + later, SOURCE[name])
    warehouse = Warehouse(store, source_from(given))
    for window in (JAN, FEB):
        warehouse.run_table("bronze", name, window, check=False)
    warehouse.run_table("silver", name, JAN)
    spec = SPECS["silver", name]
    before, hidden = parts_of(store, "silver", name), []
    touched = {f"id_bucket={r.b}" for r in spark.sql(f"SELECT pmod(xxhash64(1), {spec.layout.buckets}) AS b").collect()}
    for partition, folder in before.items():
        if partition not in touched:
            hidden.append((Path(store.path(spec)) / folder, Path(store.root) / f"hidden-{partition}"))
            shutil.move(*hidden[-1])
    warehouse.run_table("silver", name, FEB)
    for there, away in hidden:
        shutil.move(away, there)
    after = parts_of(store, "silver", name)
    assert set(after) == set(before) and {p for p in after if after[p] != before[p]} == touched and len(hidden) >= 5
    changed = store.read(spec).where("name = 'changed'")
    assert rows(changed, "id") == [(1,)] and store.read(spec).count() == (41 if name == "passengers" else 40)


def test_registered_tables_follow_the_store(spark, store):
    a, b = datetime(2024, 1, 5), datetime(2024, 2, 5)
    store.replace(SPEC, moves(spark, ("x", a, 1), ("y", b, 1)))
    name = store.register(SPEC)
    assert rows(spark.sql(f"SELECT ticket_id, v FROM {name}")) == [("x", 1), ("y", 1)]
    store.replace(SPEC, moves(spark, ("z", b, 2)))
    store.register(SPEC)
    assert rows(read_dependencies(spark, [name])["moves"], "ticket_id", "v") == [("z", 2)]
    spark.sql(f"DROP TABLE {name}")


def test_files_are_ordered(spark, store):
    spec = TableSpec("sorted", "silver", "scd1", ("id",), "id BIGINT", layout=Layout(order=("id",)))
    store.replace(spec, spark.range(5000).orderBy(F.rand(1)))
    for file in Path(store.path(spec)).rglob("*.parquet"):
        ids = [r.id for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)
