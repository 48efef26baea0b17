"""What the larger jobs read and shuffle: each source once or twice, rows without what can be made again."""

import re

from pyspark.sql import functions as F

from tierweave.operators import dimensions, merge, quality
from tierweave.plans import bindings, tickets
from tierweave.plans.queries import QUERIES
from tierweave.plans.tables import RUN_ORDER, SPECS
from tierweave.plans.warehouse import Warehouse, source_from
from tierweave.sources.incremental import DateWindow
from tierweave.sources.store import TableStore

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_source_tickets_format_each_shared_time_once(spark):
    text = plan(QUERIES["bronze_cast"](spark, SMALL))
    # One format a line for its departure and key, one an event for its moment.
    assert text.count("date_format(") == 2
    below_joins = text[text.index("Join") :]
    assert "concat_ws" not in below_joins


def test_the_sweep_gets_narrow_facts(spark, monkeypatch):
    seen, plain = [], tickets.as_of_sweep
    monkeypatch.setattr(tickets, "as_of_sweep", lambda facts, *a, **b: seen.append(facts) or plain(facts, *a, **b))
    fact = tickets.ticket_fact(bindings.ticket_events(spark, SMALL), bindings.fact_dims(spark, SMALL))
    assert tuple(fact.columns) == tickets.FACT_COLUMNS
    assert not {"final_price", "day_of_week", "is_weekend", "booking_lead_days", "status", "class", "payment"} & set(seen[0].columns)


def test_a_first_load_is_joined_with_nothing(spark, tmp_path):
    spec = SPECS["silver", "tickets"]
    stored = TableStore(spark, str(tmp_path)).read(spec)
    batch = spark.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema])
    assert "Join" not in plan(merge.fold_history(stored, batch, "ticket_id", "created_at", ["paid_at"], spec.log, ["first_created_at"]))
    assert merge.upsert(stored, batch, ["ticket_id"]).count() == 3


def test_a_load_counts_its_source_once(spark, tmp_path, monkeypatch):
    passes, source = spark.sparkContext.accumulator(0), "id INT, name STRING, type STRING, capacity INT, created_at STRING, updated_at STRING"
    rows = [(i, "a", "b", 1, "2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z") for i in range(3)]
    frame = spark.createDataFrame(rows, re.sub(r"\bid\b", "_id", source))

    def marked(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    counted = frame.coalesce(1).mapInArrow(marked, frame.schema)
    store = TableStore(spark, str(tmp_path))
    report = Warehouse(store, source_from({"trains": counted})).run_table("bronze", "trains", DateWindow("2024-01-01", "2024-02-01"))
    assert [(r.checked, r.violations, r.passed) for r in report if r.kind == "row_count"] == [(3, 0, True)]
    assert passes.value == 6  # one count, one write
    assert quality.same_count(spark, 2, 3).first()["passed"] is False


def test_the_warehouse_query_runs_every_table_of_every_layer(spark, monkeypatch):
    ran = []
    monkeypatch.setattr(Warehouse, "run_table", lambda self, layer, name, window, check=True: ran.append((layer, name, check)))
    QUERIES["warehouse_revenue"](spark, SMALL)
    assert ran == [(layer, name, True) for layer in ("bronze", "silver", "gold") for name in RUN_ORDER[layer]]


def test_collapse_and_sweep_shuffle_nothing_twice(spark, monkeypatch):
    seen, plain = [], tickets.collapse_history
    monkeypatch.setattr(tickets, "collapse_history", lambda *a, **b: seen.append(plain(*a, **b)) or seen[-1])
    text = plan(tickets.ticket_fact(bindings.ticket_events(spark, SMALL), bindings.fact_dims(spark, SMALL)))
    # The tie is not carried beside the order, and the status goes as its id.
    assert not {"status", "id"} & set(seen[0].columns)
    # The passenger and the departure go as the key and the time of the sweep alone.
    row = re.search(r"struct\(([^()]*)\) AS _fact", text).group(1)
    assert "ticket_id" in row and "passenger_id" not in row and "departure_date" not in row


def test_sweep_gives_key_and_time_back(spark):
    day = "TIMESTAMP '2024-01-02'"
    facts = spark.sql(f"SELECT * FROM VALUES (1, 7, {day}), (2, 7, NULL), (3, NULL, {day}), (4, 8, {day}), (5, 7, TIMESTAMP '2023-01-01') AS t(f, k, at)")
    versions = spark.sql("SELECT * FROM VALUES (70L, 7L, TIMESTAMP '2024-01-01', CAST(NULL AS TIMESTAMP)) AS v(sk_id, id, start_date, end_date)")
    for given in (facts, facts.withColumn("at", F.col("at").cast("timestamp_ntz")), facts.drop("f")):
        for hot_rows in (1, 100):
            swept = dimensions.as_of_sweep(given, versions, "k", "id", "at", {"sk_id": "sk"}, hot_rows)
            joined = dimensions.as_of_join(given, versions, "k", "id", "at", {"sk_id": "sk"})
            assert swept.schema.simpleString() == joined.schema.simpleString()
            assert sorted(map(repr, swept.collect())) == sorted(map(repr, joined.collect()))
