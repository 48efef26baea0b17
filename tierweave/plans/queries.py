"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave.operators import cleaning, dimensions, history, merge, quality, rollups
from tierweave.plans import bindings as b
from tierweave.plans import suites
from tierweave.plans.tables import RUN_ORDER, SPECS
from tierweave.plans.tickets import ticket_fact
from tierweave.plans.warehouse import Warehouse, source_from
from tierweave.functions import money, surrogate_key
from tierweave.sources.collections import Collection
from tierweave.sources.incremental import DateWindow
from tierweave.sources.layout import Layout, TableSpec
from tierweave.sources.store import TableStore, folders_of, pin_utc, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return comparable(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Types that read the same from any engine: amounts as double, dates as text, times without zone."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ByteType):
            return column.cast("int").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


# --- rollups -----------------------------------------------------------------------------------------


@query
def revenue_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.revenue_daily(b.tickets(spark, folder)).drop("updated_at")


@query
def cancellation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.cancellation_summary(b.tickets(spark, folder)).drop("updated_at")


@query
def refund_loss(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.refund_loss(b.tickets(spark, folder)).drop("updated_at")


@query
def train_performance(spark: SparkSession, folder: str) -> DataFrame:
    tickets, trains = b.tickets(spark, folder), b.train_versions(spark, folder)
    return rollups.train_performance(tickets, trains).drop("updated_at")


@query
def revenue_by_route_week(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.revenue_by_route_week(b.tickets(spark, folder))


@query
def revenue_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.revenue_by_day(b.tickets(spark, folder))


# --- cleaning ----------------------------------------------------------------------------------------


@query
def bronze_cast(spark: SparkSession, folder: str) -> DataFrame:
    bronze = cleaning.bronze_cast(b.source_tickets(spark, folder))
    return bronze.select("id", "ticket_id", "status", "created_at", "departure_date")


@query
def normalize_passengers(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.silver_passengers(_bronze(spark, folder, "passengers")).drop("sk_id")


@query
def normalize_trains(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.silver_trains(_part_trains(spark, folder)).drop("sk_id")


def _part_trains(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as trains: one type is unknown, small parts have no capacity."""
    return b.table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.concat(F.lit(" "), F.upper("p_name")).alias("name"),
        F.when(F.col("p_type") != "SMALL", F.concat("p_type", F.lit(" "))).alias("type"),
        F.when(F.col("p_size") > 5, F.col("p_size")).alias("capacity"),
        F.lit(b.FIRST_LOAD).cast("timestamp").alias("updated_at"),
    )


@query
def normalize_stations(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.silver_stations(_bronze(spark, folder, "stations")).drop("sk_id")


@query
def normalize_routes(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.normal_routes(_bronze(spark, folder, "routes")).drop("sk_id")


@query
def ticket_derivations(spark: SparkSession, folder: str) -> DataFrame:
    return b.ticket_events(spark, folder)


@query
def surrogate_key_stats(spark: SparkSession, folder: str) -> DataFrame:
    key = surrogate_key("o_orderkey", "o_orderdate")
    return b.table(spark, folder, "orders").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("keys"),
        F.count_if(key < 0).alias("negative"),
    )


@query
def dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """One line per order."""
    lines = b.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return cleaning.one_per_key(lines, "l_orderkey")


def _bronze(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return cleaning.bronze_cast(b.sources(spark, folder)[name])


# --- incremental windows -----------------------------------------------------------------------------

WINDOW = DateWindow("2024-01-08", "2024-01-22")
ORDER_WINDOW = DateWindow("1996-03-01", "1999-09-15")


@query
def incremental_window(spark: SparkSession, folder: str) -> DataFrame:
    kept = WINDOW.apply(b.table(spark, folder, "events"), "ts")
    return kept.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("rows"))


@query
def incremental_window_text(spark: SparkSession, folder: str) -> DataFrame:
    """The window over ISO strings, main table only; the customers it is joined to are read in full."""
    orders = b.table(spark, folder, "orders").withColumn("created_at", b.iso_text("o_orderdate"))
    kept = ORDER_WINDOW.apply(orders, "created_at", text=True)
    customers = b.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    joined = kept.join(customers, kept.o_custkey == customers.c_custkey, "left")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("rows"))


@query
def incremental_window_pushed(spark: SparkSession, folder: str) -> DataFrame:
    """The same window over orders stored as documents: its bounds reach the scan of the collection."""
    landing = f"{_scratch_store(spark).root}/landing/orders"
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_custkey", b.iso_text("o_orderdate").alias("created_at"))
    orders.write.parquet(landing)
    collection = Collection("o_orderkey BIGINT, o_custkey BIGINT, created_at STRING", "created_at", landing, "parquet", bounds="text")
    kept = collection.read(spark, ORDER_WINDOW)
    customers = b.table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    joined = kept.join(customers, kept.o_custkey == customers.c_custkey, "left")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("rows"))


@query
def rescued_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as line JSON, of which urgent ones are cut off and unhurried ones have a price that is no number; both parts read back."""
    landing = f"{_scratch_store(spark).root}/landing/orders"
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    price = F.when(F.col("o_orderpriority") == "5-LOW", '"dear"').otherwise(cents)
    line = F.concat(F.lit('{"_id":'), "o_orderkey", F.lit(',"status":"'), "o_orderstatus", F.lit('","cents":'), price)
    whole = F.when(F.col("o_orderpriority") == "1-URGENT", line).otherwise(F.concat(line, F.lit(',"more":[1]}')))
    b.table(spark, folder, "orders").select(whole.alias("value")).write.text(landing)
    good, rejected = Collection("_id BIGINT, status STRING, cents BIGINT", "created_at", landing).read_rescued(spark)
    return good.select(F.lit("read").alias("part"), F.col("_id").alias("order_key"), "status", "cents", F.lit(None).cast("string").alias("document")).unionByName(
        rejected.select(F.lit("rejected").alias("part"), "document"), allowMissingColumns=True
    )


# --- histories ---------------------------------------------------------------------------------------


@query
def latest_event(spark: SparkSession, folder: str) -> DataFrame:
    events = b.status_events(spark, folder)
    return history.collapse_history(events, "ticket_id", "created_at", "id", milestones={})


@query
def event_milestones(spark: SparkSession, folder: str) -> DataFrame:
    events = b.status_events(spark, folder)
    return history.collapse_history(events, "ticket_id", "created_at", "id", first="first_created_at").select(
        "ticket_id", "status", "paid_at", "cancelled_at", "refunded_at", "first_created_at"
    )


@query
def nth_event(spark: SparkSession, folder: str) -> DataFrame:
    return history.nth_event(b.status_events(spark, folder), "ticket_id", "created_at", "id", 2)


@query
def touched_history(spark: SparkSession, folder: str) -> DataFrame:
    """All events of the tickets that have one in the window, collapsed."""
    events = b.status_events(spark, folder)
    whole = history.full_history_of(WINDOW.apply(events, "created_at"), events, "ticket_id")
    return history.collapse_history(whole, "ticket_id", "created_at", "id").drop("value")


# --- joins -------------------------------------------------------------------------------------------


@query
def route_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.enrich_routes(
        b.supplier_routes(spark, folder), b.nation_stations(spark, folder), b.train_versions(spark, folder)
    ).drop("origin", "destination", "train_id")


@query
def ticket_lookups(spark: SparkSession, folder: str) -> DataFrame:
    events, dims = b.ticket_events(spark, folder), b.fact_dims(spark, folder)
    events = events.select("ticket_id", "id", "route_id", "class", "status", "payment")
    events = dimensions.lookup(events, dims["routes"], "route_id", "id", {"sk_id": "route_sk_id"})
    events = dimensions.lookup(events, dims["class"], "class", "class_name", {"id": "class_id"}, literal=True)
    events = dimensions.lookup(events, dims["status"], "status", "status", {"id": "status_id"}, literal=True)
    return dimensions.lookup(events, dims["payment"], "payment", "method", {"id": "payment_id"}, literal=True)


def _orders_by_passenger(spark: SparkSession, folder: str) -> DataFrame:
    return b.table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("passenger_id"), "o_orderdate"
    )


@query
def asof_passenger(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.as_of_sweep(
        _orders_by_passenger(spark, folder),
        b.passenger_versions(spark, folder),
        "passenger_id",
        "id",
        "o_orderdate",
        {"sk_id": "passenger_sk_id"},
    )


@query
def asof_passenger_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The same sweep with every busy passenger treated as hot."""
    return dimensions.as_of_sweep(
        _orders_by_passenger(spark, folder),
        b.passenger_versions(spark, folder),
        "passenger_id",
        "id",
        "o_orderdate",
        {"sk_id": "passenger_sk_id"},
        hot_rows=12,
    )


@query
def asof_hot_day(spark: SparkSession, folder: str) -> DataFrame:
    """All line items as facts of one day, which every passenger's busy days hold many of: each is dealt out over parts."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", (F.col("o_custkey") + 1).alias("passenger_id"))
    lines = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.make_dt_interval(secs=F.col("l_linenumber").cast("int")).alias("later"))
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "passenger_id", (F.lit("1998-01-01").cast("timestamp") + F.col("later")).alias("at")
    )
    swept = dimensions.as_of_sweep(facts, b.passenger_versions(spark, folder), "passenger_id", "id", "at", {"sk_id": "passenger_sk_id"}, hot_rows=10)
    return swept.groupBy("passenger_id", "passenger_sk_id").agg(F.count(F.lit(1)).alias("lines"), F.max("at").alias("last_at"))


@query
def asof_train(spark: SparkSession, folder: str) -> DataFrame:
    facts = b.tickets(spark, folder).select(
        "ticket_id", (F.col("route_sk_id") + 1).cast("int").alias("train_id"), "departure_date"
    )
    trains = b.train_versions(spark, folder)
    return dimensions.as_of_join(
        facts, trains, "train_id", "id", "departure_date", {"sk_id": "train_sk_id", "name": "name"}
    )


@query
def silver_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events to fact: cast, normalise, collapse, look up, as-of join."""
    return ticket_fact(b.ticket_events(spark, folder), b.fact_dims(spark, folder))


# --- merges ------------------------------------------------------------------------------------------

_PASSENGER = ("name", "gender", "phone", "email")
_STATION = ("name", "city", "code")


@query
def scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.stored_stations(spark, folder), b.station_snapshot(spark, folder)
    return merge.scd1_merge(stored, batch, "id", _STATION)


@query
def scd1_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.stored_stations(spark, folder), b.station_snapshot(spark, folder)
    return merge.scd1_merge(stored, batch, "id", _STATION, full_snapshot=True)


@query
def scd1_null_unsafe(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.stored_stations(spark, folder), b.station_snapshot(spark, folder)
    return merge.scd1_merge(stored, batch, "id", _STATION, null_safe=False)


@query
def scd1_soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.stored_stations(spark, folder), b.station_snapshot(spark, folder)
    return merge.soft_delete(stored, batch, "id")


@query
def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    return merge.scd2_merge(stored, batch, "id", _PASSENGER)


@query
def scd2_expire_and_open(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    return merge.scd2_expire_and_open(stored, batch, "id", _PASSENGER)


@query
def scd2_null_unsafe(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    return merge.scd2_expire_and_open(stored, batch, "id", _PASSENGER, null_safe=False)


@query
def scd2_multi_version(spark: SparkSession, folder: str) -> DataFrame:
    """A stored first and second load meet a batch with a late version and a repeat for every passenger."""
    stored = merge.scd2_expire_and_open(
        b.first_passengers(spark, folder), b.second_passengers(spark, folder), "id", _PASSENGER
    )
    return merge.scd2_merge(stored, b.late_passengers(spark, folder), "id", _PASSENGER)


@query
def scd2_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Stored versions of half of the customers are closed in 1996; the batch has a version inside that time, of
    new content for every third customer, and one after it."""
    stored = b.first_passengers(spark, folder)
    closed = F.col("id") % 2 == 0
    stored = stored.withColumns(
        {
            "is_active": ~closed,
            "end_date": F.when(closed, F.lit("1996-01-01").cast("timestamp")),
        }
    )
    inside = stored.withColumns(
        {
            "sk_id": F.col("sk_id") + 2,
            "gender": F.when(F.col("id") % 3 == 0, "moved").otherwise(F.col("gender")),
            "start_date": F.lit("1995-06-01").cast("timestamp"),
        }
    )
    after = stored.withColumns({"sk_id": F.col("sk_id") + 3, "start_date": F.lit("1997-01-01").cast("timestamp")})
    return merge.scd2_merge(stored, inside.unionByName(after), "id", _PASSENGER)


def _order_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored: orders not urgent. Batch: orders of 1997 on, cheap ones repriced, some statuses unknown."""
    orders = b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("created_at"),
        "o_orderpriority",
    )
    stored = orders.where(F.col("o_orderpriority") != "1-URGENT").drop("o_orderpriority")
    batch = orders.where(F.col("created_at") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    dear = F.col("price") >= 100000
    batch = batch.withColumns(
        {
            "status": F.when(F.col("status") != "P", F.col("status")),
            "price": F.when(dear, F.col("price")).otherwise(money(F.col("price") + 1)),
            "created_at": F.when(dear, F.col("created_at")).otherwise(
                F.col("created_at") + F.make_dt_interval(F.lit(40))
            ),
        }
    ).drop("o_orderpriority")
    return stored, batch


@query
def fact_upsert(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = _order_loads(spark, folder)
    return merge.upsert(stored, batch, ["ticket_id"])


@query
def fact_upsert_null_unsafe(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = _order_loads(spark, folder)
    return merge.upsert(stored, batch, ["ticket_id"], null_safe=False)


@query
def fact_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the time collapsed one by one and folded: what collapsing it at once gives."""
    events = b.status_events(spark, folder).drop("value")
    start, middle, end = _thirds(events, "created_at")
    first = DateWindow(start, middle).apply(events, "created_at")
    rest = DateWindow(middle, end).apply(events, "created_at")
    stored = _collapsed(first)
    return merge.fold_history(
        stored, _collapsed(rest), "ticket_id", "created_at", list(history.TICKET_MILESTONES)
    )


def _thirds(df: DataFrame, moment: str) -> tuple[str, str, str]:
    """First day, middle day and the day after the last of a time column."""
    day = F.to_date(moment)
    first, last = df.agg(F.min(day), F.max(day)).first()
    first, last = first or date(1970, 1, 1), last or date(1970, 1, 1)
    return str(first), str(first + (last - first) / 2), str(last + timedelta(days=1))


def _collapsed(events: DataFrame) -> DataFrame:
    """Tickets by user alone, so that they reach over both halves."""
    by_user = events.withColumn("ticket_id", F.substring_index("ticket_id", "-", 1))
    return history.collapse_history(by_user, "ticket_id", "created_at", "id")


def _revenue_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored: revenue of unrefunded tickets, stamped 2000. Batch: revenue of all, stamped 2001."""
    tickets = b.tickets(spark, folder)
    stored = rollups.revenue_daily(tickets.where(F.col("refunded_at").isNull()))
    stamp = {y: F.lit(f"{y}-01-01").cast("timestamp") for y in (2000, 2001)}
    batch = rollups.revenue_daily(tickets)
    return stored.withColumn("updated_at", stamp[2000]), batch.withColumn("updated_at", stamp[2001])


_REVENUE_GRAIN = ["revenue_date", "route_sk_id", "class_id"]


def _revenue_upsert(spark: SparkSession, folder: str, match_null_keys: bool) -> DataFrame:
    stored, batch = _revenue_loads(spark, folder)
    compare = [c for c in stored.columns if c not in (*_REVENUE_GRAIN, "updated_at")]
    return merge.upsert(stored, batch, _REVENUE_GRAIN, compare, match_null_keys=match_null_keys)


@query
def aggregate_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return _revenue_upsert(spark, folder, match_null_keys=True)


@query
def aggregate_upsert_plain_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _revenue_upsert(spark, folder, match_null_keys=False)


@query
def merge_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The second merge of the same batch changes nothing."""
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    once = merge.scd2_merge(stored, batch, "id", _PASSENGER)
    return merge.scd2_merge(once, batch, "id", _PASSENGER)


@query
def new_only_anti(spark: SparkSession, folder: str) -> DataFrame:
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    return merge.new_rows(stored, batch, "id", active_only=True).select("id", "name", "gender")


@query
def new_only_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same insert written as a left join that keeps what found no partner."""
    stored, batch = b.first_passengers(spark, folder), b.second_passengers(spark, folder)
    known = stored.where("is_active").select(F.col("id").alias("known_id"))
    joined = batch.join(known, F.col("id") == F.col("known_id"), "left")
    return joined.where(F.col("known_id").isNull()).select("id", "name", "gender")


@query
def missing_not_exists(spark: SparkSession, folder: str) -> DataFrame:
    """Live stored rows absent from the batch, as SQL."""
    return spark.sql(
        """
        SELECT t.id, t.name FROM {stored} t
        WHERE NOT t.is_deleted AND NOT EXISTS (SELECT 1 FROM {batch} s WHERE s.id = t.id)
        """,
        stored=b.stored_stations(spark, folder),
        batch=b.station_snapshot(spark, folder),
    )


# --- quality -----------------------------------------------------------------------------------------


def _passengers(spark: SparkSession, folder: str) -> DataFrame:
    return b.second_passengers(spark, folder)


@query
def dq_complete(spark: SparkSession, folder: str) -> DataFrame:
    rules = quality.complete("id", "name", "phone", "email")
    return quality.evaluate(_passengers(spark, folder), [*rules, quality.any_complete("phone", "email")])


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    lines = b.table(spark, folder, "lineitem")
    rules = [quality.unique("l_orderkey"), quality.unique("l_partkey")]
    return quality.evaluate(lines, rules)


@query
def dq_grain(spark: SparkSession, folder: str) -> DataFrame:
    lines = b.table(spark, folder, "lineitem")
    rules = [quality.unique("l_orderkey", "l_linenumber"), quality.unique("l_orderkey", "l_partkey", "l_shipdate")]
    return quality.evaluate(lines, rules)


@query
def dq_allowed(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        quality.contained("o_orderstatus", ("F", "O")),
        quality.contained("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
    ]
    return quality.evaluate(b.table(spark, folder, "orders"), rules)


@query
def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        quality.at_least("l_quantity", 1),
        quality.above("l_linenumber", 1),
        quality.at_most("l_discount", 0.08),
        quality.at_most("l_tax", 1),
    ]
    return quality.evaluate(b.table(spark, folder, "lineitem"), rules)


@query
def dq_length(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        quality.min_length("p_name", 8),
        quality.max_length("p_name", 9),
        quality.min_length("p_brand", 3),
        quality.max_length("p_brand", 100),
    ]
    return quality.evaluate(b.table(spark, folder, "part"), rules)


@query
def dq_sign(spark: SparkSession, folder: str) -> DataFrame:
    rules = [*quality.positive("c_acctbal", "c_custkey"), *quality.non_negative("c_acctbal", "c_custkey")]
    return quality.evaluate(b.table(spark, folder, "customer"), rules)


@query
def dq_satisfies(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        quality.satisfies("ships after 1995", "l_shipdate >= timestamp_ntz '1996-01-01'", least=0.5),
        quality.satisfies("ships before 2000", "l_shipdate < timestamp_ntz '2000-01-01'"),
        quality.satisfies("tax known when reduced", "CASE WHEN l_tax > 0 THEN l_discount < l_tax END").warn(),
    ]
    return quality.evaluate(b.table(spark, folder, "lineitem"), rules)


@query
def dq_format(spark: SparkSession, folder: str) -> DataFrame:
    raw = b.source_passengers(spark, folder).select(F.trim("phone").alias("phone"), F.trim("email").alias("email"))
    rules = [
        quality.matches("email format", "email", suites.EMAIL),
        quality.matches("phone format", "phone", suites.PHONE),
        quality.matches("phone starts with 77", "phone", "^77"),
    ]
    return quality.evaluate(raw, rules)


@query
def dq_fk(spark: SparkSession, folder: str) -> DataFrame:
    orders = b.table(spark, folder, "orders")
    return quality.resolves(orders, b.first_passengers(spark, folder), "o_custkey", "id").unionByName(
        quality.resolves(orders, b.table(spark, folder, "customer"), "o_custkey", "c_custkey")
    )


@query
def dq_one_active(spark: SparkSession, folder: str) -> DataFrame:
    """Both loads stacked without a merge: passengers of both have two active rows."""
    both = b.first_passengers(spark, folder).unionByName(b.second_passengers(spark, folder))
    return quality.evaluate(both, [quality.one_active("id")])


@query
def dq_rowcount(spark: SparkSession, folder: str) -> DataFrame:
    return quality.same_size(b.first_passengers(spark, folder), b.table(spark, folder, "customer"))


@query
def dq_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates are long past, so every row is stale."""
    return quality.evaluate(b.table(spark, folder, "orders"), [quality.fresh("o_orderdate")])


def _staged(spark: SparkSession, name: str, summary: DataFrame) -> DataFrame:
    """A summary written once, as in a warehouse run, so that no rule computes it again."""
    return _scratch_store(spark).stage(SPECS["gold", name], summary, "batch")


@query
def dq_suite_cancellation_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = rollups.cancellation_summary(b.tickets(spark, folder))
    return quality.evaluate(_staged(spark, "cancellation_summary", summary), suites.cancellation_summary())


@query
def dq_suite_refund_loss(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(_staged(spark, "refund_loss", rollups.refund_loss(b.tickets(spark, folder))), suites.refund_loss())


@query
def dq_suite_revenue_daily(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(_staged(spark, "revenue_daily", rollups.revenue_daily(b.tickets(spark, folder))), suites.revenue_daily())


@query
def dq_suite_train_performance(spark: SparkSession, folder: str) -> DataFrame:
    performance = rollups.train_performance(b.tickets(spark, folder), b.train_versions(spark, folder))
    return quality.evaluate(_staged(spark, "train_performance", performance), suites.train_performance())


@query
def dq_suite_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """The fact is staged first, as in a warehouse run, so that no rule recomputes it."""
    spec = SPECS["silver", "tickets"]
    staged = _scratch_store(spark).stage(spec, silver_tickets(spark, folder), "batch")
    return quality.evaluate(staged, suites.tickets())


@query
def dq_suite_passengers(spark: SparkSession, folder: str) -> DataFrame:
    passengers = cleaning.silver_passengers(_bronze(spark, folder, "passengers"))
    return quality.evaluate(passengers, suites.passengers())


@query
def dq_suite_routes(spark: SparkSession, folder: str) -> DataFrame:
    routes = cleaning.normal_routes(_bronze(spark, folder, "routes"))
    stations = cleaning.silver_stations(_bronze(spark, folder, "stations"))
    trains = cleaning.silver_trains(_bronze(spark, folder, "trains"))
    return quality.evaluate(dimensions.enrich_routes(routes, stations, trains), suites.routes())


@query
def dq_suite_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(_bronze(spark, folder, "tickets"), suites.bronze())


@query
def dq_suite_trains(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(cleaning.silver_trains(_part_trains(spark, folder)), suites.trains())


@query
def dq_suite_stations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(cleaning.silver_stations(_bronze(spark, folder, "stations")), suites.stations())


# --- storing and publishing --------------------------------------------------------------------------

_ORDERS = "ticket_id BIGINT, status STRING, price DECIMAL(18,2), created_at TIMESTAMP"


def _scratch_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{shared_folder(spark)}/tierweave-{uuid4().hex}")


def _order_spec(name: str, kind: str, layout: Layout) -> TableSpec:
    return TableSpec(name, "silver", kind, ("ticket_id",), _ORDERS, layout=layout)


@query
def publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Stored orders by month, a merge that moves rows between months, published as one snapshot."""
    store = _scratch_store(spark)
    layout = Layout(by_month="created_at", bucket="ticket_id", buckets=2, order=("ticket_id",))
    spec = _order_spec("orders_by_month", "fact", layout)
    stored, batch = _order_loads(spark, folder)
    store.append(spec, stored)
    affected = store.affected_partitions(spec, batch)
    merged = merge.upsert(store.read_partitions(spec, affected), store.stage(spec, batch, "batch"), spec.keys)
    store.publish(spec, store.write(spec, merged), folders_of(spec, affected))
    return store.read(spec)


@query
def publish_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """A bucketed dimension of versions: a merge that is given up before it is published, and the same merge published. Only the
    buckets that hold keys of the batch are read and written."""
    store = _scratch_store(spark)
    spec = replace(SPECS["silver", "passengers"], name="people", ddl=SPECS["silver", "passengers"].ddl.replace("id INT", "id BIGINT"))
    store.replace(spec, b.first_passengers(spark, folder))
    batch = store.stage(spec, b.second_passengers(spark, folder), "batch")
    affected = store.affected_partitions(spec, batch)
    merged = merge.scd2_merge(store.read_partitions(spec, affected), batch, "id", _PASSENGER)
    store.discard(spec, store.write(spec, merged.limit(1)))
    batch = store.stage(spec, b.second_passengers(spark, folder), "batch")
    merged = merge.scd2_merge(store.read_partitions(spec, affected), batch, "id", _PASSENGER)
    store.publish(spec, store.write(spec, merged), folders_of(spec, affected))
    store.discard(spec)
    return store.read(spec)


@query
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Months present in the second write are replaced as a whole, the others stay."""
    store = _scratch_store(spark)
    spec = _order_spec("orders_overwritten", "raw", Layout(by_month="created_at"))
    stored, batch = _order_loads(spark, folder)
    store.replace(spec, stored)
    store.replace_partitions(spec, batch)
    return store.read(spec)


@query
def append_rows(spark: SparkSession, folder: str) -> DataFrame:
    store = _scratch_store(spark)
    spec = _order_spec("orders_log", "raw", Layout(order=("ticket_id",)))
    stored, batch = _order_loads(spark, folder)
    store.replace(spec, stored)
    store.append(spec, batch)
    return store.read(spec)


@query
def truncate_and_reload(spark: SparkSession, folder: str) -> DataFrame:
    """A table by month, emptied and loaded again, holds the new load alone; rows_between counts what the empty table still had."""
    store = _scratch_store(spark)
    spec = _order_spec("orders_reloaded", "raw", Layout(by_month="created_at", order=("ticket_id",)))
    stored, batch = _order_loads(spark, folder)
    store.replace(spec, stored)
    store.truncate(spec)
    between = store.read(spec).count()
    store.append(spec, batch)
    return store.read(spec).withColumn("rows_between", F.lit(between).cast("long"))


@query
def ordered_write(spark: SparkSession, folder: str) -> DataFrame:
    """Line items stored in key order; inversions counts neighbours of a file that are out of order."""
    store = _scratch_store(spark)
    layout = Layout(by_month="created_at", order=("ticket_id", "price"))
    spec = _order_spec("lines_in_order", "raw", layout)
    lines = b.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("created_at"),
    )
    store.replace(spec, lines)
    in_file = Window.partitionBy("_metadata.file_path").orderBy("_metadata.row_index")
    key = F.struct("ticket_id", "price")
    stored = store.read_parts(spec, store.snapshot(spec).parts)
    checked = stored.select((F.lag(key).over(in_file) > key).alias("inverted"))
    return checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if("inverted").alias("inversions"))


@query
def warehouse_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """All layers of all tables with their checks; daily revenue by class at the end of it.

    Route keys are hashes, so the routes are summed up here.
    """
    store = _scratch_store(spark)
    sources = b.sources(spark, folder)
    warehouse = Warehouse(store, source_from(sources))
    start, _, end = _source_days(sources)
    window = DateWindow(start, end)
    warehouse.bootstrap()
    warehouse.run_stage("bronze", window)
    warehouse.run_stage("silver", window)
    warehouse.run_stage("gold", window)
    revenue = store.read(SPECS["gold", "revenue_daily"])
    store.remove(f"{store.root}/bronze")
    store.remove(f"{store.root}/silver")
    return revenue.groupBy("revenue_date", "class_id").agg(
        F.sum("total_tickets").alias("total_tickets"),
        money(F.sum("net_revenue")).alias("net_revenue"),
        money(F.sum("refunded_revenue")).alias("refunded_revenue"),
    )


@query
def dq_table_states(spark: SparkSession, folder: str) -> DataFrame:
    """Passengers in two loads, checked for each bucket as it is written; the report of the table at the end, from what was kept."""
    sources = b.sources(spark, folder)
    again = F.lit(f"{b.SECOND_LOAD}T00:00:00Z")
    moved = sources["passengers"].where(F.col("_id") % 3 == 0).withColumns({"phone": F.lit("12"), "created_at": again, "updated_at": again})
    store = _scratch_store(spark)
    warehouse = Warehouse(store, source_from({"passengers": sources["passengers"].unionByName(moved)}))
    for window in (DateWindow(b.FIRST_LOAD, "1997-01-01"), DateWindow("1997-01-01", "1999-01-01")):
        warehouse.run_table("bronze", "passengers", window)
        warehouse.run_table("silver", "passengers", window)
    report = warehouse.table_report("silver", "passengers")
    store.drop()
    return spark.createDataFrame(report, quality.REPORT)


class _OtherSchema(Warehouse):
    """A transform that has come to give a column the declaration does not know."""

    def _transform(self, spec: TableSpec, batch: DataFrame) -> DataFrame:
        return super()._transform(spec, batch).withColumn("seat_row", F.lit(1))


@query
def gated_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Published tickets after each of several runs: nothing in the window, routes that are not stored yet, a transform of another
    schema, rules that fail, and a run that may publish."""
    store = _scratch_store(spark)
    sources = b.sources(spark, folder)
    some_routes = sources["routes"].where(F.col("_id") % 2 == 0)
    warehouse = Warehouse(store, source_from(sources | {"routes": some_routes}))
    start, _, end = _source_days(sources)
    window, before = DateWindow(start, end), DateWindow("1990-01-01", start)
    steps: list[tuple[str, int]] = []

    def attempt(step: str, warehouse: Warehouse, window: DateWindow, blocked_by: str | None = None, **more) -> None:
        try:
            warehouse.run_table("silver", "tickets", window, **more)
        except quality.QualityError as e:
            if blocked_by is None or blocked_by not in str(e):
                raise
        steps.append((step, store.read(SPECS["silver", "tickets"]).count()))

    warehouse.bootstrap()
    warehouse.run_stage("bronze", window)
    attempt("nothing in the window", warehouse, before)
    warehouse.run_stage("silver", window, [n for n in RUN_ORDER["silver"] if n != "tickets"])
    attempt("routes missing", warehouse, window, "route_id resolves to id")
    warehouse.source = source_from(sources)
    warehouse.run_table("bronze", "routes", window)
    warehouse.run_table("silver", "routes", window)
    attempt("other schema", _OtherSchema(store), window, "seat_row: declared nothing")
    attempt("rules fail", warehouse, window, "max price <= 0", rules=[quality.at_most("price", 0)])
    attempt("may publish", warehouse, window)
    store.drop()
    return spark.createDataFrame(steps, "step STRING, published BIGINT")


def _source_days(sources: dict[str, DataFrame]) -> tuple[str, str, str]:
    """First day, middle day and the day after the last over the window columns of all sources."""
    moments = [
        df.select(F.try_to_timestamp(F.col(SPECS["bronze", name].window_field).cast("string")).alias("at"))
        for name, df in sources.items()
    ]
    return _thirds(reduce(DataFrame.unionByName, moments), "at")


#: Per summary: the column of its day, that of its class, and its metrics.
SUMMARY_METRICS = {
    "cancellation_summary": (
        "booking_date", "class_id",
        "total_tickets_created total_tickets_paid total_tickets_cancelled total_tickets_refunded cancelled_before_payment cancelled_after_payment "
        "cancelled_not_yet_refunded total_revenue_lost avg_hours_to_cancel cancellation_rate cancelled_after_payment_rate",
    ),
    "revenue_daily": (
        "revenue_date", "class_id",
        "total_tickets gross_revenue total_discount_calculated net_revenue refunded_revenue net_revenue_after_refund avg_ticket_price",
    ),
    "refund_loss": (
        "refund_date", "class_id",
        "total_tickets_refunded total_refund_amount avg_refund_amount avg_days_cancel_to_refund avg_hours_to_refund avg_days_created_to_refund "
        "total_refunded_with_promo total_refunded_with_family_flag",
    ),
    "train_performance": (
        "departure_date", None,
        "capacity total_tickets_sold total_cancelled_tickets net_tickets_sold total_revenue family_ticket_count promo_ticket_count "
        "cancelled_after_departure_flag occupancy_rate is_fully_booked",
    ),
}


@query
def gold_after_second_window(spark: SparkSession, folder: str) -> DataFrame:
    """All layers in two windows, with their checks; tickets booked in the first move to another day in the second, and summaries
    follow the change log of the fact. Every metric per day and class at the end, added up over routes, whose keys are hashes."""
    store = _scratch_store(spark)
    sources = b.sources(spark, folder)
    warehouse = Warehouse(store, source_from(sources))
    start, middle, end = _source_days(sources)
    warehouse.bootstrap()
    for window in (DateWindow(start, middle), DateWindow(middle, end)):
        for layer in ("bronze", "silver", "gold"):
            warehouse.run_stage(layer, window)
    parts = []
    for name, (day, cls, metrics) in SUMMARY_METRICS.items():
        entries = [F.struct(F.lit(m).alias("metric"), F.round(F.sum(F.col(m).cast("double")), 4).alias("value")) for m in metrics.split()]
        keys = [F.to_date(day).alias("day"), (F.col(cls) if cls else F.lit(None).cast("int")).alias("class_id")]
        sums = store.read(SPECS["gold", name]).groupBy(*keys).agg(F.array(*entries).alias("entries"))
        parts.append(sums.select(F.lit(name).alias("summary"), "day", "class_id", F.inline("entries")))
    store.remove(f"{store.root}/bronze")
    store.remove(f"{store.root}/silver")
    return reduce(DataFrame.unionByName, parts)
