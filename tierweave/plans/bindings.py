"""Operator inputs derived from the test tables.

The test tables hold no rail data, so line items stand in for tickets, customers for passengers and
stations, suppliers for routes, parts and regions for trains, and web events for status histories. Every
binding covers its whole tables; attributes decide which rows are new, changed or absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave.functions import discounted, money
from tierweave.operators.cleaning import bronze_cast, normal_ticket_events
from tierweave.sources.lookups import static_lookups
from tierweave.sources.readers import read_parquet_table, spread

# Event type -> ticket status; order priority -> payment method as typed at the counter.
EVENT_STATUS = {"purchase": "paid", "error": "cancelled", "signup": "refunded"}
PRIORITY_METHOD = {
    "1-URGENT": " Credit_Card",
    "2-HIGH": "DEBIT_CARD ",
    "3-MEDIUM": "e_wallet",
    "4-NOT SPECIFIED": "direct",
}
FIRST_LOAD = "1995-01-01"
SECOND_LOAD = "1998-01-01"
TRAIN_END = "2000-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet_table(spark, folder, name)


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --- the ticket fact ---------------------------------------------------------------------------------


def _sold_lines(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    lines = table(spark, folder, "lineitem") if lines is None else lines
    orders = table(spark, folder, "orders")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("ticket_id", _ticket_key(F.date_format("l_shipdate", "yyyy-MM-dd")))
    )


def _ticket_key(day: Column) -> Column:
    """Made behind the joins, so that no shuffle carries the text beside the columns it is made of."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)


def _cancel_time() -> Column:
    shift = F.make_dt_interval(F.col("l_linenumber") % 3 - 1)
    return F.when(F.col("l_returnflag").isin("A", "R"), F.col("l_shipdate") + shift)


def _refund_time() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") + F.make_dt_interval(F.lit(7)))


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows: one ticket per line item, route and train by supplier region, NULL class for low priority."""
    paid = F.col("o_orderstatus") != "O"
    status = (
        F.when(F.col("l_returnflag") == "R", 4)
        .when(F.col("l_returnflag") == "A", 3)
        .otherwise(F.when(paid, 1).otherwise(2))
    )
    ticket_class = F.when(
        F.col("o_orderpriority") != "5-LOW", F.when(F.col("l_linestatus") == "F", 1).otherwise(2)
    )
    lines = _sold_lines(spark, folder).withColumns(
        {"price": money("l_extendedprice"), "discount": money("l_discount")}
    )
    return lines.select(
        "ticket_id",
        F.col("n_regionkey").cast("bigint").alias("route_sk_id"),
        F.col("n_regionkey").cast("bigint").alias("train_sk_id"),
        ticket_class.alias("class_id"),
        status.alias("active_status_id"),
        F.col("l_shipdate").alias("departure_date"),
        F.when(paid, F.col("o_orderdate")).alias("paid_at"),
        _cancel_time().alias("cancelled_at"),
        _refund_time().alias("refunded_at"),
        F.col("o_orderdate").alias("created_at"),
        "price",
        "discount",
        discounted("price", "discount").alias("final_price"),
        (F.col("l_quantity") > 25).alias("family_flag"),
        (F.col("l_discount") >= 0.08).alias("has_promo"),
    )


def train_versions(spark: SparkSession, folder: str) -> DataFrame:
    """One version per region, its key being its id; odd regions stop running in 2000."""
    odd = F.col("r_regionkey") % 2 == 1
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("sk_id"),
        (F.col("r_regionkey") + 1).alias("id"),
        F.lower("r_name").alias("name"),
        F.lit("economy").alias("type"),
        (F.col("r_regionkey") + 1).alias("capacity"),
        (~odd).alias("is_active"),
        _at(FIRST_LOAD).alias("start_date"),
        F.when(odd, _at(TRAIN_END)).alias("end_date"),
    )


# --- raw dimensions ----------------------------------------------------------------------------------


def source_passengers(spark: SparkSession, folder: str) -> DataFrame:
    gender = (
        F.when(F.col("c_mktsegment") == "BUILDING", " Male ")
        .when(F.col("c_mktsegment") == "FURNITURE", "FEMALE")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Other")
    )
    number = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).cast("int").alias("_id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
        gender.alias("gender"),
        F.concat(F.lit(" "), F.lpad(number, 11, "7"), F.lit(" ")).alias("phone"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("User"), number, F.lit("@Example.COM "))).alias("email"),
        *_loaded(),
    )


def source_trains(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).alias("_id"),
        F.concat("r_name", F.lit(" Express ")).alias("name"),
        F.when(F.col("r_regionkey") > 0, " Business").alias("type"),
        (F.col("r_regionkey") + 1500).alias("capacity"),
        *_loaded(),
    )


def source_stations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 1).alias("_id"),
        F.concat(F.lit(" "), "n_name").alias("name"),
        F.when(F.col("n_regionkey") > 0, F.concat(F.lit("City "), "n_regionkey")).alias("city"),
        F.concat(F.lit("N"), "n_nationkey").alias("code"),
        *_loaded(),
    )


def source_routes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1).cast("int").alias("_id"),
        F.concat(F.lit(" n"), "s_nationkey").alias("origin"),
        F.concat(F.lit("N"), (F.col("s_nationkey") + 1) % 25, F.lit(" ")).alias("destination"),
        (F.col("s_suppkey") % 5 + 1).cast("int").alias("train_id"),
        (F.col("s_nationkey") * 10 + 100).cast("int").alias("distance_km"),
        (F.col("s_nationkey") * 6 + 60).cast("int").alias("duration_minutes"),
        *_loaded(),
    )


def _loaded() -> tuple[Column, Column]:
    stamp = F.lit(f"{FIRST_LOAD}T00:00:00Z")
    return stamp.alias("created_at"), stamp.alias("updated_at")


def sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "passengers": source_passengers(spark, folder),
        "trains": source_trains(spark, folder),
        "stations": source_stations(spark, folder),
        "routes": source_routes(spark, folder),
        "tickets": source_tickets(spark, folder),
    }


# --- ticket sources and events -----------------------------------------------------------------------


def source_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Raw ticket events in source form: a booking per line item, then its cancellation and refund."""
    steps = (
        F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2), F.lit(3)))
        .when(F.col("l_returnflag") == "A", F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1)))
    )
    booked = F.when(F.col("o_orderstatus") == "O", " UNPAID ").otherwise("Paid")
    status = F.when(F.col("_id") == 1, booked).when(F.col("_id") == 2, "Cancelled ").otherwise("refunded")
    moment = (
        F.when(F.col("_id") == 1, F.col("o_orderdate"))
        .when(F.col("_id") == 2, _cancel_time())
        .otherwise(_refund_time())
    )
    method = F.create_map(*[F.lit(x) for pair in PRIORITY_METHOD.items() for x in pair])
    lines = _sold_lines(spark, folder, spread(table(spark, folder, "lineitem")))
    # What all events of a line share is made once a line; the day of the key is that of the departure.
    lines = lines.withColumn("_departure", iso_text("l_shipdate"))
    lines = lines.withColumn("ticket_id", F.concat(F.lit(" TKT-"), _ticket_key(F.substring_index("_departure", "T", 1))))
    return lines.withColumn("_id", F.explode(steps)).select(
        "_id",
        "ticket_id",
        (F.col("l_suppkey") + 1).cast("int").alias("route_id"),
        (F.col("o_custkey") + 1).cast("int").alias("passenger_id"),
        (F.col("n_regionkey") + 1).alias("train_id"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).cast("decimal(10,2)").alias("discount"),
        F.col("l_extendedprice").cast("decimal(38,2)").alias("price"),
        F.when(F.col("l_linestatus") == "F", " VIP").alias("class"),
        F.lit(None).cast("string").alias("seat_number"),
        F.col("_departure").alias("departure_date"),
        F.struct(
            F.when(F.col("l_tax") > 0, F.col("l_tax") > 0.04).alias("child_discount"),
            (F.col("l_quantity") / 10).cast("int").alias("family_members"),
            F.when(F.col("l_discount") >= 0.08, F.lit("SAVE")).alias("promo_code"),
            F.lit("web").alias("source"),
        ).alias("extra_info"),
        F.struct(
            F.element_at(method, F.col("o_orderpriority")).alias("method"),
            F.lit(None).cast("string").alias("bank"),
            F.lit(None).cast("string").alias("provider"),
        ).alias("payment"),
        F.lit(None).cast("array<string>").alias("addons"),
        iso_text(moment).alias("created_at"),
        status.alias("status"),
    )


def iso_text(moment: str | Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def status_events(spark: SparkSession, folder: str) -> DataFrame:
    """Web events as the status history of one ticket per user and day."""
    statuses = F.create_map(*[F.lit(x) for pair in EVENT_STATUS.items() for x in pair])
    return table(spark, folder, "events").select(
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("ticket_id"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.coalesce(F.element_at(statuses, F.col("event_type")), F.lit("unpaid")).alias("status"),
        "value",
    )


# --- passengers: two loads of a versioned dimension --------------------------------------------------


def first_passengers(spark: SparkSession, folder: str) -> DataFrame:
    """Stored versions: every customer outside one segment, open since the first load."""
    known = table(spark, folder, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return _passenger_rows(known, 0, F.col("c_mktsegment"), _phone(), FIRST_LOAD)


def second_passengers(spark: SparkSession, folder: str) -> DataFrame:
    """The next load, of all customers: one segment is new, debtors changed segment, some phones appear
    and others vanish."""
    debtor = F.col("c_acctbal") < 0
    segment = F.when(debtor, "COLLECTION").otherwise(F.col("c_mktsegment"))
    phone = (
        F.when(F.col("c_acctbal") > 9000, F.lit(None).cast("string"))
        .when(F.col("c_acctbal") > 7500, F.lpad(F.col("c_custkey").cast("string"), 10, "8"))
        .otherwise(_phone())
    )
    return _passenger_rows(table(spark, folder, "customer"), 1, segment, phone, SECOND_LOAD)


def _phone() -> Column:
    """Nobody between 7,500 and 8,500 has a phone in the first load."""
    has_none = F.col("c_acctbal").between(7500, 8500)
    return F.when(~has_none, F.lpad(F.col("c_custkey").cast("string"), 10, "9"))


def _passenger_rows(
    customers: DataFrame, load: int, segment: Column, phone: Column, start: str
) -> DataFrame:
    return customers.select(
        (F.col("c_custkey") * 4 + load).alias("sk_id"),
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("name"),
        F.lower(segment).alias("gender"),
        phone.alias("phone"),
        F.lit(None).cast("string").alias("email"),
        F.lit(True).alias("is_active"),
        _at(start).alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
    )


def late_passengers(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions for every customer in one batch: a late one of 1996 and a repeat of the second load."""
    late = _passenger_rows(
        table(spark, folder, "customer"), 2, F.lit("LATE"), _phone(), "1996-06-01"
    )
    return late.unionByName(second_passengers(spark, folder))


# --- stations: stored rows and a snapshot of an overwritten dimension --------------------------------


def stored_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Customers outside one segment; debtors are already deleted."""
    known = table(spark, folder, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return _station_rows(known, 0, F.col("c_nationkey"), F.col("c_acctbal") < 0)


def station_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """All customers below a balance: the rest vanished, low balances moved city, some cities are unknown."""
    seen = table(spark, folder, "customer").where(F.col("c_acctbal") < 6000)
    city = (
        F.when(F.col("c_acctbal") > 5000, F.lit(None).cast("int"))
        .when(F.col("c_acctbal") < 1000, F.lit(99))
        .otherwise(F.col("c_nationkey"))
    )
    return _station_rows(seen, 1, city, F.lit(False))


def _station_rows(customers: DataFrame, load: int, city: Column, deleted: Column) -> DataFrame:
    return customers.select(
        (F.col("c_custkey") * 4 + load).alias("sk_id"),
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("name"),
        F.concat(F.lit("city_"), city.cast("string")).alias("city"),
        F.lower(F.substring("c_mktsegment", 1, 4)).alias("code"),
        deleted.alias("is_deleted"),
    )


# --- dimensions of the fact --------------------------------------------------------------------------


def nation_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as stations, coded by lower-cased name; one region is deleted."""
    return table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("sk_id"),
        F.col("n_nationkey").alias("id"),
        F.lower("n_name").alias("code"),
        (F.col("n_regionkey") == 4).alias("is_deleted"),
    )


def supplier_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as routes between the nation of the supplier and the one mirrored to it."""
    return table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1000).alias("sk_id"),
        (F.col("s_suppkey") + 1).cast("int").alias("id"),
        F.concat(F.lit("nation_"), "s_nationkey").alias("origin"),
        F.concat(F.lit("nation_"), F.lit(24) - F.col("s_nationkey")).alias("destination"),
        (F.col("s_suppkey") % 5 + 1).cast("int").alias("train_id"),
    )


def passenger_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Both loads as closed and open versions: debtors changed, one segment starts with the second load."""
    changed = F.col("c_acctbal") < 0
    new = F.col("c_mktsegment") == "MACHINERY"
    first = F.when(~new, _version(0, FIRST_LOAD, F.when(changed, _at(SECOND_LOAD))))
    second = F.when(new | changed, _version(1, SECOND_LOAD, F.lit(None).cast("timestamp")))
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).alias("id"), F.inline(F.array_compact(F.array(first, second)))
    )


def _version(load: int, start: str, end: Column) -> Column:
    return F.struct(
        (F.col("c_custkey") * 4 + load).alias("sk_id"),
        end.isNull().alias("is_active"),
        _at(start).alias("start_date"),
        end.alias("end_date"),
    )


def fact_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "routes": supplier_routes(spark, folder),
        "trains": train_versions(spark, folder),
        "passengers": passenger_versions(spark, folder),
        **static_lookups(spark),
    }


def ticket_events(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised ticket events, by way of the bronze cast."""

    return normal_ticket_events(bronze_cast(source_tickets(spark, folder)))


