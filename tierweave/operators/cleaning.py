"""Bronze typing and the silver shape of each source table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.functions import (
    MONEY,
    as_timestamp,
    booking_lead_days,
    discounted,
    is_weekend,
    normal,
    surrogate_key,
    weekday,
    zero_if_null,
)

# Source columns that carry times as ISO text.
TIME_COLUMNS = ("created_at", "updated_at", "departure_date")


def bronze_cast(source: DataFrame) -> DataFrame:
    """``_id`` becomes ``id``; every known time column that is present becomes a TIMESTAMP."""
    times = {c: as_timestamp(c) for c in TIME_COLUMNS if c in source.columns}
    return source.withColumnsRenamed({"_id": "id"}).withColumns(times)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key. The survivor is the greatest row, so a retried task picks the same one."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*").select(
        *df.columns
    )


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key, without that column.

    An overwritten dimension keeps one row per id, so of several versions in a batch the last one counts.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    latest = df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return latest.select(*[key if c == key else f"_row.{c}" for c in df.columns if c != order])


def silver_passengers(bronze: DataFrame) -> DataFrame:
    shaped = bronze.select(
        _version_key(),
        "id",
        normal("name").alias("name"),
        normal("gender", "unknown").alias("gender"),
        F.trim("phone").alias("phone"),
        normal("email").alias("email"),
        *_open_version(),
    )
    return one_per_key(shaped, "sk_id")


def silver_trains(bronze: DataFrame) -> DataFrame:
    shaped = bronze.select(
        _version_key(),
        "id",
        normal("name").alias("name"),
        normal("type", "unknown").alias("type"),
        zero_if_null("capacity", "int").alias("capacity"),
        *_open_version(),
    )
    return one_per_key(shaped, "sk_id")


def silver_stations(bronze: DataFrame) -> DataFrame:
    shaped = bronze.select(
        _version_key(),
        "id",
        normal("name").alias("name"),
        normal("city", "unknown").alias("city"),
        normal("code").alias("code"),
        F.lit(False).alias("is_deleted"),
        "updated_at",
    )
    return latest_per_key(shaped, "id", "updated_at")


def normal_routes(bronze: DataFrame) -> DataFrame:
    """Routes before their station and train keys are looked up."""
    shaped = bronze.select(
        _version_key(),
        "id",
        normal("origin").alias("origin"),
        normal("destination").alias("destination"),
        "train_id",
        zero_if_null("distance_km", "int").alias("distance_km"),
        zero_if_null("duration_minutes", "int").alias("duration_minutes"),
        F.lit(False).alias("is_deleted"),
        "updated_at",
    )
    return latest_per_key(shaped, "id", "updated_at")


def ticket_derivations() -> dict[str, Column]:
    """Columns of a normal event that follow from others of the same row."""
    return {
        "day_of_week": weekday("departure_date"),
        "is_weekend": is_weekend("departure_date"),
        "booking_lead_days": booking_lead_days("departure_date", "created_at"),
        "final_price": discounted("price", "discount"),
    }


def normal_ticket_events(bronze: DataFrame) -> DataFrame:
    """Ticket events with typed money, normal text, and the flags and calendar columns of the fact."""
    amounts = bronze.withColumns(
        {"price": zero_if_null("price", MONEY), "discount": zero_if_null("discount", MONEY)}
    )
    derived = ticket_derivations()
    return amounts.select(
        normal("ticket_id").alias("ticket_id"),
        "id",
        "route_id",
        "passenger_id",
        "train_id",
        normal("class", "regular").alias("class"),
        normal("status").alias("status"),
        normal("payment.method").alias("payment"),
        *[derived[c].alias(c) for c in ("day_of_week", "is_weekend", "booking_lead_days")],
        "departure_date",
        "created_at",
        "price",
        "discount",
        derived["final_price"].alias("final_price"),
        _known_true(F.col("extra_info.family_members") > 1).alias("family_flag"),
        _known_true(F.col("extra_info.child_discount").cast("boolean")).alias("has_child"),
        F.col("extra_info.promo_code").isNotNull().alias("has_promo"),
    )


def _known_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _version_key() -> Column:
    return surrogate_key("id", "updated_at").alias("sk_id")


def _open_version() -> tuple[Column, Column, Column]:
    return (
        F.lit(True).alias("is_active"),
        F.col("updated_at").cast("timestamp").alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
    )
