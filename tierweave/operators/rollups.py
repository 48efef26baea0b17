"""Daily summaries of the ticket fact.

Every metric is a sum, count, mean or maximum, so Spark combines rows inside each map task and only one
partial row per (task, group) is shuffled: a day or route that holds a third of all tickets costs nothing
extra. Money sums are cast back to the declared two-decimal type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.functions import day_of, elapsed, money, share


def _paid() -> Column:
    return F.col("paid_at").isNotNull()


def _cancelled() -> Column:
    return F.col("cancelled_at").isNotNull()


def _refunded() -> Column:
    return F.col("refunded_at").isNotNull()


def groups_of(tickets: DataFrame, moment: str, keys: Sequence[str], by_time: bool = False) -> DataFrame:
    """Distinct groups that tickets fall into, for a summary whose first key is the day (or, ``by_time``, the time) of ``moment``.

    A ticket whose ``moment`` is NULL is in the group of NULL; summaries that leave such tickets out have no such group.
    """
    first, *others = keys
    when = F.col(moment) if by_time else day_of(moment)
    return tickets.select(when.alias(first), *others).distinct()


def revenue_daily(tickets: DataFrame) -> DataFrame:
    """Paid tickets per payment day, route and class."""
    paid = tickets.where(_paid()).withColumn("revenue_date", day_of("paid_at"))
    sums = paid.groupBy("revenue_date", "route_sk_id", "class_id").agg(
        _tickets().alias("total_tickets"),
        money(F.sum("price")).alias("gross_revenue"),
        money(F.sum(F.col("price") - F.col("final_price"))).alias("total_discount_calculated"),
        money(F.sum("final_price")).alias("net_revenue"),
        _amount(_refunded()).alias("refunded_revenue"),
    )
    return sums.withColumns(
        {
            "net_revenue_after_refund": money(F.col("net_revenue") - F.col("refunded_revenue")),
            "avg_ticket_price": money(share("net_revenue", "total_tickets", 2)),
            "updated_at": F.current_timestamp(),
        }
    )


def cancellation_summary(tickets: DataFrame) -> DataFrame:
    """Ticket outcomes per booking day, route and class."""
    booked = tickets.withColumn("booking_date", day_of("created_at"))
    counts = booked.groupBy("booking_date", "route_sk_id", "class_id").agg(
        _tickets().alias("total_tickets_created"),
        _tickets(_paid()).alias("total_tickets_paid"),
        _tickets(_cancelled()).alias("total_tickets_cancelled"),
        _tickets(_refunded()).alias("total_tickets_refunded"),
        _tickets(_cancelled() & ~_paid()).alias("cancelled_before_payment"),
        _tickets(_cancelled() & _paid()).alias("cancelled_after_payment"),
        _tickets(_cancelled() & ~_refunded()).alias("cancelled_not_yet_refunded"),
        _amount(_cancelled() & _paid()).alias("total_revenue_lost"),
        F.avg(elapsed("created_at", "cancelled_at", "hours")).alias("avg_hours_to_cancel"),
    )
    return counts.withColumns(
        {
            "cancellation_rate": share("total_tickets_cancelled", "total_tickets_created", 4),
            "cancelled_after_payment_rate": share("cancelled_after_payment", "total_tickets_paid", 4),
            "updated_at": F.current_timestamp(),
        }
    )


def refund_loss(tickets: DataFrame) -> DataFrame:
    """Refunded tickets per refund day, route and class."""
    refunded = tickets.where(_refunded()).withColumn("refund_date", day_of("refunded_at"))
    sums = refunded.groupBy("refund_date", "route_sk_id", "class_id").agg(
        _tickets().alias("total_tickets_refunded"),
        money(F.sum("final_price")).alias("total_refund_amount"),
        _mean("cancelled_at", "days").alias("avg_days_cancel_to_refund"),
        _mean("created_at", "hours").alias("avg_hours_to_refund"),
        _mean("created_at", "days").alias("avg_days_created_to_refund"),
        _tickets(F.col("has_promo")).alias("total_refunded_with_promo"),
        _tickets(F.col("family_flag")).alias("total_refunded_with_family_flag"),
    )
    average = money(share("total_refund_amount", "total_tickets_refunded", 2))
    return sums.select(
        "refund_date",
        "route_sk_id",
        "class_id",
        "total_tickets_refunded",
        "total_refund_amount",
        average.alias("avg_refund_amount"),
        "avg_days_cancel_to_refund",
        "avg_hours_to_refund",
        "avg_days_created_to_refund",
        "total_refunded_with_promo",
        "total_refunded_with_family_flag",
        F.current_timestamp().alias("updated_at"),
    )


def train_performance(tickets: DataFrame, trains: DataFrame, by_day: bool = False) -> DataFrame:
    """Sales and occupancy per departure and train version.

    Tickets are summed to the grain first, and only the groups meet the train versions: the validity
    test needs no ticket column beyond the grain. A version closed before departure gives NULL name,
    type and capacity. ``by_day`` groups departures by calendar day instead of exact time.
    """
    sold = _paid() & ~_cancelled()
    departures = tickets
    if by_day:
        departures = tickets.withColumn("departure_date", F.date_trunc("day", "departure_date"))
    late = F.coalesce(F.col("cancelled_at") > F.col("departure_date"), F.lit(False))
    sums = departures.groupBy("departure_date", "train_sk_id").agg(
        _tickets(_paid()).alias("total_tickets_sold"),
        _tickets(_cancelled()).alias("total_cancelled_tickets"),
        _tickets(sold).alias("net_tickets_sold"),
        _amount(sold).alias("total_revenue"),
        F.count_if("family_flag").alias("family_ticket_count"),
        F.count_if("has_promo").alias("promo_ticket_count"),
        F.bool_or(late).alias("cancelled_after_departure_flag"),
    )
    version = trains.select(
        "sk_id", "name", "type", "capacity", F.col("start_date").alias("_from"), F.col("end_date").alias("_to")
    )
    valid = (F.col("departure_date") >= F.col("_from")) & (
        F.col("_to").isNull() | (F.col("departure_date") < F.col("_to"))
    )
    joined = sums.join(version, (F.col("train_sk_id") == F.col("sk_id")) & valid, "left")
    return joined.select(
        "departure_date",
        "train_sk_id",
        "name",
        "type",
        "capacity",
        *sums.columns[2:],
        F.round(F.try_divide("net_tickets_sold", "capacity") * 100, 2).alias("occupancy_rate"),
        (F.col("net_tickets_sold") >= F.col("capacity")).alias("is_fully_booked"),
        F.current_timestamp().alias("updated_at"),
    )


def revenue_by_route_week(tickets: DataFrame, status_id: int = 1) -> DataFrame:
    """Revenue of one status per route and booking week, month and year."""
    return (
        tickets.where(F.col("active_status_id") == status_id)
        .groupBy(
            "route_sk_id",
            F.weekofyear("created_at").alias("week"),
            F.month("created_at").alias("month"),
            F.year("created_at").alias("year"),
        )
        .agg(money(F.sum("final_price")).alias("total_revenue"))
    )


def revenue_by_day(tickets: DataFrame, status_id: int = 1) -> DataFrame:
    """Revenue of one status per calendar booking day."""
    return (
        tickets.where(F.col("active_status_id") == status_id)
        .groupBy(
            F.day("created_at").alias("day"),
            F.month("created_at").alias("month"),
            F.year("created_at").alias("year"),
        )
        .agg(money(F.sum("final_price")).alias("total_revenue"))
    )


def _tickets(condition: Column | None = None) -> Column:
    known = F.col("ticket_id").isNotNull()
    return F.count_if(known if condition is None else known & condition)


def _amount(condition: Column) -> Column:
    """Final price summed over the tickets that meet the condition; 0 when none does."""
    return money(F.sum(F.when(condition, F.col("final_price")).otherwise(money(F.lit(0)))))


def _mean(start: str, unit: str) -> Column:
    """Mean time from ``start`` to the refund; tickets without a start do not count."""
    return F.round(F.avg(elapsed(start, "refunded_at", unit)), 2)
