"""The quality rules of every table.

Rules are grouped by table and built when asked for, because column expressions need a running session.
Bounds, allowed values and formats are fixed values. A rule that holds only for well-behaved histories
(nobody refunds without cancelling, or cancels unpaid) is a warning.
"""

from __future__ import annotations

from collections.abc import Callable

from tierweave.operators.quality import (
    Rule,
    above,
    any_complete,
    at_least,
    at_most,
    complete,
    contained,
    fresh,
    matches,
    max_length,
    min_length,
    non_negative,
    not_empty,
    one_active,
    positive,
    satisfies,
    unique,
)

GENDERS = ("male", "female", "unknown")
TRAIN_TYPES = ("economy", "business", "executive")
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^[0-9]{10,12}$"
STATION_CODE = r"^[a-z0-9]+$"


def bronze() -> list[Rule]:
    return [r.warn() for r in complete("id")]


def passengers() -> list[Rule]:
    return [
        *complete("sk_id", "id", "name", "start_date", "is_active"),
        any_complete("phone", "email"),
        unique("sk_id"),
        contained("gender", GENDERS).warn(),
        min_length("name", 3).warn(),
        max_length("name", 100).warn(),
        matches("email format", "email", EMAIL).warn(),
        matches("phone format", "phone", PHONE).warn(),
        above("id", 0),
        _ends_after_start(),
        not_empty(),
    ]


def trains() -> list[Rule]:
    return [
        *complete("sk_id", "id", "name", "type", "capacity", "is_active", "start_date"),
        unique("sk_id"),
        min_length("name", 3).warn(),
        max_length("name", 100).warn(),
        contained("type", (*TRAIN_TYPES, "unknown")).warn(),
        above("id", 0),
        above("capacity", 0),
        at_most("capacity", 2000),
        _ends_after_start(),
        not_empty(),
    ]


def stations() -> list[Rule]:
    return [
        *complete("sk_id", "id", "name", "city", "code", "is_deleted"),
        unique("sk_id"),
        min_length("name", 3).warn(),
        max_length("name", 100).warn(),
        min_length("city", 2).warn(),
        max_length("city", 50).warn(),
        min_length("code", 2).warn(),
        max_length("code", 5).warn(),
        satisfies("station code format", f"code RLIKE '{STATION_CODE}'").warn(),
        above("id", 0),
        not_empty(),
    ]


def routes() -> list[Rule]:
    stations_and_train = ("sk_org_station_id", "sk_dest_station_id", "sk_train_id")
    speed = "try_divide(distance_km, duration_minutes / 60.0) BETWEEN 20 AND 300"
    return [
        *complete("sk_id", "id", *stations_and_train, "distance_km", "duration_minutes", "is_deleted"),
        unique("sk_id"),
        above("id", 0),
        *positive("distance_km", "duration_minutes"),
        at_most("distance_km", 10000),
        at_most("duration_minutes", 1440),
        satisfies("origin differs from destination", "sk_org_station_id <> sk_dest_station_id").warn(),
        satisfies("average speed 20 to 300 km/h", speed, least=0.98).warn(),
        not_empty(),
    ]


def tickets() -> list[Rule]:
    keys = ("ticket_id", "route_sk_id", "passenger_sk_id", "train_sk_id", "class_id", "active_status_id")
    derived = ("day_of_week", "booking_lead_days", "departure_date", "price", "discount", "final_price")
    return [
        *complete(*keys, *derived, "is_weekend"),
        *[r.warn() for r in complete("payment_id")],
        unique("ticket_id"),
        above("price", 0),
        at_least("discount", 0),
        at_most("discount", 1),
        at_least("final_price", 0),
        at_least("booking_lead_days", 0),
        at_least("day_of_week", 1),
        at_most("day_of_week", 7),
        satisfies("final price follows discount", "abs(final_price - price * (1 - discount)) < 0.01"),
        satisfies("final price within price", "final_price <= price"),
        satisfies("discount is a fraction", "discount BETWEEN 0 AND 1"),
        satisfies("weekday is 1 to 7", "day_of_week BETWEEN 1 AND 7"),
        satisfies("weekend flag follows weekday", "is_weekend = (day_of_week IN (1, 7))"),
        not_empty(),
    ]


def class_lookup() -> list[Rule]:
    return _lookup("class_name", ("vip", "family", "regular", "promo"))


def status_lookup() -> list[Rule]:
    return _lookup("status", ("paid", "unpaid", "cancelled", "refunded"))


def payment_lookup() -> list[Rule]:
    return _lookup("method", ("credit_card", "debit_card", "e_wallet", "bank_transfer", "cash"))


def cancellation_summary() -> list[Rule]:
    grain = ("booking_date", "route_sk_id", "class_id")
    totals = ("total_tickets_created", "total_tickets_paid", "total_tickets_cancelled")
    split = ("cancelled_before_payment", "cancelled_after_payment", "cancelled_not_yet_refunded")
    return [
        *complete(*grain, *totals, "cancellation_rate"),
        unique(*grain),
        *non_negative(*totals, "total_tickets_refunded", *split, "total_revenue_lost"),
        *[r.warn() for r in non_negative("avg_hours_to_cancel")],
        satisfies("cancellation rate is a fraction", "cancellation_rate BETWEEN 0 AND 1"),
        satisfies(
            "cancellations split by payment",
            "total_tickets_cancelled = cancelled_before_payment + cancelled_after_payment",
        ),
        satisfies(
            "created covers paid and cancelled",
            "total_tickets_created >= total_tickets_paid + total_tickets_cancelled",
        ).warn(),
        satisfies("refunded within cancelled", "total_tickets_refunded <= total_tickets_cancelled").warn(),
        satisfies("cancelled within created", "total_tickets_cancelled <= total_tickets_created"),
        not_empty(),
        fresh(),
    ]


def refund_loss() -> list[Rule]:
    grain = ("refund_date", "route_sk_id", "class_id")
    waits = ("avg_days_cancel_to_refund", "avg_hours_to_refund", "avg_days_created_to_refund")
    subsets = ("total_refunded_with_promo", "total_refunded_with_family_flag")
    average = "abs(avg_refund_amount - try_divide(total_refund_amount, total_tickets_refunded)) < 0.01"
    return [
        *complete(*grain, "total_tickets_refunded", "total_refund_amount"),
        unique(*grain),
        *non_negative("total_tickets_refunded", "total_refund_amount", "avg_refund_amount", *subsets),
        *[r.warn() for r in non_negative(*waits)],
        *[satisfies(f"{c} within total", f"{c} <= total_tickets_refunded") for c in subsets],
        satisfies("average refund follows total", f"total_tickets_refunded = 0 OR {average}"),
        satisfies(
            "refund follows booking later than cancellation",
            "avg_days_created_to_refund >= avg_days_cancel_to_refund",
        ).warn(),
        not_empty(),
    ]


def revenue_daily() -> list[Rule]:
    grain = ("revenue_date", "route_sk_id", "class_id")
    sums = ("gross_revenue", "total_discount_calculated", "net_revenue", "refunded_revenue")
    average = "abs(avg_ticket_price - try_divide(net_revenue, total_tickets)) < 0.01"
    return [
        *complete(*grain, "total_tickets", "gross_revenue", "net_revenue"),
        unique(*grain),
        *non_negative("total_tickets", *sums, "avg_ticket_price"),
        satisfies("net after refund is not negative", "net_revenue_after_refund >= 0").warn(),
        satisfies(
            "net is gross less discount",
            "abs(net_revenue - (gross_revenue - total_discount_calculated)) < 0.01",
        ),
        satisfies(
            "net after refund is net less refunds",
            "abs(net_revenue_after_refund - (net_revenue - refunded_revenue)) < 0.01",
        ),
        satisfies("average price follows net", f"total_tickets = 0 OR {average}").warn(),
        satisfies("discount within gross", "total_discount_calculated <= gross_revenue"),
        satisfies("refunds within net", "refunded_revenue <= net_revenue"),
        not_empty(),
    ]


def train_performance() -> list[Rule]:
    grain = ("departure_date", "train_sk_id")
    counts = ("total_tickets_sold", "total_cancelled_tickets", "net_tickets_sold")
    subsets = ("family_ticket_count", "promo_ticket_count")
    occupancy = "abs(occupancy_rate - 100 * try_divide(net_tickets_sold, capacity)) < 0.1"
    return [
        *complete(*grain, "name", "capacity", "total_tickets_sold", "net_tickets_sold"),
        *complete("occupancy_rate", "is_fully_booked"),
        unique(*grain),
        *non_negative("capacity", *counts, "total_revenue", *subsets),
        satisfies("capacity is positive", "capacity > 0"),
        satisfies(
            "net is sold less cancelled",
            "net_tickets_sold = total_tickets_sold - total_cancelled_tickets",
        ).warn(),
        satisfies("net within capacity", "net_tickets_sold <= capacity"),
        satisfies("cancelled within sold", "total_cancelled_tickets <= total_tickets_sold").warn(),
        *[satisfies(f"{c} within sold", f"{c} <= total_tickets_sold").warn() for c in subsets],
        satisfies("occupancy is a percentage", "occupancy_rate BETWEEN 0 AND 100"),
        satisfies("occupancy follows capacity", f"capacity = 0 OR {occupancy}").warn(),
        satisfies(
            "booked flag follows capacity",
            "CASE WHEN is_fully_booked THEN net_tickets_sold = capacity ELSE net_tickets_sold < capacity END",
        ).warn(),
        contained("type", TRAIN_TYPES).warn(),
        not_empty(),
    ]


SUITES: dict[tuple[str, str], Callable[[], list[Rule]]] = {
    ("bronze", "passengers"): bronze,
    ("bronze", "trains"): bronze,
    ("bronze", "stations"): bronze,
    ("bronze", "routes"): bronze,
    ("bronze", "tickets"): bronze,
    ("silver", "passengers"): passengers,
    ("silver", "trains"): trains,
    ("silver", "stations"): stations,
    ("silver", "routes"): routes,
    ("silver", "tickets"): tickets,
    ("silver", "class"): class_lookup,
    ("silver", "status"): status_lookup,
    ("silver", "payment"): payment_lookup,
    ("gold", "cancellation_summary"): cancellation_summary,
    ("gold", "refund_loss"): refund_loss,
    ("gold", "revenue_daily"): revenue_daily,
    ("gold", "train_performance"): train_performance,
}


def merged_rules(kind: str, key: str) -> list[Rule]:
    """Rules that only make sense on the merged table, checked before it is published."""
    return [one_active(key)] if kind == "scd2" else []


def _lookup(column: str, values: tuple[str, ...]) -> list[Rule]:
    return [*complete("id", column), unique("id"), contained(column, values).warn(), not_empty()]


def _ends_after_start() -> Rule:
    return satisfies("range ends after it starts", "end_date IS NULL OR end_date >= start_date")
