from datetime import date, datetime
from decimal import Decimal

from tests.conftest import rows
from tierweave.operators import rollups
from tierweave.plans.tables import GOLD

TICKET = (
    "ticket_id STRING, route_sk_id BIGINT, class_id INT, train_sk_id BIGINT, active_status_id INT, departure_date TIMESTAMP, "
    "created_at TIMESTAMP, paid_at TIMESTAMP, cancelled_at TIMESTAMP, refunded_at TIMESTAMP, price DECIMAL(18,2), "
    "final_price DECIMAL(18,2), family_flag BOOLEAN, has_promo BOOLEAN"
)


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 3, day, hour)


def money(text: str) -> Decimal:
    return Decimal(text)


TICKETS = [
    ("t1", 1, 1, 5, 1, at(20), at(1, 8), at(1, 9), None, None, money("100.00"), money("90.00"), True, False),
    ("t2", 1, 1, 5, 4, at(20), at(1, 10), at(1, 10), at(2, 10), at(4, 10), money("50.00"), money("50.00"), False, True),
    ("t3", 1, 1, 5, 3, at(20), at(1, 12), None, at(21, 12), None, money("30.01"), money("30.01"), False, False),
    ("t4", None, None, 6, 2, at(21), at(2), None, None, None, money("10.00"), money("10.00"), True, True),
    ("t5", None, None, 7, 4, at(22), at(3), None, None, at(3, 12), money("10.00"), money("9.99"), False, False),
]
TRAINS = [
    (5, "five", "economy", 2, at(1), None),
    (6, "six", "business", 0, at(1), None),
    (7, "seven", "economy", 9, at(1), at(10)),
]


def tickets(spark):
    return spark.createDataFrame(TICKETS, TICKET)


def trains(spark):
    return spark.createDataFrame(
        TRAINS, "sk_id BIGINT, name STRING, type STRING, capacity INT, start_date TIMESTAMP, end_date TIMESTAMP"
    )


def same_types(spark, df, name):
    declared = spark.createDataFrame([], GOLD[name]).schema
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]


def test_revenue_daily(spark):
    got = rollups.revenue_daily(tickets(spark))
    same_types(spark, got, "revenue_daily")
    assert rows(got.drop("updated_at")) == [
        (date(2024, 3, 1), 1, 1, 2, money("150.00"), money("10.00"), money("140.00"), money("50.00"), money("90.00"), money("70.00"))
    ]


def test_cancellation_summary_with_a_group_nobody_paid(spark):
    got = rollups.cancellation_summary(tickets(spark))
    same_types(spark, got, "cancellation_summary")
    assert rows(got.drop("updated_at")) == sorted(
        [
            (date(2024, 3, 1), 1, 1, 3, 2, 2, 1, 1, 1, 1, money("50.00"), (24.0 + 480.0) / 2, 0.6667, 0.5),
            (date(2024, 3, 2), None, None, 1, 0, 0, 0, 0, 0, 0, money("0.00"), None, 0.0, None),
            (date(2024, 3, 3), None, None, 1, 0, 0, 1, 0, 0, 0, money("0.00"), None, 0.0, None),
        ],
        key=repr,
    )


def test_refund_loss_without_cancellation(spark):
    got = rollups.refund_loss(tickets(spark))
    same_types(spark, got, "refund_loss")
    assert rows(got.drop("updated_at")) == sorted(
        [
            (date(2024, 3, 4), 1, 1, 1, money("50.00"), money("50.00"), 2.0, 72.0, 3.0, 1, 0),
            (date(2024, 3, 3), None, None, 1, money("9.99"), money("9.99"), None, 12.0, 0.5, 0, 0),
        ],
        key=repr,
    )


def test_train_performance_with_no_capacity_and_a_closed_version(spark):
    got = rollups.train_performance(tickets(spark), trains(spark))
    same_types(spark, got, "train_performance")
    assert rows(got.drop("updated_at")) == sorted(
        [
            (at(20), 5, "five", "economy", 2, 2, 2, 1, money("90.00"), 1, 1, True, 50.0, False),
            (at(21), 6, "six", "business", 0, 0, 0, 0, money("0.00"), 1, 1, False, None, True),
            (at(22), 7, None, None, None, 0, 0, 0, money("0.00"), 0, 0, False, None, None),
        ],
        key=repr,
    )


def test_train_performance_by_day(spark):
    moved = tickets(spark).selectExpr(
        "* EXCEPT (departure_date)", "departure_date + make_interval(0, 0, 0, 0, int(substring(ticket_id, 2))) AS departure_date"
    )
    assert rollups.train_performance(moved, trains(spark)).count() == 5
    assert rollups.train_performance(moved, trains(spark), by_day=True).count() == 3


def test_revenue_of_paid_tickets(spark):
    assert rows(rollups.revenue_by_route_week(tickets(spark))) == [(1, 9, 3, 2024, money("90.00"))]
    assert rows(rollups.revenue_by_day(tickets(spark))) == [(1, 3, 2024, money("90.00"))]


def test_rollups_combine_before_one_shuffle(spark):
    for build in (rollups.revenue_daily, rollups.cancellation_summary, rollups.refund_loss):
        plan = build(tickets(spark))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("partial_") > 0
