"""The same queries as SQL for DuckDB, written from the definitions and not from the Spark code."""

from __future__ import annotations

from tierweave.plans.queries import SUMMARY_METRICS


def _half_up(number: str, divisor: str, places: int) -> str:
    """Exact ``round(number / divisor, places)`` of integers, halves away from zero, as double."""
    scale = 10**places
    size = f"(2 * abs(CAST({number} AS HUGEINT)) * {scale} + {divisor}) // (2 * CAST({divisor} AS HUGEINT))"
    return (
        f"CASE WHEN {divisor} > 0 THEN CAST(sign({number}) * ({size}) AS DOUBLE) / {scale} END"
    )


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


# --- the ticket fact ---------------------------------------------------------------------------------

_LINES = """lines AS (
  SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d')) AS ticket_key,
    CASE WHEN l_returnflag IN ('A', 'R') THEN l_shipdate + to_days(CAST(l_linenumber % 3 - 1 AS INTEGER)) END AS cancel_time,
    CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 7 DAY END AS refund_time,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(l_discount AS DECIMAL(18,2)) AS discount
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

_TICKETS = """tickets AS (
  SELECT ticket_key AS ticket_id, CAST(n_regionkey AS BIGINT) AS route_sk_id, CAST(n_regionkey AS BIGINT) AS train_sk_id,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END END AS class_id,
    CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_returnflag = 'A' THEN 3 WHEN o_orderstatus <> 'O' THEN 1 ELSE 2 END AS active_status_id,
    l_shipdate AS departure_date,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS paid_at,
    cancel_time AS cancelled_at, refund_time AS refunded_at, o_orderdate AS created_at,
    price, discount, CAST(round(price * (1 - discount), 2) AS DECIMAL(18,2)) AS final_price,
    l_quantity > 25 AS family_flag, l_discount >= 0.08 AS has_promo
  FROM lines
)"""

_TRAINS = """trains AS (
  SELECT CAST(r_regionkey AS BIGINT) AS sk_id, r_regionkey + 1 AS id, lower(r_name) AS name, 'economy' AS type,
    r_regionkey + 1 AS capacity, r_regionkey % 2 = 0 AS is_active, TIMESTAMP '1995-01-01' AS start_date,
    CASE WHEN r_regionkey % 2 = 1 THEN TIMESTAMP '2000-01-01' END AS end_date
  FROM region
)"""

_FACT = _with(_LINES, _TICKETS)
_CENTS = "CAST(sum(final_price) * 100 AS HUGEINT)"


def _hours(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end}) / 3600.0"


_REVENUE = f"""revenue AS (
  SELECT CAST(paid_at AS DATE) AS revenue_date, route_sk_id, class_id, count(*) AS total_tickets,
    sum(price) AS gross, sum(price - final_price) AS reduced, sum(final_price) AS net,
    coalesce(sum(final_price) FILTER (WHERE refunded_at IS NOT NULL), 0) AS refunded,
    {_half_up(_CENTS, "count(*)", 0)} / 100 AS avg_ticket_price
  FROM tickets WHERE paid_at IS NOT NULL GROUP BY 1, 2, 3
)"""

_REVENUE_OUT = """CAST(revenue_date AS VARCHAR) AS revenue_date, route_sk_id, class_id, total_tickets,
  CAST(gross AS DOUBLE) AS gross_revenue, CAST(reduced AS DOUBLE) AS total_discount_calculated,
  CAST(net AS DOUBLE) AS net_revenue, CAST(refunded AS DOUBLE) AS refunded_revenue,
  CAST(net - refunded AS DOUBLE) AS net_revenue_after_refund, avg_ticket_price"""

_CANCELLATION = f"""cancellation AS (
  SELECT CAST(created_at AS DATE) AS booking_date, route_sk_id, class_id,
    count(*) AS total_tickets_created, count(paid_at) AS total_tickets_paid,
    count(cancelled_at) AS total_tickets_cancelled, count(refunded_at) AS total_tickets_refunded,
    count(*) FILTER (WHERE cancelled_at IS NOT NULL AND paid_at IS NULL) AS cancelled_before_payment,
    count(*) FILTER (WHERE cancelled_at IS NOT NULL AND paid_at IS NOT NULL) AS cancelled_after_payment,
    count(*) FILTER (WHERE cancelled_at IS NOT NULL AND refunded_at IS NULL) AS cancelled_not_yet_refunded,
    CAST(coalesce(sum(final_price) FILTER (WHERE cancelled_at IS NOT NULL AND paid_at IS NOT NULL), 0) AS DOUBLE) AS total_revenue_lost,
    avg(CASE WHEN cancelled_at IS NOT NULL THEN {_hours("created_at", "cancelled_at")} END) AS avg_hours_to_cancel,
    {_half_up("count(cancelled_at)", "count(*)", 4)} AS cancellation_rate,
    {_half_up("count(*) FILTER (WHERE cancelled_at IS NOT NULL AND paid_at IS NOT NULL)", "count(paid_at)", 4)} AS cancelled_after_payment_rate
  FROM tickets GROUP BY 1, 2, 3
)"""

_SECONDS_CREATED = "sum(date_diff('second', created_at, refunded_at))"
_REFUND = f"""refund AS (
  SELECT CAST(refunded_at AS DATE) AS refund_date, route_sk_id, class_id, count(*) AS total_tickets_refunded,
    CAST(sum(final_price) AS DOUBLE) AS total_refund_amount,
    {_half_up(_CENTS, "count(*)", 0)} / 100 AS avg_refund_amount,
    {_half_up("sum(date_diff('second', cancelled_at, refunded_at))", "(86400 * count(cancelled_at))", 2)} AS avg_days_cancel_to_refund,
    {_half_up(_SECONDS_CREATED, "(3600 * count(*))", 2)} AS avg_hours_to_refund,
    {_half_up(_SECONDS_CREATED, "(86400 * count(*))", 2)} AS avg_days_created_to_refund,
    count(*) FILTER (WHERE has_promo) AS total_refunded_with_promo,
    count(*) FILTER (WHERE family_flag) AS total_refunded_with_family_flag
  FROM tickets WHERE refunded_at IS NOT NULL GROUP BY 1, 2, 3
)"""

_PERFORMANCE = """performance AS (
  SELECT f.departure_date, f.train_sk_id, t.name, t.type, t.capacity,
    count(paid_at) AS total_tickets_sold, count(cancelled_at) AS total_cancelled_tickets,
    count(*) FILTER (WHERE cancelled_at IS NULL AND paid_at IS NOT NULL) AS net_tickets_sold,
    CAST(coalesce(sum(final_price) FILTER (WHERE cancelled_at IS NULL AND paid_at IS NOT NULL), 0) AS DOUBLE) AS total_revenue,
    count(*) FILTER (WHERE family_flag) AS family_ticket_count,
    count(*) FILTER (WHERE has_promo) AS promo_ticket_count,
    coalesce(bool_or(cancelled_at > departure_date), false) AS cancelled_after_departure_flag,
    round(count(*) FILTER (WHERE cancelled_at IS NULL AND paid_at IS NOT NULL) / t.capacity * 100, 2) AS occupancy_rate,
    count(*) FILTER (WHERE cancelled_at IS NULL AND paid_at IS NOT NULL) >= t.capacity AS is_fully_booked
  FROM tickets f LEFT JOIN trains t ON f.train_sk_id = t.sk_id AND f.departure_date >= t.start_date
    AND (t.end_date IS NULL OR f.departure_date < t.end_date)
  GROUP BY f.departure_date, f.train_sk_id, t.name, t.type, t.capacity
)"""

ORACLE: dict[str, str] = {}

ORACLE["revenue_daily"] = f"{_with(_LINES, _TICKETS, _REVENUE)} SELECT {_REVENUE_OUT} FROM revenue"
ORACLE["cancellation_summary"] = (
    f"{_with(_LINES, _TICKETS, _CANCELLATION)} "
    "SELECT * REPLACE (CAST(booking_date AS VARCHAR) AS booking_date) FROM cancellation"
)
ORACLE["refund_loss"] = (
    f"{_with(_LINES, _TICKETS, _REFUND)} "
    "SELECT * REPLACE (CAST(refund_date AS VARCHAR) AS refund_date) FROM refund"
)
ORACLE["train_performance"] = f"{_with(_LINES, _TICKETS, _TRAINS, _PERFORMANCE)} SELECT * FROM performance"
ORACLE["revenue_by_route_week"] = f"""{_FACT}
SELECT route_sk_id, CAST(weekofyear(created_at) AS INTEGER) AS week, CAST(month(created_at) AS INTEGER) AS month,
  CAST(year(created_at) AS INTEGER) AS year, CAST(sum(final_price) AS DOUBLE) AS total_revenue
FROM tickets WHERE active_status_id = 1 GROUP BY 1, 2, 3, 4"""
ORACLE["revenue_by_day"] = f"""{_FACT}
SELECT CAST(day(created_at) AS INTEGER) AS day, CAST(month(created_at) AS INTEGER) AS month,
  CAST(year(created_at) AS INTEGER) AS year, CAST(sum(final_price) AS DOUBLE) AS total_revenue
FROM tickets WHERE active_status_id = 1 GROUP BY 1, 2, 3"""

# --- cleaning ----------------------------------------------------------------------------------------

_RAW_EVENTS = """raw_events AS (
  SELECT 1 AS id, o_orderdate AS created_at, CASE WHEN o_orderstatus = 'O' THEN ' UNPAID ' ELSE 'Paid' END AS status, lines.* FROM lines
  UNION ALL SELECT 2, cancel_time, 'Cancelled ', lines.* FROM lines WHERE cancel_time IS NOT NULL
  UNION ALL SELECT 3, refund_time, 'refunded', lines.* FROM lines WHERE refund_time IS NOT NULL
)"""

_EVENTS = """events_clean AS (
  SELECT 'tkt-' || ticket_key AS ticket_id, id, CAST(l_suppkey + 1 AS INTEGER) AS route_id,
    CAST(o_custkey + 1 AS INTEGER) AS passenger_id, n_regionkey + 1 AS train_id,
    CASE WHEN l_linestatus = 'F' THEN 'vip' ELSE 'regular' END AS class, lower(trim(status)) AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
      WHEN '3-MEDIUM' THEN 'e_wallet' WHEN '4-NOT SPECIFIED' THEN 'direct' END AS payment,
    CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS day_of_week, dayofweek(l_shipdate) IN (0, 6) AS is_weekend,
    CAST(greatest(date_diff('day', created_at, l_shipdate), 0) AS INTEGER) AS booking_lead_days,
    l_shipdate AS departure_date, created_at, price, discount,
    CAST(round(price * (1 - discount), 2) AS DECIMAL(18,2)) AS final_price,
    trunc(l_quantity / 10) > 1 AS family_flag, l_tax > 0.04 AS has_child, l_discount >= 0.08 AS has_promo
  FROM raw_events
)"""

_AS_DOUBLE = (
    "CAST(price AS DOUBLE) AS price, CAST(discount AS DOUBLE) AS discount, CAST(final_price AS DOUBLE) AS final_price"
)

ORACLE["bronze_cast"] = f"""{_with(_LINES, _RAW_EVENTS)}
SELECT id, ' TKT-' || ticket_key AS ticket_id, status, created_at, l_shipdate AS departure_date FROM raw_events"""
ORACLE["ticket_derivations"] = (
    f"{_with(_LINES, _RAW_EVENTS, _EVENTS)} SELECT * REPLACE ({_AS_DOUBLE}) FROM events_clean"
)
_CLEAN_PASSENGERS = """clean_passengers AS (
  SELECT CAST(c_custkey + 1 AS INTEGER) AS id, lower(c_name) AS name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'male' WHEN 'FURNITURE' THEN 'female' WHEN 'HOUSEHOLD' THEN 'other'
      ELSE 'unknown' END AS gender,
    lpad(CAST(c_custkey AS VARCHAR), 11, '7') AS phone,
    CASE WHEN c_acctbal > 0 THEN 'user' || c_custkey || '@example.com' END AS email,
    true AS is_active, TIMESTAMP '1995-01-01' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date
  FROM customer
)"""
ORACLE["normalize_passengers"] = f"{_with(_CLEAN_PASSENGERS)} SELECT * FROM clean_passengers"
ORACLE["normalize_trains"] = """
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, CASE WHEN p_type = 'SMALL' THEN 'unknown' ELSE lower(p_type) END AS type,
  CASE WHEN p_size > 5 THEN p_size ELSE 0 END AS capacity, true AS is_active, TIMESTAMP '1995-01-01' AS start_date,
  CAST(NULL AS TIMESTAMP) AS end_date
FROM part"""
ORACLE["normalize_stations"] = """
SELECT n_nationkey + 1 AS id, lower(n_name) AS name, CASE WHEN n_regionkey > 0 THEN 'city ' || n_regionkey ELSE 'unknown' END AS city,
  'n' || n_nationkey AS code, false AS is_deleted
FROM nation"""
ORACLE["normalize_routes"] = """
SELECT CAST(s_suppkey + 1 AS INTEGER) AS id, 'n' || s_nationkey AS origin, 'n' || ((s_nationkey + 1) % 25) AS destination,
  CAST(s_suppkey % 5 + 1 AS INTEGER) AS train_id, CAST(s_nationkey * 10 + 100 AS INTEGER) AS distance_km,
  CAST(s_nationkey * 6 + 60 AS INTEGER) AS duration_minutes, false AS is_deleted
FROM supplier"""
ORACLE["surrogate_key_stats"] = """
SELECT count(*) AS rows, count(DISTINCT (o_orderkey, o_orderdate)) AS keys, CAST(0 AS BIGINT) AS negative FROM orders"""
ORACLE["dedup_by_key"] = """
SELECT l_orderkey, l_partkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey DESC, l_shipdate DESC) AS rn FROM lineitem
) WHERE rn = 1"""

# --- windows -----------------------------------------------------------------------------------------

ORACLE["incremental_window"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS rows FROM events
WHERE ts >= DATE '2024-01-08' AND ts < DATE '2024-01-22' GROUP BY 1, 2"""
ORACLE["incremental_window_text"] = """
SELECT c_mktsegment, count(*) AS rows FROM orders LEFT JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1999-09-15' GROUP BY 1"""

# --- histories ---------------------------------------------------------------------------------------

_STATUS = """status_events AS (
  SELECT user_id || '-' || strftime(ts, '%Y-%m-%d') AS ticket_id, user_id, event_id AS id, ts AS created_at,
    CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'error' THEN 'cancelled' WHEN 'signup' THEN 'refunded'
      ELSE 'unpaid' END AS status, value
  FROM events
)"""


def _collapse(source: str, key: str, name: str = "collapsed") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT {key} AS ticket_id, id, created_at, status,
      max(created_at) FILTER (WHERE status = 'paid') OVER k AS paid_at,
      max(created_at) FILTER (WHERE status = 'cancelled') OVER k AS cancelled_at,
      max(created_at) FILTER (WHERE status = 'refunded') OVER k AS refunded_at,
      min(created_at) OVER k AS first_created_at, value,
      row_number() OVER (PARTITION BY {key} ORDER BY created_at DESC, id DESC) AS rn
    FROM {source} WINDOW k AS (PARTITION BY {key})
  ) WHERE rn = 1
)"""


ORACLE["latest_event"] = (
    f"{_with(_STATUS, _collapse('status_events', 'ticket_id'))} SELECT ticket_id, id, created_at, status, value FROM collapsed"
)
ORACLE["event_milestones"] = (
    f"{_with(_STATUS, _collapse('status_events', 'ticket_id'))} "
    "SELECT ticket_id, status, paid_at, cancelled_at, refunded_at, first_created_at FROM collapsed"
)
ORACLE["nth_event"] = f"""{_with(_STATUS)}
SELECT ticket_id, id, created_at, status, value, CAST(rank_id AS INTEGER) AS rank_id FROM (
  SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY created_at, id) AS rank_id FROM status_events
) WHERE rank_id = 2"""
_TOUCHED = """touched AS (
  SELECT * FROM status_events WHERE ticket_id IN (
    SELECT ticket_id FROM status_events WHERE created_at >= DATE '2024-01-08' AND created_at < DATE '2024-01-22')
)"""
ORACLE["touched_history"] = (
    f"{_with(_STATUS, _TOUCHED, _collapse('touched', 'ticket_id'))} SELECT * EXCLUDE (first_created_at, value) FROM collapsed"
)
ORACLE["fact_fold"] = (
    f"{_with(_STATUS, _collapse('status_events', 'CAST(user_id AS VARCHAR)'))} "
    "SELECT * EXCLUDE (first_created_at, value) FROM collapsed"
)

# --- joins -------------------------------------------------------------------------------------------

ORACLE["route_enrich"] = """
SELECT s_suppkey + 1000 AS sk_id, CAST(s_suppkey + 1 AS INTEGER) AS id, CAST(o.n_nationkey + 100 AS BIGINT) AS sk_org_station_id,
  CAST(d.n_nationkey + 100 AS BIGINT) AS sk_dest_station_id, CAST(r_regionkey AS BIGINT) AS sk_train_id
FROM supplier
JOIN nation o ON o.n_nationkey = s_nationkey AND o.n_regionkey <> 4
JOIN nation d ON d.n_nationkey = 24 - s_nationkey AND d.n_regionkey <> 4
JOIN region ON r_regionkey = s_suppkey % 5 AND r_regionkey % 2 = 0"""

_CLASS_ID = "CASE class WHEN 'vip' THEN 1 WHEN 'family' THEN 2 WHEN 'regular' THEN 3 WHEN 'promo' THEN 4 END"
_STATUS_ID = "CASE status WHEN 'paid' THEN 1 WHEN 'unpaid' THEN 2 WHEN 'cancelled' THEN 3 WHEN 'refunded' THEN 4 END"
_PAYMENT_ID = "CASE payment WHEN 'credit_card' THEN 1 WHEN 'debit_card' THEN 2 WHEN 'e_wallet' THEN 3 END"
ORACLE["ticket_lookups"] = f"""{_with(_LINES, _RAW_EVENTS, _EVENTS)}
SELECT ticket_id, id, route_id, class, status, payment, s_suppkey + 1000 AS route_sk_id, {_CLASS_ID} AS class_id,
  {_STATUS_ID} AS status_id, {_PAYMENT_ID} AS payment_id
FROM events_clean LEFT JOIN supplier ON s_suppkey + 1 = route_id"""

_PASSENGERS = """passengers AS (
  SELECT c_custkey + 1 AS id, c_custkey * 4 AS sk_id, TIMESTAMP '1995-01-01' AS start_date,
    CASE WHEN c_acctbal < 0 THEN TIMESTAMP '1998-01-01' END AS end_date
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT c_custkey + 1, c_custkey * 4 + 1, TIMESTAMP '1998-01-01', NULL
  FROM customer WHERE c_mktsegment = 'MACHINERY' OR c_acctbal < 0
)"""
_ASOF_ORDERS = f"""{_with(_PASSENGERS)}
SELECT o_orderkey, o_custkey + 1 AS passenger_id, o_orderdate, sk_id AS passenger_sk_id
FROM orders LEFT JOIN passengers ON id = o_custkey + 1 AND o_orderdate >= start_date
  AND (end_date IS NULL OR o_orderdate < end_date)"""
ORACLE["asof_passenger"] = _ASOF_ORDERS
ORACLE["asof_passenger_hot"] = _ASOF_ORDERS
ORACLE["asof_hot_day"] = f"""{_with(_PASSENGERS)}
SELECT o_custkey + 1 AS passenger_id, sk_id AS passenger_sk_id, count(*) AS lines, max(TIMESTAMP '1998-01-01' + to_seconds(l_linenumber)) AS last_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN passengers ON id = o_custkey + 1 AND TIMESTAMP '1998-01-01' + to_seconds(l_linenumber) >= start_date
  AND (end_date IS NULL OR TIMESTAMP '1998-01-01' + to_seconds(l_linenumber) < end_date)
GROUP BY 1, 2"""
ORACLE["asof_train"] = f"""{_with(_LINES, _TICKETS, _TRAINS)}
SELECT ticket_id, CAST(route_sk_id + 1 AS INTEGER) AS train_id, departure_date, t.sk_id AS train_sk_id, t.name
FROM tickets LEFT JOIN trains t ON t.id = route_sk_id + 1 AND departure_date >= start_date
  AND (end_date IS NULL OR departure_date < end_date)"""

_SILVER = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY created_at DESC, id DESC) AS rn,
      max(CASE WHEN status = 'paid' THEN created_at END) OVER (PARTITION BY ticket_id) AS paid_at,
      max(CASE WHEN status = 'cancelled' THEN created_at END) OVER (PARTITION BY ticket_id) AS cancelled_at,
      max(CASE WHEN status = 'refunded' THEN created_at END) OVER (PARTITION BY ticket_id) AS refunded_at,
      min(created_at) OVER (PARTITION BY ticket_id) AS first_created_at
    FROM events_clean
  ) WHERE rn = 1
),
silver AS (
  SELECT ticket_id, s_suppkey + 1000 AS route_sk_id, p.sk_id AS passenger_sk_id, t.sk_id AS train_sk_id,
    {_CLASS_ID} AS class_id, {_PAYMENT_ID} AS payment_id, {_STATUS_ID} AS active_status_id, day_of_week,
    booking_lead_days, departure_date, paid_at, cancelled_at, refunded_at, created_at, price, discount, final_price,
    family_flag, has_child, has_promo, is_weekend, first_created_at
  FROM latest
  LEFT JOIN supplier ON s_suppkey + 1 = route_id
  LEFT JOIN trains t ON t.id = train_id AND departure_date >= t.start_date AND (t.end_date IS NULL OR departure_date < t.end_date)
  LEFT JOIN passengers p ON p.id = passenger_id AND departure_date >= p.start_date AND (p.end_date IS NULL OR departure_date < p.end_date)
)"""
_SILVER_WITH = _with(_LINES, _RAW_EVENTS, _EVENTS, _TRAINS, _PASSENGERS, _SILVER)
ORACLE["silver_tickets"] = f"{_SILVER_WITH} SELECT * REPLACE ({_AS_DOUBLE}) FROM silver"

# --- merges ------------------------------------------------------------------------------------------

_STATIONS = """stored AS (
  SELECT c_custkey * 4 AS sk_id, c_custkey AS id, lower(c_name) AS name, 'city_' || c_nationkey AS city,
    lower(substr(c_mktsegment, 1, 4)) AS code, c_acctbal < 0 AS is_deleted
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
),
batch AS (
  SELECT c_custkey * 4 + 1 AS sk_id, c_custkey AS id, lower(c_name) AS name,
    CASE WHEN c_acctbal > 5000 THEN NULL WHEN c_acctbal < 1000 THEN 'city_99' ELSE 'city_' || c_nationkey END AS city,
    lower(substr(c_mktsegment, 1, 4)) AS code, false AS is_deleted
  FROM customer WHERE c_acctbal < 6000
)"""


def _scd1(changed: str, absent: str) -> str:
    return f"""{_with(_STATIONS)}
SELECT t.sk_id, t.id, CASE WHEN {changed} THEN s.name ELSE t.name END AS name,
  CASE WHEN {changed} THEN s.city ELSE t.city END AS city, CASE WHEN {changed} THEN s.code ELSE t.code END AS code,
  CASE WHEN s.id IS NULL THEN {absent} WHEN {changed} THEN false ELSE t.is_deleted END AS is_deleted
FROM stored t LEFT JOIN batch s ON s.id = t.id
UNION ALL SELECT s.* FROM batch s WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.id = s.id)"""


_SAFE = "(s.id IS NOT NULL AND (s.name IS DISTINCT FROM t.name OR s.city IS DISTINCT FROM t.city OR s.code IS DISTINCT FROM t.code OR t.is_deleted))"
_UNSAFE = "(s.id IS NOT NULL AND coalesce(s.name <> t.name OR s.city <> t.city OR s.code <> t.code OR t.is_deleted, false))"
ORACLE["scd1_upsert"] = _scd1(_SAFE, "t.is_deleted")
ORACLE["scd1_snapshot"] = _scd1(_SAFE, "true")
ORACLE["scd1_null_unsafe"] = _scd1(_UNSAFE, "t.is_deleted")
ORACLE["scd1_soft_delete"] = f"""{_with(_STATIONS)}
SELECT sk_id, id, name, city, code, is_deleted OR NOT EXISTS (SELECT 1 FROM batch s WHERE s.id = t.id) AS is_deleted FROM stored t"""

_LOADS = """stored AS (
  SELECT c_custkey * 4 AS sk_id, c_custkey AS id, lower(c_name) AS name, lower(c_mktsegment) AS gender,
    CASE WHEN c_acctbal NOT BETWEEN 7500 AND 8500 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '9') END AS phone,
    CAST(NULL AS VARCHAR) AS email
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
),
batch AS (
  SELECT c_custkey * 4 + 1 AS sk_id, c_custkey AS id, lower(c_name) AS name,
    CASE WHEN c_acctbal < 0 THEN 'collection' ELSE lower(c_mktsegment) END AS gender,
    CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal > 7500 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '8')
      WHEN c_acctbal NOT BETWEEN 7500 AND 8500 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '9') END AS phone,
    CAST(NULL AS VARCHAR) AS email
  FROM customer
)"""
_NO_END = "CAST(NULL AS TIMESTAMP)"


def _scd2(changed: str) -> str:
    return f"""{_with(_LOADS)}
SELECT t.*, NOT ({changed}) AS is_active, TIMESTAMP '1995-01-01' AS start_date,
  CASE WHEN {changed} THEN TIMESTAMP '1998-01-01' END AS end_date
FROM stored t JOIN batch s ON s.id = t.id
UNION ALL
SELECT s.*, true, TIMESTAMP '1998-01-01', {_NO_END}
FROM batch s LEFT JOIN stored t ON s.id = t.id WHERE t.id IS NULL OR ({changed})"""


_CHANGED = "s.gender IS DISTINCT FROM t.gender OR s.phone IS DISTINCT FROM t.phone"
ORACLE["scd2_merge"] = _scd2(_CHANGED)
ORACLE["publish_dimension"] = _scd2(_CHANGED)
ORACLE["scd2_expire_and_open"] = _scd2(_CHANGED)
ORACLE["merge_idempotent"] = _scd2(_CHANGED)
ORACLE["scd2_null_unsafe"] = _scd2("coalesce(s.gender <> t.gender OR s.phone <> t.phone, false)")
ORACLE["scd2_multi_version"] = f"""{_with(_LOADS)},
after_second AS (
  SELECT t.*, TIMESTAMP '1995-01-01' AS start_date FROM stored t
  UNION ALL
  SELECT s.*, TIMESTAMP '1998-01-01' FROM batch s LEFT JOIN stored t ON s.id = t.id WHERE t.id IS NULL OR ({_CHANGED})
),
late AS (
  SELECT c_custkey * 4 + 2 AS sk_id, c_custkey AS id, lower(c_name) AS name, 'late' AS gender,
    CASE WHEN c_acctbal NOT BETWEEN 7500 AND 8500 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '9') END AS phone,
    CAST(NULL AS VARCHAR) AS email, TIMESTAMP '1996-06-01' AS start_date
  FROM customer
),
missing AS (
  SELECT s.*, TIMESTAMP '1998-01-01' AS start_date FROM batch s
  WHERE NOT EXISTS (SELECT 1 FROM after_second v WHERE v.id = s.id AND v.start_date = TIMESTAMP '1998-01-01')
),
chain AS (SELECT * FROM after_second UNION ALL SELECT * FROM late UNION ALL SELECT * FROM missing)
SELECT sk_id, id, name, gender, phone, email,
  lead(start_date) OVER (PARTITION BY id ORDER BY start_date) IS NULL AS is_active, start_date,
  lead(start_date) OVER (PARTITION BY id ORDER BY start_date) AS end_date
FROM chain"""

ORACLE["scd2_with_gaps"] = f"""{_with(_LOADS)},
rows AS (
  SELECT *, 0 AS n, TIMESTAMP '1995-01-01' AS start_date, CASE WHEN id % 3 = 0 THEN TIMESTAMP '1995-06-01'
    WHEN id % 2 = 0 THEN TIMESTAMP '1996-01-01' END AS end_date FROM stored
  UNION ALL
  SELECT * REPLACE ('moved' AS gender), 2, TIMESTAMP '1995-06-01',
    CASE WHEN id % 2 = 0 THEN TIMESTAMP '1996-01-01' ELSE TIMESTAMP '1997-01-01' END FROM stored WHERE id % 3 = 0
  UNION ALL
  SELECT *, 3, TIMESTAMP '1997-01-01', NULL FROM stored WHERE id % 3 = 0 OR id % 2 = 0
)
SELECT * EXCLUDE (n) REPLACE (sk_id + n AS sk_id), end_date IS NULL AS is_active FROM rows"""

_ORDER_LOADS = """stored AS (
  SELECT o_orderkey AS ticket_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate AS created_at
  FROM orders WHERE o_orderpriority <> '1-URGENT'
),
batch AS (
  SELECT o_orderkey AS ticket_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
    CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_totalprice < 100000 THEN 1 ELSE 0 END AS price,
    CASE WHEN o_totalprice < 100000 THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS created_at
  FROM orders WHERE o_orderdate >= DATE '1997-01-01'
)"""
_UPSERTED = f"""{_with(_ORDER_LOADS)}
SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM (
  SELECT * FROM batch UNION ALL SELECT * FROM stored t WHERE NOT EXISTS (SELECT 1 FROM batch s WHERE s.ticket_id = t.ticket_id)
)"""
ORACLE["fact_upsert"] = _UPSERTED
ORACLE["publish_roundtrip"] = _UPSERTED
ORACLE["fact_upsert_null_unsafe"] = f"""{_with(_ORDER_LOADS)},
paired AS (
  SELECT t.ticket_id AS old_id, t.status AS old_status, t.price AS old_price, t.created_at AS old_at, s.*,
    t.ticket_id IS NULL OR coalesce(s.status <> t.status OR s.price <> t.price OR s.created_at <> t.created_at, false) AS takes
  FROM stored t FULL JOIN batch s ON s.ticket_id = t.ticket_id
)
SELECT coalesce(ticket_id, old_id) AS ticket_id, CASE WHEN takes THEN status ELSE old_status END AS status,
  CAST(CASE WHEN takes THEN price ELSE old_price END AS DOUBLE) AS price,
  CASE WHEN takes THEN created_at ELSE old_at END AS created_at
FROM paired"""

_REVENUE_LOADS = _REVENUE.replace("revenue AS (", "stored AS (", 1).replace(
    "WHERE paid_at IS NOT NULL", "WHERE paid_at IS NOT NULL AND refunded_at IS NULL"
)
_SAME = (
    "t.total_tickets = s.total_tickets AND t.gross = s.gross AND t.reduced = s.reduced AND t.net = s.net AND t.refunded = s.refunded"
)


def _aggregate(match: str, kept: str) -> str:
    return f"""{_with(_LINES, _TICKETS, _REVENUE, _REVENUE_LOADS)},
merged AS (
  SELECT s.*, CASE WHEN {_SAME} THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2001-01-01' END AS updated_at
  FROM revenue s LEFT JOIN stored t ON {match}
  {kept}
)
SELECT {_REVENUE_OUT}, updated_at FROM merged"""


ORACLE["aggregate_upsert"] = _aggregate(
    "t.revenue_date = s.revenue_date AND t.route_sk_id = s.route_sk_id AND t.class_id IS NOT DISTINCT FROM s.class_id",
    "",
)
ORACLE["aggregate_upsert_plain_keys"] = _aggregate(
    "t.revenue_date = s.revenue_date AND t.route_sk_id = s.route_sk_id AND t.class_id = s.class_id",
    "UNION ALL SELECT t.*, TIMESTAMP '2000-01-01' FROM stored t WHERE t.class_id IS NULL",
)

_NEW_ONLY = f"""{_with(_LOADS)}
SELECT id, name, gender FROM batch s WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.id = s.id)"""
ORACLE["new_only_anti"] = _NEW_ONLY
ORACLE["new_only_left_join"] = _NEW_ONLY
ORACLE["missing_not_exists"] = f"""{_with(_STATIONS)}
SELECT id, name FROM stored t WHERE NOT is_deleted AND id NOT IN (SELECT id FROM batch)"""
ORACLE["partition_overwrite"] = f"""{_with(_ORDER_LOADS)}
SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM (
  SELECT * FROM batch UNION ALL SELECT * FROM stored WHERE date_trunc('month', created_at) NOT IN (SELECT date_trunc('month', created_at) FROM batch)
)"""
ORACLE["append_rows"] = f"""{_with(_ORDER_LOADS)}
SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM (SELECT * FROM stored UNION ALL SELECT * FROM batch)"""
ORACLE["truncate_and_reload"] = f"""{_with(_ORDER_LOADS)}
SELECT * REPLACE (CAST(price AS DOUBLE) AS price), CAST(0 AS BIGINT) AS rows_between FROM batch"""
ORACLE["ordered_write"] = "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS inversions FROM lineitem"
ORACLE["warehouse_revenue"] = f"""{_with(_LINES, _RAW_EVENTS, _EVENTS, _TRAINS, _PASSENGERS, _SILVER)}
SELECT CAST(CAST(paid_at AS DATE) AS VARCHAR) AS revenue_date, class_id, count(*) AS total_tickets,
  CAST(sum(final_price) AS DOUBLE) AS net_revenue,
  CAST(coalesce(sum(final_price) FILTER (WHERE refunded_at IS NOT NULL), 0) AS DOUBLE) AS refunded_revenue
FROM silver WHERE paid_at IS NOT NULL GROUP BY 1, 2"""

_SOURCE_TRAINS = """trains AS (
  SELECT r_regionkey AS sk_id, r_regionkey + 1 AS id, lower(r_name) || ' express' AS name,
    CASE WHEN r_regionkey > 0 THEN 'business' ELSE 'unknown' END AS type, r_regionkey + 1500 AS capacity,
    TIMESTAMP '1995-01-01' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date
  FROM region
)"""
_SUMMARIES = {
    "cancellation_summary": "cancellation",
    "revenue_daily": f"(SELECT {_REVENUE_OUT} FROM revenue)",
    "refund_loss": "refund",
    "train_performance": "performance",
}


def _metrics() -> str:
    lines = []
    for name, (day, cls, metrics) in SUMMARY_METRICS.items():
        for metric in metrics.split():
            lines.append(
                f"SELECT '{name}' AS summary, CAST(CAST({day} AS DATE) AS VARCHAR) AS day, {cls or 'CAST(NULL AS INTEGER)'} AS class_id, "
                f"'{metric}' AS metric, round(sum(CAST({metric} AS DOUBLE)), 4) AS value FROM {_SUMMARIES[name]} GROUP BY 2, 3"
            )
    return "\nUNION ALL ".join(lines)


ORACLE["gold_after_second_window"] = f"""{_with(
    _LINES, _RAW_EVENTS, _EVENTS, _SOURCE_TRAINS, _PASSENGERS, _SILVER, "tickets AS (SELECT * FROM silver)",
    _CANCELLATION, _REVENUE, _REFUND, _PERFORMANCE,
)}
{_metrics()}"""

# --- quality -----------------------------------------------------------------------------------------


def _line(name, kind, level, checked, bad, metric, passed) -> str:
    return (
        f"SELECT '{name}' AS rule, '{kind}' AS kind, '{level}' AS level, CAST({checked} AS BIGINT) AS checked, "
        f"CAST({bad} AS BIGINT) AS violations, CAST({metric} AS DOUBLE) AS metric, {passed} AS passed"
    )


def _share_line(source, name, kind, bad_when, level="error", passed="{share} >= 1") -> str:
    bad = f"count(*) FILTER (WHERE {bad_when})"
    metric = f"1.0::DOUBLE - coalesce({bad} / nullif(count(*), 0), 0)"
    return f"{_line(name, kind, level, 'count(*)', bad, metric, passed.format(share=f'({metric})'))} FROM {source}"


def _measure_line(source, name, kind, measure, bad_when, level="error") -> str:
    bad = f"count(*) FILTER (WHERE {bad_when})"
    return f"{_line(name, kind, level, 'count(*)', bad, measure, f'{measure} IS NOT NULL AND {bad} = 0')} FROM {source}"


def _unique_line(source, name, kind, keys, where="true", level="error") -> str:
    groups = f"(SELECT count(*) AS n FROM {source} WHERE ({where}) GROUP BY {keys})"
    bad = "coalesce(sum(n) FILTER (WHERE n > 1), 0)"
    metric = f"1.0::DOUBLE - coalesce({bad} / nullif(sum(n), 0), 0)"
    return f"{_line(name, kind, level, 'coalesce(sum(n), 0)', bad, metric, f'{bad} = 0')} FROM {groups}"


def _all(*lines: str, head: str = "") -> str:
    return head + "\n" + "\nUNION ALL ".join(lines)


def _complete(source, *columns, level="error") -> list[str]:
    return [_share_line(source, f"{c} is complete", "complete", f"{c} IS NULL", level) for c in columns]


def _not_negative(source, *columns, level="error") -> list[str]:
    return [_share_line(source, f"{c} is not negative", "non_negative", f"{c} < 0", level) for c in columns]


def _holds(source, name, predicate, level="error", passed="{share} >= 1") -> str:
    return _share_line(source, name, "satisfies", f"NOT coalesce({predicate}, false)", level, passed)


def _size(source) -> str:
    return _measure_line(source, "table is not empty", "size", "nullif(count(*), 0)", "false")


def _bound(source, name, kind, column, bad_when, level="error") -> str:
    return _measure_line(source, name, kind, f"{kind[:3]}({column})", bad_when, level)


ORACLE["dq_complete"] = _all(
    *_complete("batch", "id", "name", "phone", "email"),
    _share_line("batch", "phone or email is complete", "any_complete", "phone IS NULL AND email IS NULL"),
    head=_with(_LOADS),
)
ORACLE["dq_unique"] = _all(
    _unique_line("lineitem", "l_orderkey is unique", "unique", "l_orderkey"),
    _unique_line("lineitem", "l_partkey is unique", "unique", "l_partkey"),
)
ORACLE["dq_grain"] = _all(
    _unique_line("lineitem", "l_orderkey, l_linenumber is unique", "grain", "l_orderkey, l_linenumber"),
    _unique_line(
        "lineitem", "l_orderkey, l_partkey, l_shipdate is unique", "grain", "l_orderkey, l_partkey, l_shipdate"
    ),
)
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ORACLE["dq_allowed"] = _all(
    _share_line("orders", "o_orderstatus in F, O", "contained", "o_orderstatus NOT IN ('F', 'O')"),
    _share_line(
        "orders", f"o_orderpriority in {', '.join(_PRIORITIES)}", "contained", f"o_orderpriority NOT IN {_PRIORITIES}"
    ),
)
ORACLE["dq_range"] = _all(
    _bound("lineitem", "min l_quantity >= 1", "min", "l_quantity", "l_quantity < 1"),
    _bound("lineitem", "min l_linenumber > 1", "min", "l_linenumber", "l_linenumber <= 1"),
    _bound("lineitem", "max l_discount <= 0.08", "max", "l_discount", "l_discount > 0.08::DOUBLE"),
    _bound("lineitem", "max l_tax <= 1", "max", "l_tax", "l_tax > 1"),
)
ORACLE["dq_length"] = _all(
    _bound("part", "p_name has 8 or more characters", "min_length", "length(p_name)", "length(p_name) < 8"),
    _bound("part", "p_name has 9 or fewer characters", "max_length", "length(p_name)", "length(p_name) > 9"),
    _bound("part", "p_brand has 3 or more characters", "min_length", "length(p_brand)", "length(p_brand) < 3"),
    _bound("part", "p_brand has 100 or fewer characters", "max_length", "length(p_brand)", "length(p_brand) > 100"),
)
ORACLE["dq_sign"] = _all(
    _share_line("customer", "c_acctbal is positive", "positive", "c_acctbal <= 0"),
    _share_line("customer", "c_custkey is positive", "positive", "c_custkey <= 0"),
    *_not_negative("customer", "c_acctbal", "c_custkey"),
)
ORACLE["dq_satisfies"] = _all(
    _holds("lineitem", "ships after 1995", "l_shipdate >= TIMESTAMP '1996-01-01'", passed="{share} >= 0.5"),
    _holds("lineitem", "ships before 2000", "l_shipdate < TIMESTAMP '2000-01-01'"),
    _holds("lineitem", "tax known when reduced", "CASE WHEN l_tax > 0 THEN l_discount < l_tax END", "warning"),
)
_EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
_CONTACT = """contact AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '7') AS phone,
    CASE WHEN c_acctbal > 0 THEN 'User' || c_custkey || '@Example.COM' END AS email FROM customer
)"""
ORACLE["dq_format"] = _all(
    _share_line("contact", "email format", "matches", f"NOT regexp_matches(email, '{_EMAIL}')"),
    _share_line("contact", "phone format", "matches", "NOT regexp_matches(phone, '^[0-9]{10,12}$')"),
    _share_line("contact", "phone starts with 77", "matches", "phone NOT LIKE '77%'"),
    head=_with(_CONTACT),
)


def _resolves(table: str, key: str) -> str:
    missing = f"o_custkey NOT IN (SELECT {key} FROM {table})"
    return _share_line("orders", f"o_custkey resolves to {key}", "foreign_key", missing)


ORACLE["dq_fk"] = _all(_resolves("stored", "id"), _resolves("customer", "c_custkey"), head=_with(_LOADS))
ORACLE["dq_one_active"] = _all(
    _unique_line("(SELECT id FROM stored UNION ALL SELECT id FROM batch)", "one active row per id", "one_active", "id"),
    head=_with(_LOADS),
)
_GAP = "(SELECT count(*) FROM customer) - count(*)"
ORACLE["dq_rowcount"] = (
    f"{_with(_LOADS)} "
    + _line("row count equals source", "row_count", "error", "count(*)", _GAP, "(SELECT count(*) FROM customer)", f"{_GAP} = 0")
    + " FROM stored"
)
ORACLE["dq_freshness"] = _share_line(
    "orders", "o_orderdate within 2 days", "fresh", "o_orderdate < now()::TIMESTAMP - INTERVAL 2 DAY", passed="{share} > 0.5"
)

_CANCELLATION_GRAIN = "booking_date, route_sk_id, class_id"
ORACLE["dq_suite_cancellation_summary"] = _all(
    *_complete(
        "cancellation", "booking_date", "route_sk_id", "class_id", "total_tickets_created", "total_tickets_paid",
        "total_tickets_cancelled", "cancellation_rate",
    ),
    _unique_line("cancellation", f"{_CANCELLATION_GRAIN} is unique", "grain", _CANCELLATION_GRAIN),
    *_not_negative(
        "cancellation", "total_tickets_created", "total_tickets_paid", "total_tickets_cancelled", "total_tickets_refunded",
        "cancelled_before_payment", "cancelled_after_payment", "cancelled_not_yet_refunded", "total_revenue_lost",
    ),
    *_not_negative("cancellation", "avg_hours_to_cancel", level="warning"),
    _holds("cancellation", "cancellation rate is a fraction", "cancellation_rate >= 0 AND cancellation_rate <= 1"),
    _holds(
        "cancellation", "cancellations split by payment",
        "cancelled_before_payment + cancelled_after_payment = total_tickets_cancelled",
    ),
    _holds(
        "cancellation", "created covers paid and cancelled",
        "total_tickets_paid + total_tickets_cancelled <= total_tickets_created", "warning",
    ),
    _holds("cancellation", "refunded within cancelled", "total_tickets_refunded <= total_tickets_cancelled", "warning"),
    _holds("cancellation", "cancelled within created", "total_tickets_cancelled <= total_tickets_created"),
    _size("cancellation"),
    _share_line("cancellation", "updated_at within 2 days", "fresh", "false", passed="{share} > 0.5"),
    head=_with(_LINES, _TICKETS, _CANCELLATION),
)
_REFUND_GRAIN = "refund_date, route_sk_id, class_id"
ORACLE["dq_suite_refund_loss"] = _all(
    *_complete("refund", "refund_date", "route_sk_id", "class_id", "total_tickets_refunded", "total_refund_amount"),
    _unique_line("refund", f"{_REFUND_GRAIN} is unique", "grain", _REFUND_GRAIN),
    *_not_negative(
        "refund", "total_tickets_refunded", "total_refund_amount", "avg_refund_amount", "total_refunded_with_promo",
        "total_refunded_with_family_flag",
    ),
    *_not_negative(
        "refund", "avg_days_cancel_to_refund", "avg_hours_to_refund", "avg_days_created_to_refund", level="warning"
    ),
    _holds("refund", "total_refunded_with_promo within total", "total_refunded_with_promo <= total_tickets_refunded"),
    _holds(
        "refund", "total_refunded_with_family_flag within total", "total_refunded_with_family_flag <= total_tickets_refunded"
    ),
    _holds(
        "refund", "average refund follows total", "abs(avg_refund_amount - total_refund_amount / total_tickets_refunded) < 0.01"
    ),
    _holds(
        "refund", "refund follows booking later than cancellation",
        "avg_days_created_to_refund >= avg_days_cancel_to_refund", "warning",
    ),
    _size("refund"),
    head=_with(_LINES, _TICKETS, _REFUND),
)
_SHOWN_REVENUE = "shown AS (SELECT * REPLACE (CAST(avg_ticket_price AS DECIMAL(18,2)) AS avg_ticket_price) FROM revenue)"
_REVENUE_NAMES = {
    "gross_revenue": "gross", "total_discount_calculated": "reduced", "net_revenue": "net", "refunded_revenue": "refunded",
}
_REVENUE_KEYS = "revenue_date, route_sk_id, class_id"
ORACLE["dq_suite_revenue_daily"] = _all(
    *_complete("shown", "revenue_date", "route_sk_id", "class_id", "total_tickets"),
    _share_line("shown", "gross_revenue is complete", "complete", "gross IS NULL"),
    _share_line("shown", "net_revenue is complete", "complete", "net IS NULL"),
    _unique_line("shown", f"{_REVENUE_KEYS} is unique", "grain", _REVENUE_KEYS),
    *_not_negative("shown", "total_tickets", "avg_ticket_price"),
    *[
        _share_line("shown", f"{name} is not negative", "non_negative", f"{column} < 0")
        for name, column in _REVENUE_NAMES.items()
    ],
    _holds("shown", "net after refund is not negative", "net - refunded >= 0", "warning"),
    _holds("shown", "net is gross less discount", "abs(net - (gross - reduced)) < 0.01"),
    _holds("shown", "net after refund is net less refunds", "true"),
    _holds("shown", "average price follows net", "abs(avg_ticket_price - net / total_tickets) < 0.01", "warning"),
    _holds("shown", "discount within gross", "reduced <= gross"),
    _holds("shown", "refunds within net", "refunded <= net"),
    _size("shown"),
    head=_with(_LINES, _TICKETS, _REVENUE, _SHOWN_REVENUE),
)
ORACLE["dq_suite_train_performance"] = _all(
    *_complete(
        "performance", "departure_date", "train_sk_id", "name", "capacity", "total_tickets_sold", "net_tickets_sold",
        "occupancy_rate", "is_fully_booked",
    ),
    _unique_line("performance", "departure_date, train_sk_id is unique", "grain", "departure_date, train_sk_id"),
    *_not_negative(
        "performance", "capacity", "total_tickets_sold", "total_cancelled_tickets", "net_tickets_sold", "total_revenue",
        "family_ticket_count", "promo_ticket_count",
    ),
    _holds("performance", "capacity is positive", "capacity > 0"),
    _holds(
        "performance", "net is sold less cancelled", "net_tickets_sold + total_cancelled_tickets = total_tickets_sold", "warning"
    ),
    _holds("performance", "net within capacity", "net_tickets_sold <= capacity"),
    _holds("performance", "cancelled within sold", "total_cancelled_tickets <= total_tickets_sold", "warning"),
    _holds("performance", "family_ticket_count within sold", "family_ticket_count <= total_tickets_sold", "warning"),
    _holds("performance", "promo_ticket_count within sold", "promo_ticket_count <= total_tickets_sold", "warning"),
    _holds("performance", "occupancy is a percentage", "occupancy_rate >= 0 AND occupancy_rate <= 100"),
    _holds(
        "performance", "occupancy follows capacity", "abs(occupancy_rate - 100 * net_tickets_sold / capacity) < 0.1", "warning"
    ),
    _holds(
        "performance", "booked flag follows capacity",
        "CASE WHEN is_fully_booked THEN net_tickets_sold = capacity ELSE net_tickets_sold < capacity END", "warning",
    ),
    _share_line(
        "performance", "type in economy, business, executive", "contained",
        "type NOT IN ('economy', 'business', 'executive')", "warning",
    ),
    _size("performance"),
    head=_with(_LINES, _TICKETS, _TRAINS, _PERFORMANCE),
)
ORACLE["dq_suite_tickets"] = _all(
    *_complete(
        "silver", "ticket_id", "route_sk_id", "passenger_sk_id", "train_sk_id", "class_id", "active_status_id", "day_of_week",
        "booking_lead_days", "departure_date", "price", "discount", "final_price", "is_weekend",
    ),
    *_complete("silver", "payment_id", level="warning"),
    _unique_line("silver", "ticket_id is unique", "unique", "ticket_id"),
    _bound("silver", "min price > 0", "min", "price", "price <= 0"),
    _bound("silver", "min discount >= 0", "min", "discount", "discount < 0"),
    _bound("silver", "max discount <= 1", "max", "discount", "discount > 1"),
    _bound("silver", "min final_price >= 0", "min", "final_price", "final_price < 0"),
    _bound("silver", "min booking_lead_days >= 0", "min", "booking_lead_days", "booking_lead_days < 0"),
    _bound("silver", "min day_of_week >= 1", "min", "day_of_week", "day_of_week < 1"),
    _bound("silver", "max day_of_week <= 7", "max", "day_of_week", "day_of_week > 7"),
    _holds("silver", "final price follows discount", "abs(final_price - price * (1 - discount)) < 0.01"),
    _holds("silver", "final price within price", "final_price <= price"),
    _holds("silver", "discount is a fraction", "discount >= 0 AND discount <= 1"),
    _holds("silver", "weekday is 1 to 7", "day_of_week >= 1 AND day_of_week <= 7"),
    _holds("silver", "weekend flag follows weekday", "is_weekend = (day_of_week = 1 OR day_of_week = 7)"),
    _size("silver"),
    head=_SILVER_WITH,
)

def _passenger_lines(source: str) -> list[str]:
    return [
        _share_line(source, "sk_id is complete", "complete", "false"),
        *_complete(source, "id", "name", "start_date", "is_active"),
        _share_line(source, "phone or email is complete", "any_complete", "phone IS NULL AND email IS NULL"),
        _share_line(source, "gender in male, female, unknown", "contained", "gender NOT IN ('male', 'female', 'unknown')", "warning"),
        _bound(source, "name has 3 or more characters", "min_length", "length(name)", "length(name) < 3", "warning"),
        _bound(source, "name has 100 or fewer characters", "max_length", "length(name)", "length(name) > 100", "warning"),
        _share_line(source, "email format", "matches", f"NOT regexp_matches(email, '{_EMAIL}')", "warning"),
        _share_line(source, "phone format", "matches", "NOT regexp_matches(phone, '^[0-9]{10,12}$')", "warning"),
        _bound(source, "min id > 0", "min", "id", "id <= 0"),
        _holds(source, "range ends after it starts", "end_date IS NULL OR end_date >= start_date"),
        _size(source),
    ]


ORACLE["dq_suite_passengers"] = _all(
    *_passenger_lines("clean_passengers"),
    _unique_line("clean_passengers", "sk_id is unique", "unique", "id"),
    head=_with(_CLEAN_PASSENGERS),
)
ORACLE["dq_table_states"] = f"""{_with(_CLEAN_PASSENGERS)},
versions AS (
  SELECT * REPLACE (id % 3 <> 0 AS is_active, CASE WHEN id % 3 = 0 THEN TIMESTAMP '1998-01-01' END AS end_date) FROM clean_passengers
  UNION ALL
  SELECT * REPLACE ('12' AS phone, TIMESTAMP '1998-01-01' AS start_date) FROM clean_passengers WHERE id % 3 = 0
)
""" + "\nUNION ALL ".join(_passenger_lines("versions"))
_ROUTES = """routes AS (
  SELECT s_suppkey AS sk_id, s_suppkey + 1 AS id, s_nationkey AS sk_org_station_id, (s_nationkey + 1) % 25 AS sk_dest_station_id,
    s_suppkey % 5 AS sk_train_id, s_nationkey * 10 + 100 AS distance_km, s_nationkey * 6 + 60 AS duration_minutes,
    false AS is_deleted
  FROM supplier
)"""
ORACLE["dq_suite_routes"] = _all(
    *_complete(
        "routes", "sk_id", "id", "sk_org_station_id", "sk_dest_station_id", "sk_train_id", "distance_km", "duration_minutes",
        "is_deleted",
    ),
    _unique_line("routes", "sk_id is unique", "unique", "sk_id"),
    _bound("routes", "min id > 0", "min", "id", "id <= 0"),
    _share_line("routes", "distance_km is positive", "positive", "distance_km <= 0"),
    _share_line("routes", "duration_minutes is positive", "positive", "duration_minutes <= 0"),
    _bound("routes", "max distance_km <= 10000", "max", "distance_km", "distance_km > 10000"),
    _bound("routes", "max duration_minutes <= 1440", "max", "duration_minutes", "duration_minutes > 1440"),
    _holds("routes", "origin differs from destination", "sk_org_station_id <> sk_dest_station_id", "warning"),
    _holds(
        "routes", "average speed 20 to 300 km/h", "distance_km / (duration_minutes / 60.0) BETWEEN 20 AND 300", "warning",
        "{share} >= 0.98",
    ),
    _size("routes"),
    head=_with(_ROUTES),
)
ORACLE["dq_suite_bronze"] = _all(
    *_complete("raw_events", "id", level="warning"),
    head=_with(_LINES, _RAW_EVENTS),
)
_CLEAN_TRAINS = f"clean_trains AS ({ORACLE['normalize_trains']})"
ORACLE["dq_suite_trains"] = _all(
    _share_line("clean_trains", "sk_id is complete", "complete", "false"),
    *_complete("clean_trains", "id", "name", "type", "capacity", "is_active", "start_date"),
    _unique_line("clean_trains", "sk_id is unique", "unique", "id"),
    _bound("clean_trains", "name has 3 or more characters", "min_length", "length(name)", "length(name) < 3", "warning"),
    _bound("clean_trains", "name has 100 or fewer characters", "max_length", "length(name)", "length(name) > 100", "warning"),
    _share_line(
        "clean_trains", "type in economy, business, executive, unknown", "contained",
        "type NOT IN ('economy', 'business', 'executive', 'unknown')", "warning",
    ),
    _bound("clean_trains", "min id > 0", "min", "id", "id <= 0"),
    _bound("clean_trains", "min capacity > 0", "min", "capacity", "capacity <= 0"),
    _bound("clean_trains", "max capacity <= 2000", "max", "capacity", "capacity > 2000"),
    _holds("clean_trains", "range ends after it starts", "end_date IS NULL OR end_date >= start_date"),
    _size("clean_trains"),
    head=_with(_CLEAN_TRAINS),
)
_CLEAN_STATIONS = f"clean_stations AS ({ORACLE['normalize_stations']})"
ORACLE["dq_suite_stations"] = _all(
    _share_line("clean_stations", "sk_id is complete", "complete", "false"),
    *_complete("clean_stations", "id", "name", "city", "code", "is_deleted"),
    _unique_line("clean_stations", "sk_id is unique", "unique", "id"),
    *[
        line
        for column, least, most in (("name", 3, 100), ("city", 2, 50), ("code", 2, 5))
        for line in (
            _bound("clean_stations", f"{column} has {least} or more characters", "min_length", f"length({column})", f"length({column}) < {least}", "warning"),
            _bound("clean_stations", f"{column} has {most} or fewer characters", "max_length", f"length({column})", f"length({column}) > {most}", "warning"),
        )
    ],
    _holds("clean_stations", "station code format", "regexp_matches(code, '^[a-z0-9]+$')", "warning"),
    _bound("clean_stations", "min id > 0", "min", "id", "id <= 0"),
    _size("clean_stations"),
    head=_with(_CLEAN_STATIONS),
)
ORACLE["incremental_window_pushed"] = ORACLE["incremental_window_text"]
_ORDER_LINE = """'{"_id":' || o_orderkey || ',"status":"' || o_orderstatus || '","cents":'"""
ORACLE["rescued_documents"] = f"""
WITH lines AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT 'read' AS part, o_orderkey AS order_key, o_orderstatus AS status, cents, CAST(NULL AS VARCHAR) AS document
FROM lines WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, {_ORDER_LINE} || CASE WHEN o_orderpriority = '5-LOW' THEN '"dear","more":[1]}}' ELSE cents::VARCHAR END
FROM lines WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"""
ORACLE["gated_runs"] = f"""{_with(_LINES, _RAW_EVENTS, _EVENTS)}
SELECT step, CASE WHEN step = 'may publish' THEN (SELECT count(DISTINCT ticket_id) FROM events_clean) ELSE 0 END AS published
FROM (VALUES ('nothing in the window'), ('routes missing'), ('other schema'), ('rules fail'), ('may publish')) AS t(step)"""
