"""The fixture views of ``fixtures/views.py`` and the pipeline chain, as
DuckDB SQL (CTEs). ``with_views(body)`` prefixes a query with exactly the
views it references (transitively), in definition order.

This is the independent oracle: it re-derives every intermediate table in
plain SQL instead of calling the Spark code.
"""

from __future__ import annotations

import re


def clip0(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest(({x}), 0.0::DOUBLE) END)"


def mins(a: str, b: str) -> str:
    """(b - a) in minutes."""
    return f"(date_diff('microsecond', {a}, {b}) / 6e7)"


def fmt(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def txt(x: str) -> str:
    """Mixed text layouts of the raw notebook orders."""
    return (f"(CASE lay WHEN 0 THEN strftime({x}, '%Y-%m-%d %H:%M:%S') "
            f"WHEN 1 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({x}, '%Y-%m-%dT%H:%M:%SZ') END)")


def norm(x: str) -> str:
    return f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


def _first_max_sql(vals: list[str], labels: list[str]) -> str:
    """The label of the largest value, the first listed among equal ones; a
    missing first value is never exceeded."""
    v = f"[{', '.join(vals)}]"
    return (f"(CASE WHEN ({vals[0]}) IS NULL THEN '{labels[0]}' "
            f"ELSE {labels!r}[list_position({v}, list_max({v}))] END)")


_S1 = "stage1_merchant_lag_min"
_BOTTLENECK = _first_max_sql(
    [_S1, "stage2_prep_overrun_min", "rider_store_wait_min",
     "coalesce(greatest(stage5_last_mile_min - 10.0::DOUBLE, 0.0::DOUBLE), 0.0::DOUBLE)"],
    ["MERCHANT_LAG", "KITCHEN_PREP_OVERRUN", "RIDER_WAIT_AT_STORE", "LAST_MILE_CONGESTION"])

def json_row(columns: str) -> str:
    """A row as JSON text, missing fields left out; columns are numbers unless ``name:text`` or ``name:time``."""
    fields = []
    for name, _, kind in (c.partition(":") for c in columns.split()):
        value = {"text": f"""'"' || {name} || '"'""", "time": f"""'"' || strftime({name}, '%Y-%m-%dT%H:%M:%S.%gZ') || '"'"""}.get(
            kind, f"CAST({name} AS VARCHAR)")
        fields.append(f"""'"{name}":' || {value}""")
    return "'{' || concat_ws(',', " + ", ".join(fields) + ") || '}'"


VIEWS: dict[str, str] = {}

VIEWS["nk"] = "SELECT max(o_orderkey) + 1 AS n FROM orders"

# ---- pipeline data set ----------------------------------------------------------
VIEWS["lc0"] = """SELECT o_orderkey AS k, o_custkey, (o_orderstatus = 'P' AND o_orderkey % 3 = 0) AS cancelled,
  o_orderdate + to_seconds(o_orderkey % 86400) AS placed FROM orders"""
VIEWS["v_lc"] = """SELECT k AS order_id, o_custkey AS customer_id, o_custkey AS merchant_id,
  CASE WHEN cancelled THEN 'CANCELLED' ELSE 'COMPLETED' END AS order_status,
  (cancelled AND k % 5 < 3) AS aborted, placed,
  placed + to_seconds((k * 7) % 720 - 400) AS printed,
  CASE WHEN k % 23 = 0 THEN NULL ELSE placed + to_seconds((k * 7) % 720 + 200 + (k * 13) % 1000) END AS ready,
  CASE WHEN cancelled AND k % 5 < 3 THEN NULL ELSE placed + to_seconds(900 + (k * 11) % 1500) END AS picked,
  CASE WHEN cancelled AND k % 5 < 3 THEN NULL
       ELSE placed + to_seconds(900 + (k * 11) % 1500 + (k * 17) % 1500 - 1410) END AS arrived,
  CASE WHEN cancelled AND k % 5 < 3 THEN NULL ELSE placed + to_seconds(1200 + (k * 11) % 1500 + (k * 19) % 900) END AS delivered,
  CAST(k % 17 AS INTEGER) AS queue_depth, CAST(360 + 180 * (k % 3) AS INTEGER) AS estimated_prep_sec
FROM lc0"""
VIEWS["src_orders"] = """SELECT order_id, customer_id, merchant_id,
  CASE WHEN order_id % 211 <> 5 THEN order_status END AS order_status, placed AS order_timestamp,
  placed + to_seconds(2100) AS promised_sla_timestamp FROM v_lc"""
VIEWS["src_merchants"] = """SELECT c_custkey AS merchant_id, c_name AS merchant_name, c_mktsegment AS cluster_id,
  'cuisine_' || CAST(c_nationkey % 6 AS VARCHAR) AS cuisine_type, CAST(4 + c_custkey % 9 AS INTEGER) AS kitchen_capacity,
  CAST(8 + c_custkey % 7 AS INTEGER) AS nominal_prep_min FROM customer"""
VIEWS["src_kds"] = """SELECT order_id AS kds_ticket_id, order_id, merchant_id, printed AS ticket_printed_at,
  ready AS food_ready_at, queue_depth AS active_kitchen_queue_depth, estimated_prep_sec FROM v_lc"""
VIEWS["att0"] = """SELECT *, unnest(generate_series(1, n)) AS a FROM
  (SELECT *, 1 + CAST(order_id % 7 = 0 AS INTEGER) + CAST(order_id % 21 = 0 AS INTEGER) AS n FROM v_lc)"""
VIEWS["src_dispatch"] = """SELECT order_id * 3 + a - 1 AS dispatch_id,
  CASE WHEN a = n OR order_id % 11 <> 0 THEN order_id END AS order_id, (order_id * 7 + a) % 500 AS driver_id,
  CAST(a AS INTEGER) AS attempt_number,
  CASE WHEN a < n THEN 'REJECTED' WHEN aborted THEN 'CANCELLED_BY_SYSTEM' ELSE 'COMPLETED' END AS dispatch_status,
  placed + to_seconds(a * 60) AS offered_at, placed + to_seconds(a * 60 + 20) AS responded_at,
  CASE WHEN a = n THEN arrived END AS arrived_at_store_at, CASE WHEN a = n THEN picked END AS picked_up_at,
  CASE WHEN a = n THEN delivered END AS delivered_at FROM att0"""
VIEWS["src_tickets"] = """SELECT event_id AS ticket_id,
  CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -1 - event_id
       ELSE (event_id * 5) % (SELECT n FROM nk) END AS order_id,
  user_id AS customer_id, ts AS created_at,
  CASE WHEN event_id % 60 = 0 THEN 'Late Delivery' WHEN event_id % 61 = 0 THEN 'late_delivery '
       WHEN event_id % 67 = 0 THEN 'ETA issue' WHEN event_id % 71 = 0 THEN NULL
       ELSE ['late_delivery', 'eta_changed', 'restaurant_delay'][event_id % 3 + 1] END AS category,
  props AS customer_message, CAST(round(value * 100) AS BIGINT) AS compensation_amount_cents,
  CAST(1 + event_id % 5 AS INTEGER) AS csat_score
FROM events WHERE event_type = 'error'"""

# ---- calibration chain -------------------------------------------------------------
VIEWS["q_term"] = "SELECT * FROM src_dispatch WHERE dispatch_status IN ('COMPLETED', 'CANCELLED_BY_SYSTEM')"
VIEWS["q_rej"] = "SELECT * FROM src_dispatch WHERE dispatch_status = 'REJECTED'"
VIEWS["q_jit0"] = """SELECT *, coalesce(arrived_at_store_at > picked_up_at, false) AS jitter_detected,
  date_diff('microsecond', picked_up_at, arrived_at_store_at) / 1e6 AS jitter_s FROM q_term"""
VIEWS["q_jit"] = """SELECT dispatch_id, order_id, driver_id, attempt_number, dispatch_status, offered_at, responded_at,
  CASE WHEN jitter_detected AND jitter_s <= 35 THEN picked_up_at - to_seconds(1) ELSE arrived_at_store_at END
    AS arrived_at_store_at,
  picked_up_at, delivered_at, jitter_detected,
  (jitter_detected AND jitter_s <= 35) AS network_jitter_clamped_flag,
  (jitter_detected AND jitter_s > 35) AS jitter_bad, jitter_s FROM q_jit0"""
VIEWS["q_kit0"] = """SELECT k.*, t.picked_up_at, o.order_timestamp FROM src_kds k
  LEFT JOIN (SELECT order_id, picked_up_at FROM q_term) t USING (order_id)
  LEFT JOIN (SELECT order_id, order_timestamp FROM src_orders) o USING (order_id)"""
VIEWS["q_kit1"] = """SELECT *, coalesce(ticket_printed_at < order_timestamp, false) AS back_viol,
  date_diff('microsecond', ticket_printed_at, order_timestamp) AS back_us FROM q_kit0"""
VIEWS["q_kit2"] = """SELECT *, (back_viol AND back_us <= 300000000) AS back_fix, (back_viol AND back_us > 300000000) AS back_bad,
  CASE WHEN back_viol AND back_us <= 300000000 THEN order_timestamp + to_seconds(15) ELSE ticket_printed_at END
    AS calibrated_ticket_printed_at,
  CASE WHEN back_viol AND back_us <= 300000000 THEN food_ready_at + to_microseconds(back_us) ELSE food_ready_at END
    AS ready1 FROM q_kit1"""
VIEWS["q_kit3"] = """SELECT *, coalesce(ready1 > picked_up_at, false) AS fwd_viol,
  date_diff('microsecond', picked_up_at, ready1) AS fwd_us FROM q_kit2"""
VIEWS["q_kit4"] = """SELECT *, (fwd_viol AND fwd_us <= 300000000) AS fwd_fix, (fwd_viol AND fwd_us > 300000000) AS fwd_bad,
  CASE WHEN fwd_viol AND fwd_us <= 300000000 THEN picked_up_at - to_seconds(30) ELSE ready1 END AS ready2 FROM q_kit3"""
VIEWS["q_kit"] = """SELECT kds_ticket_id, order_id, merchant_id, ticket_printed_at, food_ready_at, active_kitchen_queue_depth,
  estimated_prep_sec, picked_up_at, order_timestamp, calibrated_ticket_printed_at,
  (ready2 IS NULL AND picked_up_at IS NOT NULL) AS is_food_ready_imputed_flag,
  CASE WHEN ready2 IS NULL AND picked_up_at IS NOT NULL THEN picked_up_at - to_seconds(45) ELSE ready2 END
    AS calibrated_food_ready_at,
  (back_fix OR fwd_fix) AS clock_drift_calibrated_flag, back_viol AS backward_drift_detected,
  fwd_viol AS forward_drift_detected, (ready2 IS NULL AND picked_up_at IS NOT NULL) AS missing_ready_detected,
  back_bad, fwd_bad, back_us / 1e6 AS back_s, fwd_us / 1e6 AS fwd_s FROM q_kit4"""
_DISPATCH_JSON = json_row("dispatch_id order_id driver_id attempt_number dispatch_status:text offered_at:time responded_at:time "
                          "arrived_at_store_at:time picked_up_at:time delivered_at:time")
_KITCHEN_JSON = json_row("order_id kds_ticket_id merchant_id ticket_printed_at:time food_ready_at:time active_kitchen_queue_depth "
                         "estimated_prep_sec picked_up_at:time order_timestamp:time")
VIEWS["q_dlq"] = f"""SELECT CAST(order_id AS VARCHAR) AS entity_id, 'DISPATCH_API' AS source_system,
  'CRITICAL_TEMPORAL_INVERSION_PICKUP_ARRIVED' AS error_code,
  'Rider arrived at store ' || CAST(jitter_s AS VARCHAR) || 's AFTER pickup (exceeds 35s jitter limit)' AS error_description,
  'CRITICAL_DROP' AS severity, {_DISPATCH_JSON} AS raw_payload FROM q_jit WHERE jitter_bad
UNION ALL SELECT CAST(order_id AS VARCHAR), 'KDS_CSV', 'SEVERE_BACKWARD_CLOCK_DRIFT_EXCEEDS_5MIN',
  'KDS ticket printed ' || CAST(back_s AS VARCHAR) || 's BEFORE order was placed', 'CRITICAL_DROP', {_KITCHEN_JSON} FROM q_kit WHERE back_bad
UNION ALL SELECT CAST(order_id AS VARCHAR), 'KDS_CSV', 'SEVERE_FORWARD_CLOCK_DRIFT_EXCEEDS_5MIN',
  'KDS ready timestamp is ' || CAST(fwd_s AS VARCHAR) || 's after courier pickup', 'CRITICAL_DROP', {_KITCHEN_JSON} FROM q_kit WHERE fwd_bad"""
VIEWS["q_qid"] = "SELECT DISTINCT CAST(entity_id AS BIGINT) AS order_id FROM q_dlq"
VIEWS["s_orders"] = "SELECT * FROM src_orders ANTI JOIN q_qid USING (order_id)"
VIEWS["s_kds"] = "SELECT * FROM q_kit ANTI JOIN q_qid USING (order_id)"
VIEWS["s_disp"] = "SELECT * FROM q_jit ANTI JOIN q_qid USING (order_id)"
VIEWS["s_sup"] = """SELECT order_id, count(ticket_id) AS ticket_count, CAST(sum(compensation_amount_cents) AS BIGINT)
  AS refund_amount_cents, min(csat_score) AS min_csat FROM src_tickets WHERE order_id IS NOT NULL GROUP BY order_id"""

# ---- lifecycle fact ---------------------------------------------------------------------
VIEWS["f0"] = """SELECT o.order_id, o.customer_id, o.merchant_id, o.order_status, o.order_timestamp AS order_placed_at,
  m.merchant_name, m.cluster_id, m.cuisine_type, m.kitchen_capacity,
  k.calibrated_ticket_printed_at AS kds_printed_at, k.calibrated_food_ready_at AS kds_ready_at,
  k.active_kitchen_queue_depth, k.estimated_prep_sec, k.clock_drift_calibrated_flag, k.is_food_ready_imputed_flag,
  d.driver_id, d.attempt_number, d.offered_at, d.responded_at, d.arrived_at_store_at, d.picked_up_at, d.delivered_at,
  d.network_jitter_clamped_flag,
  CAST(coalesce(s.ticket_count, 0) AS INTEGER) AS ticket_count,
  CAST(coalesce(s.refund_amount_cents, 0) AS BIGINT) AS refund_amount_cents, s.min_csat
FROM s_orders o JOIN src_merchants m ON o.merchant_id = m.merchant_id
  JOIN s_kds k ON o.order_id = k.order_id
  LEFT JOIN s_disp d ON o.order_id = d.order_id
  LEFT JOIN s_sup s ON o.order_id = s.order_id"""
VIEWS["f1"] = f"""SELECT *,
  {clip0(mins('order_placed_at', 'kds_printed_at'))} AS stage1_merchant_lag_min,
  {mins('kds_printed_at', 'kds_ready_at')} AS actual_prep_min,
  estimated_prep_sec / 60.0::DOUBLE AS nominal_prep_min,
  {clip0(mins('kds_printed_at', 'arrived_at_store_at'))} AS stage3_dispatch_and_travel_min,
  {clip0('-' + mins('kds_ready_at', 'arrived_at_store_at'))} AS rider_store_wait_min,
  {clip0(mins('kds_ready_at', 'arrived_at_store_at'))} AS food_counter_dwell_min,
  {clip0(mins('arrived_at_store_at', 'picked_up_at'))} AS stage4_store_handoff_min,
  {clip0(mins('picked_up_at', 'delivered_at'))} AS stage5_last_mile_min,
  {mins('order_placed_at', 'delivered_at')} AS total_otd_min,
  order_status IS NOT DISTINCT FROM 'COMPLETED' AS is_completed
FROM f0"""
VIEWS["f2"] = f"""SELECT *, {clip0('actual_prep_min - nominal_prep_min')} AS stage2_prep_overrun_min,
  (coalesce(total_otd_min > 35.0, false) AND is_completed) AS is_sla_breached FROM f1"""
VIEWS["fact"] = f"""SELECT *, CASE WHEN NOT is_completed OR total_otd_min IS NULL THEN 'CANCELLED_OR_INCOMPLETE'
  ELSE {_BOTTLENECK} END AS primary_delay_bottleneck FROM f2"""

# ---- proofs ------------------------------------------------------------------------------------
VIEWS["v_lines"] = """SELECT l_orderkey * 10 + l_linenumber AS line_item_id, l_orderkey AS order_id,
  CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS unit_price_cents,
  l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem"""
VIEWS["v_headers"] = """SELECT o.o_orderkey AS order_id,
  coalesce(s.s, 0) + CAST(o.o_orderkey % 250 = 0 AS BIGINT) AS subtotal_cents,
  199 + (o.o_orderkey % 5) * 100 AS delivery_fee_cents, (o.o_orderkey * 37) % 800 AS tip_cents
FROM orders o LEFT JOIN (SELECT order_id, CAST(sum(quantity * unit_price_cents) AS BIGINT) AS s FROM v_lines
  GROUP BY order_id) s ON s.order_id = o.o_orderkey"""

# ---- notebook data set -------------------------------------------------------------------------
VIEWS["nb0"] = """SELECT l.order_id, l.customer_id, CASE WHEN l.order_id % 9 <> 4 THEN l.customer_id % 60 END AS restaurant_id,
  l.order_id % 3 AS lay, l.placed, copy, (l.order_id + copy) % 120 AS driver_id,
  CASE WHEN l.order_id % 400 = 7 THEN l.placed - to_seconds(600) ELSE l.placed + to_seconds(2400) END AS prom,
  CASE WHEN l.order_id % 300 = 11 THEN l.delivered + to_seconds(60) ELSE l.picked END AS pick,
  l.delivered, l.order_status
FROM (SELECT *, unnest(CASE WHEN order_id % 500 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM v_lc) l"""
VIEWS["nb_raw"] = f"""SELECT copy, order_id, customer_id, restaurant_id, driver_id,
  CASE WHEN order_id % 1000 = 0 AND copy = 0 THEN 'unknown' WHEN order_id % 131 <> 6 THEN {txt('placed')} END AS created_at,
  {txt('prom')} AS promised_eta, {txt('pick')} AS pickup_at,
  CASE WHEN order_id % 41 = 0 THEN NULL WHEN order_id % 53 = 0 THEN 'pending' ELSE {txt('delivered')} END
    AS actual_delivery_at,
  CASE WHEN order_status = 'CANCELLED' THEN 'cancelled' WHEN order_id % 97 = 0 THEN 'Delivered'
       WHEN order_id % 89 = 0 THEN 'delivered ' ELSE 'delivered' END AS final_status,
  CASE WHEN order_id % 500 = 3 THEN 'HIGH' ELSE ['low', 'medium', 'high', 'severe'][order_id % 4 + 1] END
    AS traffic_bucket,
  CASE WHEN order_id % 83 <> 2 THEN ['clear', 'cloudy', 'rain', 'storm', 'snow'][customer_id % 5 + 1] END AS weather_bucket, CAST((order_id * 29) % 300 AS DOUBLE) / 10.0 AS distance_km_estimate
FROM nb0"""
VIEWS["nb_parsed"] = """SELECT order_id, customer_id, restaurant_id, driver_id,
  TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(promised_eta AS TIMESTAMP) AS promised_eta,
  TRY_CAST(pickup_at AS TIMESTAMP) AS pickup_at, TRY_CAST(actual_delivery_at AS TIMESTAMP) AS actual_delivery_at,
  final_status, traffic_bucket, weather_bucket, distance_km_estimate FROM nb_raw"""
VIEWS["nb_dedup"] = "SELECT DISTINCT ON (order_id) * FROM nb_raw ORDER BY order_id, copy"
VIEWS["nb_p0"] = f"""SELECT order_id, customer_id, restaurant_id, driver_id,
  TRY_CAST(created_at AS TIMESTAMP) AS created_at, TRY_CAST(promised_eta AS TIMESTAMP) AS promised_eta,
  TRY_CAST(pickup_at AS TIMESTAMP) AS pickup_at, TRY_CAST(actual_delivery_at AS TIMESTAMP) AS actual_delivery_at,
  final_status, traffic_bucket, weather_bucket, distance_km_estimate, {norm('final_status')} AS final_status_norm
FROM nb_dedup"""
VIEWS["nb_prep"] = f"""SELECT *, final_status_norm = 'delivered' AS is_delivered,
  (final_status_norm = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta IS NOT NULL) AS is_valid_delivered,
  CASE WHEN final_status_norm = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta IS NOT NULL
       THEN {mins('promised_eta', 'actual_delivery_at')} END AS delay_min,
  CASE WHEN final_status_norm = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta IS NOT NULL
       THEN {mins('promised_eta', 'actual_delivery_at')} > 0 END AS is_late
FROM nb_p0"""
VIEWS["nb_valid"] = "SELECT * FROM nb_prep WHERE is_valid_delivered"
VIEWS["nb_out"] = f"""SELECT order_id,
  CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS delivered_flag,
  CASE WHEN is_delivered AND d IS NOT NULL THEN (CASE WHEN d > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) END AS late_flag,
  CASE WHEN is_delivered THEN d END AS delay_min,
  CASE WHEN NOT is_delivered THEN 'cancelled' WHEN d IS NULL THEN 'missing_timestamp' WHEN d <= 0 THEN 'on_time'
       WHEN d <= 10.0 THEN 'late' ELSE 'severe_late' END AS outcome_bucket
FROM (SELECT *, {mins('promised_eta', 'actual_delivery_at')} AS d FROM nb_prep)"""
VIEWS["v_actions"] = """SELECT event_id AS action_id, ((event_id // 4) * 7) % (SELECT n FROM nk) AS order_id, ts AS action_at,
  CASE event_type WHEN 'view' THEN 'ETA_VIEWED' WHEN 'click' THEN 'CANCEL_CLICKED' ELSE 'SUPPORT_OPENED' END AS action_type,
  CASE WHEN user_id % 2 = 0 THEN 'app' ELSE 'web' END AS channel
FROM events WHERE event_type IN ('view', 'click', 'signup')"""
VIEWS["v_interv"] = """SELECT event_id AS intervention_id, ((event_id // 5) * 11) % (SELECT n FROM nk) AS order_id,
  ts AS intervention_at, CASE WHEN event_id % 37 <> 0
    THEN ['PRIORITY_DISPATCH', 'DRIVER_REASSIGNMENT', 'VOUCHER'][event_id % 3 + 1] END AS intervention_type,
  'ops' AS initiated_by, 'risk_' || CAST(event_id % 4 AS VARCHAR) AS reason
FROM events WHERE event_type = 'purchase'"""
VIEWS["v_status"] = """SELECT order_id, customer_id % 60 AS restaurant_id,
  ['preparing', 'ready', 'ready ', 'READY', 'handed_off', 'handoff', 'unknown'][order_id % 7 + 1] AS status,
  TRY_CAST(CASE WHEN order_id % 57 = 0 THEN 'soon'
    ELSE strftime(placed + to_seconds((order_id * 13) % 3000), '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS last_updated_at FROM v_lc WHERE order_id % 3 = 0"""
VIEWS["v_rest"] = """SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name,
  'cuisine_' || CAST(s_nationkey % 6 AS VARCHAR) AS cuisine FROM supplier"""
VIEWS["v_drivers"] = "SELECT p_partkey AS driver_id, p_brand AS vehicle FROM part"
VIEWS["v_customers"] = "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer"
VIEWS["j_act"] = """SELECT order_id, count(*) FILTER (WHERE action_type = 'ETA_VIEWED') AS eta_view_count,
  max(CAST(action_type = 'CANCEL_CLICKED' AS INTEGER)) AS cancel_attempted,
  max(CAST(action_type = 'SUPPORT_OPENED' AS INTEGER)) AS support_app_opened
FROM v_actions WHERE order_id IS NOT NULL GROUP BY order_id"""
VIEWS["j_tix"] = """SELECT order_id, count(ticket_id) AS support_tickets_count, 1 AS support_ticket_opened
FROM src_tickets WHERE order_id IS NOT NULL GROUP BY order_id"""
VIEWS["j_int"] = """SELECT order_id, count(intervention_id) AS intervention_count,
  array_to_string(list_sort(list_distinct(list(intervention_type))), ', ') AS intervention_types
FROM v_interv WHERE order_id IS NOT NULL GROUP BY order_id"""
VIEWS["journey"] = """SELECT b.order_id, b.customer_id, b.restaurant_id, b.driver_id, b.final_status,
  o.delivered_flag, o.late_flag, o.delay_min, o.outcome_bucket, a.eta_view_count,
  CAST(coalesce(a.support_app_opened, 0) AS INTEGER) AS support_app_opened,
  CAST(coalesce(a.cancel_attempted, 0) AS INTEGER) AS cancel_attempted,
  t.support_tickets_count, CAST(coalesce(t.support_ticket_opened, 0) AS INTEGER) AS support_ticket_opened,
  CAST(coalesce(i.intervention_count, 0) AS INTEGER) AS intervention_count,
  coalesce(i.intervention_types, 'NONE') AS intervention_types,
  CAST(coalesce(a.support_app_opened, 0) = 1 OR coalesce(t.support_ticket_opened, 0) = 1 AS INTEGER) AS support_opened
FROM nb_dedup b LEFT JOIN nb_out o ON b.order_id = o.order_id LEFT JOIN j_act a ON b.order_id = a.order_id
  LEFT JOIN j_tix t ON b.order_id = t.order_id LEFT JOIN j_int i ON b.order_id = i.order_id"""
VIEWS["j_deliv"] = "SELECT * FROM journey WHERE delivered_flag = 1"


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in definition order."""
    names = list(VIEWS)
    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                todo.append(VIEWS[n])
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names if n in need]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
