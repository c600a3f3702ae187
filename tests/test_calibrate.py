"""Hand-written boundary cases for the validation / calibration rules."""

from datetime import datetime, timedelta

from opslake.operators import calibrate as C

T0 = datetime(2024, 1, 1, 12, 0, 0)


def ts(sec):
    return None if sec is None else T0 + timedelta(seconds=sec)


DISPATCH_SCHEMA = ("dispatch_id long, order_id long, driver_id long, attempt_number int, dispatch_status string, "
                   "offered_at timestamp, responded_at timestamp, arrived_at_store_at timestamp, "
                   "picked_up_at timestamp, delivered_at timestamp")
KDS_SCHEMA = ("kds_ticket_id long, order_id long, merchant_id long, ticket_printed_at timestamp, "
              "food_ready_at timestamp, active_kitchen_queue_depth int, estimated_prep_sec int")
ORDERS_SCHEMA = "order_id long, customer_id long, merchant_id long, order_status string, order_timestamp timestamp"


def dispatch_row(oid, arrived, picked, status="COMPLETED"):
    return (oid, oid, 1, 1, status, ts(0), ts(10), ts(arrived), ts(picked), ts(None if picked is None else picked + 600))


def test_jitter_boundaries(spark):
    # delta = arrived - picked: 0 (none), 1 and 35 (clamp), 36 (DLQ), null arrived, null picked
    rows = [dispatch_row(1, 1000, 1000), dispatch_row(2, 1001, 1000), dispatch_row(3, 1035, 1000),
            dispatch_row(4, 1036, 1000), dispatch_row(5, None, 1000), dispatch_row(6, 1000, None)]
    d = spark.createDataFrame(rows, DISPATCH_SCHEMA)
    out = {r.order_id: r for r in C.clamp_jitter(d).collect()}
    assert not out[1].jitter_detected and not out[1].network_jitter_clamped_flag
    for oid in (2, 3):
        assert out[oid].network_jitter_clamped_flag
        assert out[oid].arrived_at_store_at == ts(999)  # pickup - 1 s
        assert out[oid]._dlq == []
    assert out[4].jitter_detected and not out[4].network_jitter_clamped_flag
    assert [e.error_code for e in out[4]._dlq] == [C.CODE_JITTER]
    assert out[4]._dlq[0].error_description == "Rider arrived at store 36.0s AFTER pickup (exceeds 35s jitter limit)"
    assert out[4].arrived_at_store_at == ts(1036)  # quarantined row is not altered
    for oid in (5, 6):
        assert not out[oid].jitter_detected and out[oid]._dlq == []


def _kitchen(spark, cases):
    """cases: (order_id, placed, printed, ready, picked)."""
    orders = spark.createDataFrame([(o, 1, 1, "COMPLETED", ts(p)) for o, p, _, _, _ in cases], ORDERS_SCHEMA)
    kds = spark.createDataFrame([(o, o, 1, ts(pr), ts(rd), 3, 600) for o, _, pr, rd, _ in cases], KDS_SCHEMA)
    disp = spark.createDataFrame([dispatch_row(o, None, pk) for o, _, _, _, pk in cases], DISPATCH_SCHEMA)
    return {r.order_id: r for r in C.calibrate_kitchen(kds, orders, disp).collect()}


def test_backward_drift_boundaries(spark):
    out = _kitchen(spark, [
        (1, 0, -300, 400, 2000),    # 300 s early -> fix; ready shifted by the drift (300 s)
        (2, 0, -301, 400, 2000),    # 301 s -> DLQ
        (3, 0, -100, None, None),   # drift with null ready and no pickup: printed fixed, ready stays null
        (4, 0, 0, 400, 2000),       # equal times -> no violation
    ])
    assert out[1].clock_drift_calibrated_flag
    assert out[1].calibrated_ticket_printed_at == ts(15)
    assert out[1].calibrated_food_ready_at == ts(700)
    assert [e.error_code for e in out[2]._dlq] == [C.CODE_BACKWARD]
    assert out[2].calibrated_ticket_printed_at == ts(-301)
    assert out[3].calibrated_ticket_printed_at == ts(15) and out[3].calibrated_food_ready_at is None
    assert not out[4].backward_drift_detected and out[4]._dlq == []


def test_forward_drift_uses_calibrated_ready(spark):
    out = _kitchen(spark, [
        (1, 0, 10, 2300, 2000),     # ready 300 s after pickup -> ready := pickup - 30 s
        (2, 0, 10, 2301, 2000),     # 301 s -> DLQ
        (3, 0, -200, 2000, 2100),   # V6 shifts ready to 2200 (> pickup by 100 s) -> V7 fixes it
    ])
    assert out[1].calibrated_food_ready_at == ts(1970) and out[1].clock_drift_calibrated_flag
    assert [e.error_code for e in out[2]._dlq] == [C.CODE_FORWARD]
    assert out[3].backward_drift_detected and out[3].forward_drift_detected
    assert out[3].calibrated_food_ready_at == ts(2070)
    assert out[3].calibrated_ticket_printed_at == ts(15)


def test_ready_imputation(spark):
    out = _kitchen(spark, [(1, 0, 10, None, 2000), (2, 0, 10, None, None)])
    assert out[1].is_food_ready_imputed_flag and out[1].calibrated_food_ready_at == ts(1955)
    assert not out[2].is_food_ready_imputed_flag and out[2].calibrated_food_ready_at is None


def test_dlq_records_two_codes_and_empty_schema(spark):
    orders = spark.createDataFrame([(1, 1, 1, "COMPLETED", ts(0)), (2, 1, 1, "COMPLETED", ts(0))], ORDERS_SCHEMA)
    # order 1 fails jitter (40 s) and forward drift (400 s); order 2 is clean
    kds = spark.createDataFrame([(1, 1, 1, ts(10), ts(2400), 3, 600), (2, 2, 1, ts(10), ts(500), 3, 600)], KDS_SCHEMA)
    disp = spark.createDataFrame([dispatch_row(1, 2040, 2000), dispatch_row(2, 900, 1000)], DISPATCH_SCHEMA)
    s = C.validate_and_calibrate(orders, kds, disp, quarantined_at="2024-01-01T00:00:00Z")
    codes = sorted(r.error_code for r in s.dlq.collect())
    assert codes == sorted([C.CODE_JITTER, C.CODE_FORWARD])
    assert [r.order_id for r in s.orders.collect()] == [2]
    assert s.kds.count() == 1 and s.dispatch.count() == 1
    # no failures -> empty DLQ with the full schema
    s2 = C.validate_and_calibrate(orders.filter("order_id = 2"), kds.filter("order_id = 2"),
                                  disp.filter("order_id = 2"))
    assert s2.dlq.count() == 0
    assert s2.dlq.columns == ["entity_id", "source_system", "error_code", "error_description", "severity",
                              "raw_payload", "quarantined_at"]


def test_recalibration_is_a_fixpoint(spark):
    """Calibrating already-clean rows again leaves their timestamps unchanged
    and finds no recoverable violation."""
    orders = spark.createDataFrame([(i, 1, 1, "COMPLETED", ts(0)) for i in range(1, 5)], ORDERS_SCHEMA)
    kds = spark.createDataFrame([(1, 1, 1, ts(-200), ts(400), 3, 600), (2, 2, 1, ts(10), ts(2200), 3, 600),
                                 (3, 3, 1, ts(10), None, 3, 600), (4, 4, 1, ts(5), ts(300), 3, 600)], KDS_SCHEMA)
    disp = spark.createDataFrame([dispatch_row(i, 1010, 2000 if i != 4 else 1000) for i in range(1, 5)],
                                 DISPATCH_SCHEMA)
    s = C.validate_and_calibrate(orders, kds, disp)
    k1 = s.kds.select("kds_ticket_id", "order_id", "merchant_id",
                      s.kds.calibrated_ticket_printed_at.alias("ticket_printed_at"),
                      s.kds.calibrated_food_ready_at.alias("food_ready_at"),
                      "active_kitchen_queue_depth", "estimated_prep_sec")
    d1 = s.dispatch.select(*[c for c in disp.columns])
    again = C.calibrate_kitchen(k1, s.orders, d1).collect()
    for r in again:
        assert not r.backward_drift_detected and not r.forward_drift_detected
        assert not r.is_food_ready_imputed_flag
        assert r.calibrated_food_ready_at == r.food_ready_at
        assert r.calibrated_ticket_printed_at == r.ticket_printed_at
    assert all(not r.jitter_detected for r in C.clamp_jitter(d1).collect())


def test_profile_and_churn(spark):
    orders = spark.createDataFrame([(1, 1, 1, "COMPLETED", ts(0)), (2, 1, 1, "CANCELLED", ts(0))], ORDERS_SCHEMA)
    disp = spark.createDataFrame([
        (10, 1, 1, 1, "REJECTED", ts(0), ts(1), None, None, None),
        (11, 1, 1, 2, "COMPLETED", ts(0), ts(1), ts(1010), ts(2000), ts(2600)),
        (12, 2, 1, 1, "CANCELLED_BY_SYSTEM", ts(0), ts(1), None, None, None)], DISPATCH_SCHEMA)
    kds = spark.createDataFrame([(1, 1, 1, ts(10), None, 3, 600), (2, 2, 1, ts(10), ts(20), 3, 600)], KDS_SCHEMA)
    p = C.source_profile(orders, kds, disp).first()
    assert (p.total_orders, p.completed_orders, p.cancelled_orders) == (2, 1, 1)
    assert p.total_dispatch_attempts == 3 and p.unique_dispatched_orders == 2
    assert p.orders_with_driver_churn == 1 and p.driver_churn_order_pct == 50.0
    assert p.missing_kds_food_ready_count == 1 and p.missing_kds_food_ready_pct == 50.0
    term, rej = C.split_attempts(disp)
    assert term.count() == 2 and rej.count() == 1
    ch = C.redispatch_churn(disp, orders).first()
    assert ch.orders_with_driver_churn == 1 and ch.driver_churn_order_pct == 50.0
