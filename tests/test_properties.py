"""Randomised invariants (hypothesis) and a hot-key case.

* After V5-V8 no recoverable violation remains in the silver rows.
* Clean orders + distinct quarantined orders = input orders.
* One key holding a third of all rows gives the same answers as a
  straightforward Python computation.
"""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from opslake.operators import calibrate as C
from opslake.operators import contracts as K
from opslake.operators import journeys as J

T0 = datetime(2024, 1, 1, 12, 0, 0)


def ts(sec):
    return None if sec is None else T0 + timedelta(seconds=sec)


ORDER = st.tuples(
    st.integers(-450, 300),                         # printed - placed (s)
    st.one_of(st.none(), st.integers(-200, 2600)),  # ready - placed
    st.one_of(st.none(), st.integers(600, 2400)),   # picked - placed
    st.integers(-600, 120),                         # arrived - picked
)


@settings(max_examples=12, deadline=None)
@given(st.lists(ORDER, min_size=1, max_size=25))
def test_calibration_leaves_no_recoverable_violation(spark, rows):
    orders = spark.createDataFrame([(i, 1, 1, "COMPLETED", ts(0)) for i in range(len(rows))],
                                   "order_id long, customer_id long, merchant_id long, order_status string, "
                                   "order_timestamp timestamp")
    kds = spark.createDataFrame([(i, i, 1, ts(p), ts(r), 3, 600) for i, (p, r, _, _) in enumerate(rows)],
                                "kds_ticket_id long, order_id long, merchant_id long, ticket_printed_at timestamp, "
                                "food_ready_at timestamp, active_kitchen_queue_depth int, estimated_prep_sec int")
    disp = spark.createDataFrame(
        [(i, i, 1, 1, "COMPLETED", ts(0), ts(5), ts(None if pk is None else pk + a), ts(pk),
          ts(None if pk is None else pk + 900)) for i, (_, _, pk, a) in enumerate(rows)],
        "dispatch_id long, order_id long, driver_id long, attempt_number int, dispatch_status string, "
        "offered_at timestamp, responded_at timestamp, arrived_at_store_at timestamp, picked_up_at timestamp, "
        "delivered_at timestamp")
    s = C.validate_and_calibrate(orders, kds, disp, persist=False)
    for r in s.kds.collect():
        assert r.calibrated_ticket_printed_at >= r.order_timestamp
        if r.calibrated_food_ready_at is not None and r.picked_up_at is not None:
            assert r.calibrated_food_ready_at <= r.picked_up_at
        if r.picked_up_at is not None:
            assert r.calibrated_food_ready_at is not None
    for r in s.dispatch.collect():
        if r.arrived_at_store_at is not None and r.picked_up_at is not None:
            assert r.arrived_at_store_at <= r.picked_up_at
    clean = s.orders.count()
    quarantined = s.dlq.select("entity_id").distinct().count()
    assert clean + quarantined == len(rows)
    # every DLQ row is explained by a rule threshold
    expected = sum(1 for p, r, pk, a in rows if -p > 300) + sum(1 for p, r, pk, a in rows if pk is not None and a > 35)
    assert s.dlq.filter(F_code_in([C.CODE_BACKWARD, C.CODE_JITTER])).count() == expected


def F_code_in(codes):
    from pyspark.sql import functions as F
    return F.col("error_code").isin(codes)


def test_hot_key_rollups_and_dedupe(spark):
    """Order 0 holds a third of all intervention rows and a third of the
    duplicated order rows; results equal a plain Python computation."""
    n = 3000
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 97, ["VOUCHER", "PRIORITY_DISPATCH", "DRIVER_REASSIGNMENT"][i % 3 if i % 3 else (i // 3) % 3])
            for i in range(n)]
    iv = spark.createDataFrame(rows, "intervention_id long, order_id long, intervention_type string").repartition(8)
    got = {r.order_id: (r.intervention_count, r.intervention_types) for r in J.interventions_rollup(iv).collect()}
    exp = {}
    for _, o, t in rows:
        c, types = exp.get(o, (0, set()))
        exp[o] = (c + 1, types | {t})
    assert got == {o: (c, ", ".join(sorted(t))) for o, (c, t) in exp.items()}
    assert got[0][0] == n // 3
    dup = spark.createDataFrame([(0 if i % 3 == 0 else i, i) for i in range(n)], "k long, seq long").repartition(8)
    first = {r.k: r.seq for r in K.dedupe_keep_first(dup, "k", ["seq"]).collect()}
    assert first[0] == 0 and len(first) == 1 + sum(1 for i in range(n) if i % 3)
    members = K.duplicate_rows(dup, "k")
    assert members.count() == n // 3 and members.agg({"copies": "max"}).first()[0] == n // 3


def test_intervention_type_preaggregation_equals_row_level(spark):
    """Order 0 holds a third of all intervention rows; the (order, type)
    pre-aggregate with weighted measures equals the row-level computation."""
    import statistics
    n = 3000
    types = ["VOUCHER", "PRIORITY_DISPATCH", "DRIVER_REASSIGNMENT"]
    iv = [(i, 0 if i % 3 == 0 else 1 + i % 50, types[(i // 3) % 3] if i % 3 == 0 else types[i % 3]) for i in range(n)]
    outcome = [(o, 1.0, None if o % 7 == 3 else float(o % 2), float(o % 11) - 3.0) for o in range(0, 51)]
    ivd = spark.createDataFrame(iv, "intervention_id long, order_id long, intervention_type string").repartition(8)
    od = spark.createDataFrame(outcome, "order_id long, delivered_flag double, late_flag double, delay_min double")
    got = {r.intervention_type: (r.interventions_count, r.late_rate_pct, r.median_delay_min)
           for r in J.late_by_intervention_type(ivd, od).collect()}
    by_o = {o: (lf, d) for o, _, lf, d in outcome}
    exp = {}
    for t in types:
        joined = [by_o[o] for _, o, tt in iv if tt == t and o in by_o]
        flags = [f for f, _ in joined if f is not None]
        exp[t] = (len(joined), round(100 * sum(flags) / len(flags), 2), round(statistics.median(d for _, d in joined), 4))
    assert got == exp


def test_ticket_preaggregation_equals_row_level(spark):
    """Order 0 holds a third of all tickets (plus null and orphan keys);
    per-order ticket counts with weighted means equal the row-level join."""
    from pyspark.sql import functions as F
    n = 3000
    tickets = [(i, None if i % 101 == 0 else (0 if i % 3 == 0 else 1 + i % 40)) for i in range(n)]
    orders = [(o, o % 4 != 1, None if o % 9 == 4 else float(o % 13) - 6.0) for o in range(0, 35)]
    td = spark.createDataFrame(tickets, "ticket_id long, order_id long").repartition(8)
    od = spark.createDataFrame(orders, "order_id long, is_late boolean, delay_min double").withColumn(
        "is_valid_delivered", F.lit(True))
    got = J.ticket_vs_operations(td, od).first()
    by_o = {o: (late, d) for o, late, d in orders}
    joined = [by_o[o] for _, o in tickets if o is not None and o in by_o]
    delays = [d for _, d in joined if d is not None]
    assert got.matched_tickets == len(joined)
    assert got.matched_late_pct == round(100 * sum(1 for late, _ in joined if late) / len(joined), 2)
    assert got.matched_mean_delay_min == round(sum(delays) / len(delays), 4)
