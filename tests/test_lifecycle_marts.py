"""Stage durations, bottleneck ties, scenarios and evidence on hand rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslake.operators import lifecycle as L
from opslake.operators import marts as M

T0 = datetime(2024, 1, 1, 12, 0, 0)


def ts(m):
    return None if m is None else T0 + timedelta(minutes=m)


FACT_SCHEMA = ("order_id long, order_status string, order_placed_at timestamp, kds_printed_at timestamp, "
               "kds_ready_at timestamp, arrived_at_store_at timestamp, picked_up_at timestamp, "
               "delivered_at timestamp, estimated_prep_sec int, active_kitchen_queue_depth int, "
               "ticket_count int, refund_amount_cents long, cluster_id string, is_completed_hint int")


def fact(spark, rows):
    df = spark.createDataFrame(rows, FACT_SCHEMA).drop("is_completed_hint")
    return L.attribute_bottleneck(L.sla_flags(L.stage_durations(df)))


def test_stage_columns_and_clip_keep_null(spark):
    rows = [(1, "COMPLETED", ts(0), ts(2), ts(14), ts(10), ts(15), ts(40), 600, 3, 0, 0, "A", 1),
            (2, "CANCELLED", ts(0), ts(1), None, None, None, None, 600, 3, 0, 0, "A", 0)]
    r = {x.order_id: x for x in fact(spark, rows).collect()}
    a = r[1]
    assert a.stage1_merchant_lag_min == 2.0
    assert a.actual_prep_min == 12.0 and a.nominal_prep_min == 10.0 and a.stage2_prep_overrun_min == 2.0
    assert a.stage3_dispatch_and_travel_min == 8.0
    assert a.rider_store_wait_min == 4.0 and a.food_counter_dwell_min == 0.0
    assert a.stage4_store_handoff_min == 5.0 and a.stage5_last_mile_min == 25.0
    assert a.total_otd_min == 40.0 and a.is_sla_breached
    b = r[2]
    # undelivered orders keep null stages (no 0-minute stages from greatest(null, 0))
    assert b.stage5_last_mile_min is None and b.rider_store_wait_min is None and b.total_otd_min is None
    assert not b.is_sla_breached and b.primary_delay_bottleneck == "CANCELLED_OR_INCOMPLETE"


def test_bottleneck_tie_first_listed_and_cancelled_delivered(spark):
    # merchant lag 5, prep overrun 5 -> tie -> MERCHANT_LAG (first listed)
    rows = [(1, "COMPLETED", ts(0), ts(5), ts(20), ts(20), ts(21), ts(30), 600, 3, 0, 0, "A", 1),
            # prep overrun 5 ties rider wait 5 -> KITCHEN_PREP_OVERRUN
            (2, "COMPLETED", ts(0), ts(0), ts(15), ts(10), ts(16), ts(25), 600, 3, 0, 0, "A", 1),
            # cancelled but delivered -> incomplete label
            (3, "CANCELLED", ts(0), ts(0), ts(5), ts(5), ts(6), ts(50), 600, 3, 0, 0, "A", 0),
            # last mile 30 -> congestion 20 dominates
            (4, "COMPLETED", ts(0), ts(1), ts(11), ts(11), ts(12), ts(42), 600, 3, 0, 0, "A", 1)]
    r = {x.order_id: x.primary_delay_bottleneck for x in fact(spark, rows).collect()}
    assert r == {1: "MERCHANT_LAG", 2: "KITCHEN_PREP_OVERRUN", 3: "CANCELLED_OR_INCOMPLETE",
                 4: "LAST_MILE_CONGESTION"}


def test_scenarios_staged_raises_small_wait_and_buffer_boundary(spark):
    # wait 0 -> staged wait clipped up to 1.5 (OTD rises by 1.5); wait 20 -> 4.0 (OTD falls by 16)
    # queue 8 -> no buffer, queue 9 -> minus 4.5
    rows = [(1, "COMPLETED", ts(0), ts(0), ts(10), ts(10), ts(11), ts(30), 600, 8, 0, 1000, "A", 1),
            (2, "COMPLETED", ts(0), ts(0), ts(30), ts(10), ts(31), ts(50), 600, 9, 1, 2000, "A", 1)]
    f = fact(spark, rows)
    sc = {r.scenario_order: r for r in M.scenario_evaluation(f).collect()}
    assert len(sc) == 4
    assert sc[0].p50_otd_min == 40.0 and sc[0].mean_rider_wait_min == 10.0
    # staged: order 1 OTD 30 + 1.5 = 31.5, order 2 OTD 50 - 16 = 34 -> median 32.75
    assert sc[1].p50_otd_min == 32.75 and sc[1].mean_rider_wait_min == 2.75
    # buffered: order 1 unchanged 30, order 2 50 - 4.5 = 45.5
    assert sc[2].p50_otd_min == 37.75
    assert sc[3].p50_otd_min == pytest.approx((31.5 + 29.5) / 2)
    assert sc[1].projected_refund_liability_usd == round(30.0 * 0.58, 2)
    assert sc[3].effective_fleet_capacity_gain_pct == 26.8
    assert M.scenario_lookup(M.scenario_evaluation(f), "Baseline", "startswith").count() == 1


def test_kpi_and_evidence(spark):
    rows = [(1, "COMPLETED", ts(0), ts(0), ts(10), ts(10), ts(11), ts(30), 600, 8, 0, 1000, "A", 1),
            (2, "COMPLETED", ts(0), ts(0), ts(30), ts(10), ts(31), ts(50), 600, 9, 1, 2000, "B", 1),
            (3, "CANCELLED", ts(0), ts(1), None, None, None, None, 600, 3, 0, 0, "B", 0)]
    f = fact(spark, rows)
    k = M.kpi_summary(f).first()
    assert (k.total_orders_ingested, k.completed_orders, k.cancelled_orders) == (3, 2, 1)
    assert k.p50_otd_min == 40.0 and k.p90_otd_min == 48.0 and k.sla_breach_rate_pct == 50.0
    assert k.customer_complaint_rate_pct == 33.33 and k.total_refund_liability_usd == 30.0
    ev = {r.metric: r.status for r in M.evidence_table(M.kpi_summary(f)).collect()}
    assert ev["P50 OTD (min)"] == "FAIL" and len(ev) == 6
    cl = M.kpi_by_cluster(f).collect()
    assert [r.cluster_id for r in cl] == ["B", "A"]  # worst breach rate first
    dist = {r.primary_delay_bottleneck: (r.order_count, r.is_mode) for r in L.bottleneck_distribution(f).collect()}
    assert sum(v[0] for v in dist.values()) == 3 and sum(v[1] for v in dist.values()) == 1


def test_support_rollup_drops_null_keys(spark):
    t = spark.createDataFrame([(1, 10, 500, 4), (2, 10, 250, 2), (3, None, 999, 1)],
                              "ticket_id long, order_id long, compensation_amount_cents long, csat_score int")
    r = L.support_rollup(t).collect()
    assert len(r) == 1 and (r[0].ticket_count, r[0].refund_amount_cents, r[0].min_csat) == (2, 750, 2)
    assert L.support_rollup(t).filter(F.col("order_id").isNull()).count() == 0


def test_distributed_quantiles_equal_percentile_in_marts(spark):
    from fixtures.catalog import Ctx
    fact = Ctx(spark, "/root/testdata/sf0.001").fact
    for build in (M.kpi_summary, M.kpi_by_cluster):
        a, b = build(fact), build(fact, distributed=True)
        assert a.columns == b.columns and a.collect() == b.collect()


def test_fact_from_calibration_equals_fact_from_silver_tables(spark):
    """Filtering only the orders gives the same fact as filtering orders,
    kitchen and dispatch (their quarantined rows cannot join clean orders)."""
    from fixtures.catalog import Ctx
    from opslake.operators.proofs import output_fingerprint
    c = Ctx(spark, "/root/testdata/sf0.01")
    s, t = c.silver, c.t
    a = L.build_fact_from_calibration(s, t.merchants, t.support_tickets)
    b = L.build_fact(s.orders, t.merchants, s.kds, s.dispatch, t.support_tickets)
    assert a.columns == b.columns
    assert output_fingerprint(a).first() == output_fingerprint(b).first()
    assert a.count() == s.orders.count()


def test_queries_over_the_fact_keep_no_copy_of_the_calibration(spark, tmpdir_fresh):
    from fixtures.catalog import QUERIES, Ctx
    spark.range(300).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "element_at(array('O', 'F', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus",
        "CAST(id AS DOUBLE) AS o_totalprice", "TIMESTAMP_NTZ'2024-01-01' AS o_orderdate", "'5-LOW' AS o_orderpriority") \
        .write.parquet(f"{tmpdir_fresh}/orders.parquet")
    spark.range(7).selectExpr("id AS c_custkey", "'n' AS c_name", "1 AS c_nationkey", "0D AS c_acctbal", "'m' AS c_mktsegment") \
        .write.parquet(f"{tmpdir_fresh}/customer.parquet")
    spark.range(100).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01' AS ts", "id % 9 AS user_id", "'error' AS event_type",
                                "1D AS value", "'x' AS props").write.parquet(f"{tmpdir_fresh}/events.parquet")
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    got = {r.primary_delay_bottleneck: r.order_count for r in QUERIES["bottleneck_distribution"](spark, tmpdir_fresh).collect()}
    fact = QUERIES["bottleneck_attribution"](spark, tmpdir_fresh).collect()
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == before
    c = Ctx(spark, tmpdir_fresh)
    shared = c.fact_over(c.silver).select("order_id", "primary_delay_bottleneck").collect()
    c.silver.release()
    assert sorted(fact) == sorted(shared) and len(fact) > 100
    assert sum(got.values()) == len(fact) and set(got) == {r.primary_delay_bottleneck for r in fact}
