"""Proofs, contracts and journey operators on hand-written rows."""

from pyspark.sql import functions as F

from opslake.functions import norm_category
from opslake.operators import contracts as K
from opslake.operators import journeys as J
from opslake.operators import proofs as P


def test_reconcile_and_pk(spark):
    headers = spark.createDataFrame([(1, 500, 0, 0), (2, 301, 0, 0), (3, 0, 0, 0)],
                                    "order_id long, subtotal_cents long, delivery_fee_cents long, tip_cents long")
    lines = spark.createDataFrame([(11, 1, 2, 250), (21, 2, 1, 300), (22, 9, 1, 7)],
                                  "line_item_id long, order_id long, quantity long, unit_price_cents long")
    g = P.reconcile_global(headers, lines).first()
    assert g.gmv_subtotal_cents == 801 and g.items_subtotal_cents == 807 and g.reconciliation_delta_cents == 6
    by = {r.order_id: r.delta_cents for r in P.reconcile_by_order(headers, lines).collect()}
    assert by == {2: 1, 9: -7}  # delta 0 orders are not listed; a lines-only order shows up
    keyed = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    pk = P.pk_integrity([("h", headers, "order_id"), ("dup", keyed, "k")]).collect()
    res = {r.table_name: (r.row_count, r.distinct_keys, r.null_keys, r.is_unique) for r in pk}
    assert res == {"h": (3, 3, 0, True), "dup": (3, 1, 1, False)}
    gate = P.completeness_gate(P.pk_integrity([("h", headers, "order_id")]), P.reconcile_global(headers, lines))
    assert gate.first().completeness_verified is False  # delta 6 > 3 orders


def test_page_completeness_cases(spark):
    schema = "page long, total_records long, has_more boolean, data array<int>"
    ok = spark.createDataFrame([(1, 4, True, [1, 2]), (2, 4, False, [3, 4])], schema)
    assert P.page_completeness(ok).first().complete
    missing = spark.createDataFrame([(1, 6, True, [1, 2]), (3, 6, False, [5, 6])], schema)
    r = P.page_completeness(missing).first()
    assert r.missing_pages == 1 and not r.complete
    open_end = spark.createDataFrame([(1, 4, True, [1, 2]), (2, 4, True, [3, 4])], schema)
    assert P.page_completeness(open_end).first().last_page_has_more
    disagree = spark.createDataFrame([(1, 4, True, [1, 2]), (2, 5, False, [3, 4])], schema)
    assert not P.page_completeness(disagree).first().complete


def test_fingerprint_is_order_insensitive(spark):
    a = spark.createDataFrame([(i, f"x{i}") for i in range(100)], "id long, v string")
    b = a.orderBy(F.desc("id")).repartition(7)
    fa, fb = P.output_fingerprint(a).first(), P.output_fingerprint(b).first()
    assert fa == fb and fa.row_count == 100
    assert P.output_fingerprint(a.limit(99)).first() != fa


def test_duplicates_dedupe_nulls(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "c", 5), (3, None, None)],
                               "id long, v string, rank int")
    d = K.duplicate_rows(df, "id").collect()
    assert sorted(r.v for r in d) == ["a", "b"] and all(r.copies == 2 for r in d)
    first = {r.id: r.v for r in K.dedupe_keep_first(df, "id", ["rank"]).collect()}
    assert first == {1: "b", 2: "c", 3: None}
    nc = {r.column_name: (r.null_count, r.null_pct) for r in K.null_census(df).collect()}
    assert nc == {"id": (0, 0.0), "v": (1, 25.0), "rank": (1, 25.0)}


def test_normalization_and_audit(spark):
    df = spark.createDataFrame([("\tDelivered ",), ("delivered",), ("Late Delivery",), (None,)], "s string")
    out = [r[0] for r in df.select(norm_category("s")).collect()]
    assert out == ["delivered", "delivered", "late delivery", None]
    audit = K.category_audit([("s", df, "s")]).collect()
    assert len(audit) == 4 and any(r.raw_value is None for r in audit)


def test_referential_coverage_and_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    cov = K.referential_coverage([("c->p", child, "k", parent, "k")]).first()
    assert (cov.child_keys, cov.matched_keys, cov.coverage_pct) == (3, 2, 66.67)
    orphans = sorted((r.k is None, r.k) for r in K.orphan_rows(child, "k", parent, "k").collect())
    assert orphans == [(False, 9), (True, None)]


def test_contract_verdicts_and_gate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id long, delay int")
    rules = [K.Rule("no_null", "delay recorded", F.lit(True), F.col("delay").isNull(), "HIGH", 50.0),
             K.Rule("small", "delay under 60", F.col("delay").isNotNull(), F.col("delay") > 60, "LOW"),
             K.Rule("big", "delay under 10", F.col("delay").isNotNull(), F.col("delay") > 10, "HIGH"),
             K.Rule("empty", "nothing in scope", F.lit(False), F.lit(True), "LOW")]
    rep = {r.check_name: r.verdict for r in K.contract_report(df, rules).collect()}
    assert rep == {"no_null": "WARN", "small": "PASS", "big": "FAIL", "empty": "UNKNOWN"}
    g = K.validation_gate(K.contract_report(df, rules)).first()
    assert g.gate_passed is False and g.checks == 4 and g.warn_checks == 1


def test_circuit_breaker(spark):
    rate = spark.createDataFrame([(10, 5, 90, 100, 10.0, 5.26)],
                                 "quarantined_records long, quarantined_orders long, clean_records long, "
                                 "total_evaluated long, quarantine_rate_pct double, quarantined_order_rate_pct double")
    r = K.circuit_breaker(rate, 5.0).first()
    assert r.quarantine_trip_warning and r.status == "SUCCESS_WITH_WARNINGS"
    assert K.circuit_breaker(rate, 50.0).first().status == "SUCCESS"
    import pytest
    with pytest.raises(RuntimeError):
        K.raise_if_tripped(K.circuit_breaker(rate, 5.0, halt=True))


ORDERS_NB = ("order_id long, customer_id long, restaurant_id long, driver_id long, created_at string, "
             "promised_eta string, pickup_at string, actual_delivery_at string, final_status string, "
             "traffic_bucket string, weather_bucket string, distance_km_estimate double")


def _orders(spark):
    rows = [
        (1, 1, 1, 1, "2024-01-01 10:00:00", "2024-01-01T10:40:00Z", "2024-01-01T10:20:00", "2024-01-01 10:45:00",
         "delivered", "low", "dry", 0.0),
        (2, 1, 2, 1, "2024-01-01T11:00:00", "2024-01-01 11:40:00", "2024-01-01 11:20:00", "2024-01-01 11:30:00",
         "Delivered ", "low", "dry", 5.0),
        (3, 2, 2, 2, "2024-01-01 12:00:00", "2024-01-01 12:40:00", None, "not a time", "delivered", "HIGH", "wet", 5.1),
        (4, 2, 3, 2, "2024-01-01 13:00:00", "2024-01-01 13:40:00", None, None, "cancelled", "high", "wet", 25.0),
        (5, 3, 3, 3, "2024-01-01 14:00:00", "2024-01-01 14:40:00", "2024-01-01 14:10:00", "2024-01-01 15:00:00",
         "delivered", "severe", "wet", 25.1),
        (5, 3, 3, 3, "2024-01-01 14:00:00", "2024-01-01 14:40:00", "2024-01-01 14:10:00", "2024-01-01 15:00:00",
         "delivered", "severe", "wet", 25.1),
    ]
    return spark.createDataFrame(rows, ORDERS_NB)


def test_prepare_and_late_queries(spark):
    raw = _orders(spark)
    prep = J.prepare_orders(raw)
    assert prep.count() == 5
    rows = {r.order_id: r for r in prep.collect()}
    assert rows[1].delay_min == 5.0 and rows[1].is_late
    assert rows[2].delay_min == -10.0 and rows[2].is_late is False  # ' Delivered ' normalised
    assert rows[3].actual_delivery_at is None and not rows[3].is_valid_delivered  # bad text -> null
    s = J.late_summary(prep).first()
    assert (s.delivered_orders, s.missing_delivery_time, s.valid_delivered, s.late_orders) == (4, 1, 3, 2)
    bands = {r.distance_band: r.order_count for r in J.late_by_band(prep).collect()}
    # 0.0 and 25.1 are outside every band; 5.0 is in (0, 5]; empty bands are kept
    assert bands == {"<5km": 1, "5-10km": 0, "10-15km": 0, ">15km": 0}
    ordered = [r.traffic_bucket for r in J.late_by_category_ordered(prep).collect()]
    assert ordered == ["low", "severe"]  # 'HIGH' is not a listed category
    top = J.top_delays(prep, 2).collect()
    assert [r.order_id for r in top] == [5, 1]
    defs = {r.definition: (r.late_count, r.population) for r in
            K.late_rate_definitions(J.parse_orders(raw), prep).collect()}
    assert defs["A"] == (2, 3) and defs["B"] == (1, 3) and defs["C"] == (2, 5) and defs["D"] == (3, 3)


def test_rollups_and_journey(spark):
    raw = _orders(spark)
    prep = J.prepare_orders(raw)
    actions = spark.createDataFrame(
        [(1, 1, "ETA_VIEWED"), (2, 1, "ETA_VIEWED"), (3, 1, "CANCEL_CLICKED"), (4, None, "SUPPORT_OPENED"),
         (5, 3, "SUPPORT_OPENED")], "action_id long, order_id long, action_type string")
    tickets = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "ticket_id long, order_id long")
    interventions = spark.createDataFrame(
        [(1, 5, "VOUCHER"), (2, 5, "PRIORITY_DISPATCH"), (3, 5, "VOUCHER"), (4, None, "VOUCHER")],
        "intervention_id long, order_id long, intervention_type string")
    a = {r.order_id: (r.eta_view_count, r.cancel_attempted, r.support_app_opened)
         for r in J.actions_rollup(actions).collect()}
    assert a == {1: (2, 1, 0), 3: (0, 0, 1)}
    t = {r.order_id: r.support_tickets_count for r in J.tickets_rollup(tickets).collect()}
    assert t == {5: 2}
    i = {r.order_id: (r.intervention_count, r.intervention_types) for r in
         J.interventions_rollup(interventions).collect()}
    assert i == {5: (3, "PRIORITY_DISPATCH, VOUCHER")}
    jn = {r.order_id: r for r in J.order_journey(prep, actions, tickets, interventions).collect()}
    assert len(jn) == 5
    assert jn[5].support_opened == 1 and jn[5].intervention_count == 3 and jn[5].late_flag == 1.0
    assert jn[2].intervention_types == "NONE" and jn[2].support_opened == 0
    assert jn[3].support_opened == 1 and jn[3].late_flag is None
    worst = [r.order_id for r in J.worst_journeys(J.order_journey(prep, actions, tickets, interventions)).collect()]
    assert worst == [5]


def test_timeline_and_flatten(spark):
    raw = _orders(spark).filter("order_id = 1")
    actions = spark.createDataFrame([(1, 1, "ETA_VIEWED", "app", "2024-01-01 10:05:00")],
                                    "action_id long, order_id long, action_type string, channel string, "
                                    "action_at string")
    tickets = spark.createDataFrame([(1, 1, "late_delivery", "where is it", "2024-01-01 10:50:00")],
                                    "ticket_id long, order_id long, category string, customer_message string, "
                                    "created_at string")
    interventions = spark.createDataFrame(
        [(1, 1, "VOUCHER", "ops", "late", "2024-01-01 10:55:00")],
        "intervention_id long, order_id long, intervention_type string, initiated_by string, reason string, "
        "intervention_at string")
    tl = J.order_timeline(raw, actions, tickets, interventions).filter("order_id = 1").collect()
    assert [r.event_type for r in tl] == ["ORDER_CREATED", "APP_ETA_VIEWED", "COURIER_PICKUP", "PROMISED_ETA",
                                          "ORDER_DELIVERED", "SUPPORT_TICKET_LATE_DELIVERY",
                                          "INTERVENTION_VOUCHER"]
    docs = spark.createDataFrame([(7, [("PING", 1), ("PICKUP", 2)]), (8, [])],
                                 "driver_id long, events array<struct<type:string, seq:int>>")
    flat = J.flatten_documents(docs).collect()
    assert [(r.driver_id, r.type) for r in flat] == [(7, "PING"), (7, "PICKUP")]
    census = {r.event_type: r.arrival_event_recorded for r in J.event_census(J.flatten_documents(docs)).collect()}
    assert census == {"PING": False, "PICKUP": False}


def test_metric_definitions_document(spark, tmpdir_fresh):
    import json
    import os
    p = os.path.join(tmpdir_fresh, "defs.json")
    with open(p, "w") as f:
        json.dump({"definitions": [
            {"definition": "ops", "rule": "delay > 0", "threshold_min": 0, "population": "valid_delivered"},
            {"definition": "support", "rule": "delay > 4", "threshold_min": 4, "population": "valid_delivered"},
            {"definition": "board", "rule": "delay > 0 / all", "threshold_min": 0, "population": "unique_orders"}]},
            f)
    defs = K.read_metric_definitions(spark, p)
    assert [d[0] for d in defs] == ["ops", "support", "board"]
    raw = _orders(spark)
    out = {r.definition: (r.late_count, r.population) for r in
           K.late_rate_definitions(J.parse_orders(raw), J.prepare_orders(raw), defs).collect()}
    assert out == {"ops": (2, 3), "support": (2, 3), "board": (2, 5)}


def test_category_share_counts_missing_category_in_total_only(spark):
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "ticket_id long, category string")
    got = [(r.category, r.ticket_count, r.percentage) for r in J.category_share(t).collect()]
    assert got == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_event_census_leaves_missing_types_out(spark):
    e = spark.createDataFrame([("PING",), ("PING",), ("STORE_ARRIVED",), (None,)], "type string")
    got = {r.event_type: (r.event_count, r.arrival_event_recorded) for r in J.event_census(e).collect()}
    assert got == {"PING": (2, True), "STORE_ARRIVED": (1, True)}


def test_missing_keys_and_statuses(spark):
    """Duplicates list rows without a key; no other grouping makes a group of them."""
    d = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "order_id long, x string")
    assert sorted(r.x for r in K.duplicate_rows(d, "order_id").collect()) == ["a", "b"]
    from opslake.operators import calibrate as C
    from opslake.operators import lifecycle as L
    att = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "order_id long, dispatch_id long")
    assert C.redispatch_churn_counts(att).first()[0] == 0
    f = spark.createDataFrame([(None, 40.0)], "order_status string, x double").selectExpr(
        "order_status", "timestamp'2024-01-01 10:00:00' order_placed_at", "timestamp'2024-01-01 11:00:00' delivered_at",
        "x stage1_merchant_lag_min", "x stage2_prep_overrun_min", "x rider_store_wait_min", "x stage5_last_mile_min")
    r = L.attribute_bottleneck(L.sla_flags(f)).first()
    assert r.is_completed is False and r.is_sla_breached is False and r.primary_delay_bottleneck == L.INCOMPLETE_LABEL
    p = spark.createDataFrame([(1, None, True, 5.0, True), (2, "rain", True, 1.0, False)],
                              "order_id long, weather_bucket string, is_valid_delivered boolean, delay_min double, is_late boolean")
    assert [r.weather_bucket for r in J.late_by_category(p).collect()] == ["rain"]
    i = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, "CALL", 3)], "order_id long, intervention_type string, intervention_id long")
    out = spark.createDataFrame([(1, 1.0, 1.0, 3.0)], "order_id long, delivered_flag double, late_flag double, delay_min double")
    for distributed in (False, True):
        assert [r.intervention_type for r in J.late_by_intervention_type(i, out, distributed=distributed).collect()] == ["CALL"]
    j = spark.createDataFrame([(1, None, 1.0, 1.0, 1.0), (2, None, 1.0, 1.0, 1.0), (3, 8, 1.0, 1.0, 1.0)],
                              "order_id long, restaurant_id long, delivered_flag double, late_flag double, delay_min double")
    names = spark.createDataFrame([(8, "N")], "restaurant_id long, name string")
    assert [r.restaurant_id for r in J.top_late_parents(j, names, n=1).collect()] == [8]


def test_a_missing_group_has_its_quantiles_distributed_too(spark):
    from opslake.functions.quantiles import Q, agg_with_quantiles
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    m = [("n", F.count(F.lit(1))), ("med", Q("x", 0.5))]
    a, b = (sorted(map(tuple, agg_with_quantiles(df, m, by=["g"], distributed=d).collect()), key=str) for d in (False, True))
    assert a == b == sorted([(None, 2, 2.0), ("a", 1, 5.0)], key=str)


def test_verdicts_use_the_unrounded_rate_and_raw_keys(spark):
    df = spark.range(100_000).withColumn("bad", F.col("id") < 4)
    r = K.contract_report(df, [K.Rule("r", "few", F.lit(True), F.col("bad"), "CRITICAL")]).first()
    assert r.violation_rate_pct == 0.0 and r.verdict == "FAIL"
    raw = spark.createDataFrame([(1,), (1,), (1,), (2,)], "order_id long")

    def unique(rows):
        return K.contract_report(df, [K.UniqueRule("unique", "one row an order", rows, "order_id", "CRITICAL")]).first()
    u = unique(raw)
    assert (u.population, u.violations, u.verdict) == (4, 2, "FAIL")
    assert unique(raw.distinct()).verdict == "PASS" and unique(raw.limit(0)).verdict == "UNKNOWN"


def test_rules_of_all_kinds_in_one_report(spark):
    df = spark.createDataFrame([(1, True), (2, False), (None, None)], "order_id long, late boolean")
    measured = spark.createDataFrame([("A", 3, 10), ("B", 3, 10), ("C", 2, 10), ("D", None, None), ("E", None, None)],
                                     "definition string, late long, population long")
    rules = [K.UniqueRule("u", "", df.unionByName(df.limit(2)), "order_id", "HIGH", 50.0),
             K.Rule("r", "", F.lit(True), F.col("late"), "LOW"),
             K.AgreedRule("a", "", measured, ("late", "population"), "HIGH"),
             K.AgreedRule("b", "", measured.where("definition in ('A', 'B')"), ("late", "population"), "HIGH"),
             K.AgreedRule("none", "", measured.limit(0), ("late",), "HIGH")]
    got = {r.check_name: (r.population, r.violations, r.verdict) for r in K.contract_report(df, rules).collect()}
    assert got == {"u": (5, 2, "WARN"), "r": (3, 1, "FAIL"), "a": (5, 3, "FAIL"), "b": (2, 0, "PASS"), "none": (0, 0, "UNKNOWN")}


def test_text_times_with_a_bad_value(spark):
    s = spark.createDataFrame([(1, "2024-01-01 10:10:00"), (2, "soon")], "order_id long, last_updated_at string")
    o = spark.createDataFrame([(1, "2024-01-01 10:00:00", None), (2, "2024-01-01 10:00:00", "x")],
                              "order_id long, created_at string, pickup_at string")
    r = K.freshness_lag(s, o).first()
    assert r.linked_status_records == 2 and r.mean_lag_from_creation_min == 10.0


def test_many_late_definitions_take_several_passes(spark):
    p = spark.createDataFrame([(1, True, 5.0)], "order_id long, is_valid_delivered boolean, delay_min double")
    raw = spark.createDataFrame([("delivered", None, None)], "final_status string, actual_delivery_at timestamp, promised_eta timestamp")
    defs = [(f"D{i}", "", float(i % 10), "valid_delivered") for i in range(300)]
    got = {r.definition: r.late_count for r in K.late_rate_definitions(raw, p, defs).collect()}
    assert got == {f"D{i}": int(i % 10 < 5) for i in range(300)}


def test_first_kept_row_is_not_the_one_without_a_time(spark):
    d = spark.createDataFrame([(1, None, "bad"), (1, "2024", "good")], "order_id long, t string, x string")
    assert K.dedupe_keep_first(d, "order_id", ["t"]).first().x == "good"


def _landed_files(spark, folder, kind):
    """Rows of three keys in three files; v says which landed first."""
    import os
    files = [[(1, "2024-01-02", "first"), (2, "soon", "first")], [(1, "2024-01-01", "no"), (3, None, "first"), (2, "2024-01-01", "no")],
             [(3, "2024-01-01", "no"), (1, "2024-01-02", "no"), (None, "x", "first"), (None, "a", "no")]]
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "order_id long, created_at string, v string").coalesce(1)
        part = os.path.join(folder, f"part{i}")
        (df.write.parquet(part) if kind == "parquet" else df.write.option("header", True).csv(part))
    paths = [os.path.join(folder, f"part{i}") for i in (2, 0, 1)]  # named in another order than they landed
    r = spark.read.schema("order_id long, created_at string, v string")
    return r.parquet(*paths) if kind == "parquet" else r.option("header", True).csv(paths)


def test_the_first_landed_row_stays_whatever_its_times(spark, tmpdir_fresh):
    import os

    from opslake.sources.landing import with_landing_sequence
    for kind in ("parquet", "csv"):
        rows = with_landing_sequence(_landed_files(spark, os.path.join(tmpdir_fresh, kind), kind))
        got = K.keep_first_landed(rows, "order_id")
        assert got.columns == ["order_id", "created_at", "v"]
        assert sorted((r.order_id or 0, r.v) for r in got.collect()) == [(0, "first"), (1, "first"), (2, "first"), (3, "first")]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        prep = J.first_orders(rows.withColumnRenamed("v", "final_status"))
        assert {r.final_status for r in prep.collect()} == {"first"}


def test_landing_sequence_numbers_rows_of_split_files(spark, tmpdir_fresh):
    import os

    from opslake.sources.landing import with_landing_sequence
    place = os.path.join(tmpdir_fresh, "rows.csv")
    with open(place, "w") as f:
        f.write("i\n" + "".join(f"{i}\n" for i in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = spark.read.schema("i long").option("header", True).csv(place)
        assert df.rdd.getNumPartitions() > 5
        rows = [r.i for r in with_landing_sequence(df).orderBy("_landed").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == list(range(30_000))


def test_the_rows_of_one_file_are_numbered_by_many_tasks(spark, tmpdir_fresh):
    """A table that is one file, larger than what the planner broadcasts by itself."""
    import os

    from opslake.sources.landing import with_landing_sequence
    place = os.path.join(tmpdir_fresh, "one")
    spark.range(0, 80_000, 1, 1).select((F.col("id") % 40_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), "id") \
        .write.option("parquet.block.size", 1 << 19).parquet(place)
    small = {"spark.sql.files.maxPartitionBytes": "512k", "spark.sql.files.openCostInBytes": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = spark.read.parquet(place)
        tasks = df.rdd.getNumPartitions()
        rows = with_landing_sequence(df)
        each = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        kept = [r.id for r in K.keep_first_landed(rows, "k").select("id").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks > 4 and sum(each) == 80_000 and max(each) < 40_000
    assert sorted(kept) == list(range(40_000))


def test_coverage_counts_every_relation_in_one_pass(spark):
    o = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, None), (4, 99)], "order_id long, restaurant_id long")
    r = spark.createDataFrame([(10,), (10,), (11,), (None,)], "restaurant_id long")
    t = spark.createDataFrame([("1",), ("1",), ("7",), (None,)], "order_id string")
    none = r.limit(0)
    out = K.referential_coverage([("o-r", o, "restaurant_id", r, "restaurant_id"), ("t-o", t, "order_id", o, "order_id"),
                                  ("none-r", none, "restaurant_id", r, "restaurant_id"), ("r-none", r, "restaurant_id", none, "restaurant_id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(_i") == 2  # by key, then by relation
    got = {x.relation: (x.child_keys, x.matched_keys, x.coverage_pct) for x in out.collect()}
    assert got == {"o-r": (4, 3, 75.0), "t-o": (3, 2, 66.67), "none-r": (0, 0, None), "r-none": (3, 0, 0.0)}


def test_a_hot_order_is_numbered_by_many_tasks(spark):
    """A third of all events in one order: in order, and no task with over twice the median of rows."""
    n = 30_000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 4001 + 10).alias("order_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 2_000_000).alias("action_at"),
        F.lit("VIEW").alias("action_type"), (F.col("id") % 7).cast("string").alias("channel"))
    empty_t = spark.createDataFrame([], "ticket_id long, order_id long, category string, customer_message string, created_at timestamp")
    empty_i = spark.createDataFrame([], "intervention_id long, order_id long, intervention_type string, initiated_by string, "
                                        "reason string, intervention_at timestamp")
    orders = spark.createDataFrame([], ORDERS_NB)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tl = J.order_timeline(orders, ev, empty_t, empty_i).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    from collections import Counter
    sizes = sorted(Counter(r.task for r in tl).values())
    assert len(tl) == n and len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    by_order = {}
    for r in tl:
        by_order.setdefault(r.order_id, []).append(r)
    assert len(by_order[5]) == n // 3
    for rows in by_order.values():
        rows.sort(key=lambda r: r.event_no)
        assert [r.event_no for r in rows] == list(range(1, len(rows) + 1))
        assert all((a.event_time, a.details) <= (b.event_time, b.details) for a, b in zip(rows, rows[1:]))


def test_a_clients_document_of_statements(spark, tmpdir_fresh):
    import json
    import os
    p = os.path.join(tmpdir_fresh, "client.json")
    with open(p, "w") as f:
        json.dump({"metric_under_review": "m", "note": "n", "stakeholders": {
            "Z": "Only over 4.5 min counts.", "A": "All orders, even cancelled ones.", "M": "From the raw table", "N": None}}, f)
    assert K.read_metric_definitions(spark, p) == [
        ("A", "All orders, even cancelled ones.", 0.0, "unique_orders"), ("M", "From the raw table", 0.0, "raw_delivered"),
        ("N", None, 0.0, "valid_delivered"), ("Z", "Only over 4.5 min counts.", 4.5, "valid_delivered")]
    with open(p, "w") as f:
        json.dump({"definitions": [{"definition": "x", "rule": "r", "threshold_min": None}]}, f)
    assert K.read_metric_definitions(spark, p) == [("x", "r", 0.0, "valid_delivered")]
