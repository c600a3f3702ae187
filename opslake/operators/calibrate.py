"""Validation, calibration and quarantine (silver layer).

Rules run in a fixed order on the same columns: jitter on the terminal
dispatch; backward drift, then forward drift on the already calibrated ready
time, then imputation on the kitchen ticket. A rule that routes a row to the
dead-letter queue (DLQ) does not stop the later rules from looking at it, and
one order may produce several DLQ records. Everything is a column
expression on one frame per source; DLQ and silver are projections of that
frame, so the sources are read once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions import combine_one_row, parse_ts, pct

# ---- fixed values (must equal the reference's for equal results) ---------
TERMINAL_STATUSES = ["COMPLETED", "CANCELLED_BY_SYSTEM"]
REJECTED_STATUS = "REJECTED"
JITTER_LIMIT_S = 35.0          # inclusive
JITTER_CLAMP_S = 1             # arrived := pickup - 1 s
DRIFT_LIMIT_S = 300.0          # inclusive, both directions
BACKWARD_PRINT_OFFSET_S = 15   # printed := order placed + 15 s
FORWARD_READY_OFFSET_S = 30    # ready := pickup - 30 s
IMPUTE_READY_OFFSET_S = 45     # ready := pickup - 45 s
SEVERITY = "CRITICAL_DROP"
SRC_DISPATCH = "DISPATCH_API"
SRC_KDS = "KDS_CSV"
CODE_JITTER = "CRITICAL_TEMPORAL_INVERSION_PICKUP_ARRIVED"
CODE_BACKWARD = "SEVERE_BACKWARD_CLOCK_DRIFT_EXCEEDS_5MIN"
CODE_FORWARD = "SEVERE_FORWARD_CLOCK_DRIFT_EXCEEDS_5MIN"
DESC_JITTER = "Rider arrived at store %ss AFTER pickup (exceeds 35s jitter limit)"
DESC_BACKWARD = "KDS ticket printed %ss BEFORE order was placed"
DESC_FORWARD = "KDS ready timestamp is %ss after courier pickup"

DISPATCH_TS = ["offered_at", "responded_at", "arrived_at_store_at", "picked_up_at", "delivered_at"]
KDS_TS = ["ticket_printed_at", "food_ready_at"]

DLQ_SCHEMA = ("entity_id string, source_system string, error_code string, "
              "error_description string, severity string, raw_payload string, quarantined_at string")


def _us(a: Column, b: Column) -> Column:
    """b - a in microseconds (long)."""
    return F.timestamp_diff("MICROSECOND", a, b)


def _shift_s(ts: Column, secs: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(secs), ts)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def parse_timestamps(df: DataFrame, cols: list[str]) -> DataFrame:
    """V4: string timestamps -> timestamp (UTC); bad text -> null."""
    string_cols = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.withColumns({c: parse_ts(c) for c in cols if c in string_cols})


# ---- V1 / V2 ----------------------------------------------------------------
def source_profile(orders: DataFrame, kds: DataFrame, dispatch: DataFrame) -> DataFrame:
    """V1 + V2: one row of source totals. Each source is aggregated once
    (partial aggregation before the exchange); the one-row results are put
    side by side without a join."""
    o = orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("order_status") == "COMPLETED").alias("completed_orders"),
        F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled_orders"))
    d = dispatch.agg(F.count(F.lit(1)).alias("total_dispatch_attempts"),
                     F.count_distinct("order_id").alias("unique_dispatched_orders"))
    kd = kds.agg(F.count(F.lit(1)).alias("total_kds_tickets"),
                 F.count_if(F.col("food_ready_at").isNull()).alias("missing_kds_food_ready_count"))
    ch = redispatch_churn_counts(dispatch)
    p = combine_one_row(o, d, kd, ch)
    return p.select(
        "total_orders", "completed_orders", "cancelled_orders", "total_dispatch_attempts",
        "unique_dispatched_orders", "total_kds_tickets", "missing_kds_food_ready_count",
        pct("missing_kds_food_ready_count", "total_kds_tickets").alias("missing_kds_food_ready_pct"),
        "orders_with_driver_churn",
        pct("orders_with_driver_churn", "total_orders").alias("driver_churn_order_pct"))


def redispatch_churn_counts(dispatch: DataFrame) -> DataFrame:
    # attempts without an order id belong to no order
    per_order = (dispatch.filter(F.col("order_id").isNotNull()).groupBy("order_id")
                 .agg(F.count("dispatch_id").alias("n")))
    return per_order.agg(F.count_if(F.col("n") > 1).alias("orders_with_driver_churn"))


def redispatch_churn(dispatch: DataFrame, orders: DataFrame) -> DataFrame:
    """V2: orders with more than one attempt, and their share of all orders."""
    p = combine_one_row(redispatch_churn_counts(dispatch),
                        orders.agg(F.count(F.lit(1)).alias("total_orders")))
    return p.select("orders_with_driver_churn", "total_orders",
                    pct("orders_with_driver_churn", "total_orders").alias("driver_churn_order_pct"))


# ---- V3 ---------------------------------------------------------------------
def split_attempts(dispatch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V3: (terminal attempts, rejected attempts). Rejected rows are kept
    untouched as the churn fact."""
    terminal = dispatch.filter(F.col("dispatch_status").isin(TERMINAL_STATUSES))
    rejected = dispatch.filter(F.col("dispatch_status") == REJECTED_STATUS)
    return terminal, rejected


# ---- V5 ---------------------------------------------------------------------
def clamp_jitter(terminal: DataFrame) -> DataFrame:
    """V5: arrived after pickup by <= 35 s -> arrived := pickup - 1 s (flag);
    more -> DLQ record. Adds ``network_jitter_clamped_flag``,
    ``jitter_detected`` and ``_dlq`` (array of error structs, maybe empty)."""
    t = parse_timestamps(terminal, DISPATCH_TS)
    arr, pick = F.col("arrived_at_store_at"), F.col("picked_up_at")
    viol = _true(arr > pick)
    delta_s = _us(pick, arr) / F.lit(1e6)
    fix = viol & (delta_s <= JITTER_LIMIT_S)
    bad = viol & (delta_s > JITTER_LIMIT_S)
    payload = F.to_json(F.struct(*[F.col(c) for c in terminal.columns]))
    err = F.when(bad, F.struct(
        F.col("order_id").cast("string").alias("entity_id"),
        F.lit(SRC_DISPATCH).alias("source_system"),
        F.lit(CODE_JITTER).alias("error_code"),
        F.format_string(DESC_JITTER, delta_s.cast("string")).alias("error_description"),
        F.lit(SEVERITY).alias("severity"),
        payload.alias("raw_payload")))
    return t.withColumns({
        "jitter_detected": viol,
        "network_jitter_clamped_flag": fix,
        "arrived_at_store_at": F.when(fix, _shift_s(pick, -JITTER_CLAMP_S)).otherwise(arr),
        "_dlq": F.array_compact(F.array(err)),
    })


# ---- V6 - V9 ------------------------------------------------------------------
def calibrate_kitchen(kds: DataFrame, orders: DataFrame, terminal: DataFrame) -> DataFrame:
    """V9 enrich (left joins on order_id), then V6 backward drift, V7 forward
    drift on the calibrated ready time, V8 imputation, in that order.

    All three inputs are keyed by order_id, so the joins share one hash
    partitioning of order_id (one exchange per input, none between joins).
    """
    pick = parse_timestamps(terminal, DISPATCH_TS).select("order_id", "picked_up_at")
    placed = parse_timestamps(orders, ["order_timestamp"]).select("order_id", "order_timestamp")
    k = (parse_timestamps(kds, KDS_TS)
         .join(pick, "order_id", "left")
         .join(placed, "order_id", "left"))
    printed, ready = F.col("ticket_printed_at"), F.col("food_ready_at")
    order_ts, picked = F.col("order_timestamp"), F.col("picked_up_at")
    # the source row as JSON, built inside each DLQ branch only, so clean
    # rows never pay for the serialisation
    payload = F.to_json(F.struct(*[F.col(c) for c in k.columns]))

    # V6 backward drift
    back_viol = _true(printed < order_ts)
    back_us = _us(printed, order_ts)
    back_fix = back_viol & (back_us <= DRIFT_LIMIT_S * 1e6)
    back_bad = back_viol & (back_us > DRIFT_LIMIT_S * 1e6)
    printed_cal = F.when(back_fix, _shift_s(order_ts, BACKWARD_PRINT_OFFSET_S)).otherwise(printed)
    ready1 = F.when(back_fix, F.timestamp_add("MICROSECOND", back_us, ready)).otherwise(ready)
    k = k.withColumns({"_back_fix": back_fix, "_back_bad": back_bad,
                       "_back_s": back_us / F.lit(1e6), "_ready1": ready1,
                       "calibrated_ticket_printed_at": printed_cal})

    # V7 forward drift (on the ready time V6 produced)
    r1 = F.col("_ready1")
    fwd_viol = _true(r1 > picked)
    fwd_us = _us(picked, r1)
    fwd_fix = fwd_viol & (fwd_us <= DRIFT_LIMIT_S * 1e6)
    fwd_bad = fwd_viol & (fwd_us > DRIFT_LIMIT_S * 1e6)
    ready2 = F.when(fwd_fix, _shift_s(picked, -FORWARD_READY_OFFSET_S)).otherwise(r1)
    k = k.withColumns({"_fwd_fix": fwd_fix, "_fwd_bad": fwd_bad, "_fwd_s": fwd_us / F.lit(1e6),
                       "_ready2": ready2, "_back_viol": back_viol, "_fwd_viol": fwd_viol})

    # V8 imputation
    r2 = F.col("_ready2")
    impute = r2.isNull() & picked.isNotNull()

    def err(cond, code, desc, secs):
        return F.when(cond, F.struct(
            F.col("order_id").cast("string").alias("entity_id"),
            F.lit(SRC_KDS).alias("source_system"), F.lit(code).alias("error_code"),
            F.format_string(desc, F.col(secs).cast("string")).alias("error_description"),
            F.lit(SEVERITY).alias("severity"), payload.alias("raw_payload")))

    out = k.withColumns({
        "is_food_ready_imputed_flag": impute,
        "calibrated_food_ready_at": F.when(impute, _shift_s(picked, -IMPUTE_READY_OFFSET_S)).otherwise(r2),
        "clock_drift_calibrated_flag": F.col("_back_fix") | F.col("_fwd_fix"),
        "backward_drift_detected": F.col("_back_viol"),
        "forward_drift_detected": F.col("_fwd_viol"),
        "missing_ready_detected": impute,
        "_dlq": F.array_compact(F.array(
            err(F.col("_back_bad"), CODE_BACKWARD, DESC_BACKWARD, "_back_s"),
            err(F.col("_fwd_bad"), CODE_FORWARD, DESC_FORWARD, "_fwd_s"))),
    })
    return out.drop("_back_fix", "_back_bad", "_back_s", "_ready1", "_fwd_fix",
                    "_fwd_bad", "_fwd_s", "_ready2", "_back_viol", "_fwd_viol")


# ---- V10 / V11 -------------------------------------------------------------------
def quarantine_records(*flagged: DataFrame, quarantined_at: str | None = None) -> DataFrame:
    """Explode the per-row error arrays into DLQ records (fixed schema,
    also when empty). ``quarantined_at`` is a run parameter, not the clock
    inside the job, so reruns are reproducible."""
    ts = F.lit(quarantined_at) if quarantined_at is not None else F.lit(None).cast("string")
    parts = [f.select(F.explode("_dlq").alias("e")).select("e.*").withColumn("quarantined_at", ts)
             for f in flagged]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quarantined_ids(dlq: DataFrame, key_type="string") -> DataFrame:
    return dlq.select(F.col("entity_id").cast(key_type).alias("_qid")).distinct()


def remove_quarantined(df: DataFrame, dlq: DataFrame, key: str = "order_id",
                       ids: DataFrame | None = None) -> DataFrame:
    """Drop every row whose key has a DLQ record. The DLQ grows with
    the data, so no broadcast hint: AQE broadcasts it only when the runtime
    size is under the threshold, else it stays a shuffle join. ``ids``
    (from ``quarantined_ids``) lets several tables share one id set."""
    if ids is None:
        ids = quarantined_ids(dlq, df.schema[key].dataType)
    return df.join(ids, F.col(key) == F.col("_qid"), "left_anti")


class Silver(NamedTuple):
    orders: DataFrame
    kds: DataFrame
    dispatch: DataFrame
    churn: DataFrame
    dlq: DataFrame
    jittered: DataFrame        # all terminal rows after V5 (incl. quarantined)
    kitchen: DataFrame         # all kitchen rows after V6-V8 (incl. quarantined)
    ids: DataFrame | None = None   # distinct quarantined order ids, when persisted

    def release(self) -> None:
        """Drop the persisted calibration frames once their consumers ran."""
        self.jittered.unpersist()
        self.kitchen.unpersist()
        if self.ids is not None:
            self.ids.unpersist()


def validate_and_calibrate(orders: DataFrame, kds: DataFrame, dispatch: DataFrame,
                           quarantined_at: str | None = None, persist: bool = True) -> Silver:
    """All V-rules. The calibrated kitchen and dispatch frames feed both the
    DLQ and the silver tables, so they are persisted (memory, spilling to
    disk) and computed once; a lost block is recomputed from lineage. The
    distinct quarantined ids -- a small fraction of the orders -- are
    persisted too and shared by the three silver filters (Spark does not
    reuse the repeated id exchange over persisted frames by itself)."""
    from pyspark import StorageLevel
    terminal, rejected = split_attempts(dispatch)
    jit = clamp_jitter(terminal)
    kit = calibrate_kitchen(kds, orders, terminal)
    if persist:
        jit = jit.persist(StorageLevel.MEMORY_AND_DISK)
        kit = kit.persist(StorageLevel.MEMORY_AND_DISK)
    dlq = quarantine_records(jit, kit, quarantined_at=quarantined_at)
    key_type = orders.schema["order_id"].dataType
    ids = quarantined_ids(dlq, key_type)
    if persist:
        ids = ids.persist(StorageLevel.MEMORY_AND_DISK)

    def clean(df: DataFrame) -> DataFrame:
        same = df.schema["order_id"].dataType == key_type
        return remove_quarantined(df, dlq, ids=ids if same else None)

    return Silver(
        orders=clean(orders), kds=clean(kit.drop("_dlq")), dispatch=clean(jit.drop("_dlq")),
        churn=rejected, dlq=dlq, jittered=jit, kitchen=kit, ids=ids if persist else None)


# ---- V12 / V13 -------------------------------------------------------------------
def detections(s: Silver) -> DataFrame:
    """One row: faults found in all rows, quarantined ones included."""
    det_k = s.kitchen.agg(
        (F.count_if("backward_drift_detected") + F.count_if("forward_drift_detected"))
        .alias("pos_clock_drift_instances"),
        F.count_if("missing_ready_detected").alias("missing_bump_bar_instances"))
    det_j = s.jittered.agg(F.count_if("jitter_detected").alias("network_jitter_instances"))
    return combine_one_row(det_k, det_j)


def calibration_audit(s: Silver, detected: DataFrame | None = None) -> DataFrame:
    """Detections count every row (quarantined included); calibrations
    count rows that reached silver only. ``detected``: stored ``detections``."""
    q = s.dlq.agg(F.count(F.lit(1)).alias("quarantined_records_count"))
    cal_k = s.kds.agg(F.count_if("clock_drift_calibrated_flag").alias("clock_drift_calibrated_count"),
                      F.count_if("is_food_ready_imputed_flag").alias("food_ready_imputed_count"))
    cal_j = s.dispatch.agg(F.count_if("network_jitter_clamped_flag").alias("network_jitter_clamped_count"))
    clean = s.orders.agg(F.count(F.lit(1)).alias("clean_records_passed_to_silver"))
    return combine_one_row(detections(s) if detected is None else detected, q, cal_k, cal_j, clean)


def quarantine_rate(s: Silver) -> DataFrame:
    """DLQ records / (DLQ records + clean orders), as the reference mixes
    grains; the distinct-order rate is emitted beside it."""
    q = s.dlq.agg(F.count(F.lit(1)).alias("quarantined_records"),
                  F.count_distinct("entity_id").alias("quarantined_orders"))
    c = s.orders.agg(F.count(F.lit(1)).alias("clean_records"))
    r = combine_one_row(q, c)
    return r.select(
        "quarantined_records", "quarantined_orders", "clean_records",
        (F.col("quarantined_records") + F.col("clean_records")).alias("total_evaluated"),
        F.coalesce(pct("quarantined_records", F.col("quarantined_records") + F.col("clean_records")),
                   F.lit(0.0)).alias("quarantine_rate_pct"),
        F.coalesce(pct("quarantined_orders", F.col("quarantined_orders") + F.col("clean_records")),
                   F.lit(0.0)).alias("quarantined_order_rate_pct"))
