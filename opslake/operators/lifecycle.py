"""Order-lifecycle fact: joins, stage durations, SLA flags, bottlenecks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions import clip_low, combine_one_row, minutes_between, rate_true
from opslake.functions.quantiles import Q, agg_with_quantiles
from opslake.operators.calibrate import DISPATCH_TS, parse_timestamps
from opslake.sources.landing import AUDIT_COLUMNS

# ---- fixed values ------------------------------------------------------------
SLA_MINUTES = 35.0            # breach when OTD > 35 (strict) and completed
LAST_MILE_NORMAL_MIN = 10.0   # last-mile minutes above this count as congestion
COMPLETED = "COMPLETED"
INCOMPLETE_LABEL = "CANCELLED_OR_INCOMPLETE"
# candidate order matters: on ties the first listed wins
BOTTLENECK_LABELS = ["MERCHANT_LAG", "KITCHEN_PREP_OVERRUN", "RIDER_WAIT_AT_STORE", "LAST_MILE_CONGESTION"]


def support_rollup(tickets: DataFrame) -> DataFrame:
    """L2: per order ticket count, refund sum and lowest CSAT. Null order
    keys are dropped first (they would otherwise form one hot null group)."""
    return (tickets.filter(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(F.count("ticket_id").alias("ticket_count"),
                 F.sum("compensation_amount_cents").alias("refund_amount_cents"),
                 F.min("csat_score").alias("min_csat")))


def join_fact(orders: DataFrame, merchants: DataFrame, kds: DataFrame,
              dispatch: DataFrame, tickets: DataFrame) -> DataFrame:
    """L1 + L2: orders x merchants (inner) x kitchen (inner) left dispatch left
    support rollup.

    orders, kitchen, dispatch and the rollup are all keyed by order_id: the
    three joins come first, so they share one hash partitioning of order_id
    (and reuse the one an anti join against quarantined ids left). The
    merchant dimension comes last and without a hint; the planner broadcasts
    it only while its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, else one more exchange deals the
    joined rows by merchant, and AQE splits a merchant with very many.

    All order columns are kept but the audit stamp and names that another
    source gives; the two order times are named order_placed_at and
    promised_sla_at.
    """
    o = parse_timestamps(orders, ["order_timestamp", "promised_sla_timestamp"]).withColumnsRenamed(
        {"order_timestamp": "order_placed_at", "promised_sla_timestamp": "promised_sla_at"})
    m = merchants.select("merchant_id", "merchant_name", "cluster_id", "cuisine_type",
                         "kitchen_capacity")
    k = kds.select("order_id",
                   F.col("calibrated_ticket_printed_at").alias("kds_printed_at"),
                   F.col("calibrated_food_ready_at").alias("kds_ready_at"),
                   "active_kitchen_queue_depth", "estimated_prep_sec",
                   "clock_drift_calibrated_flag", "is_food_ready_imputed_flag")
    d = parse_timestamps(dispatch, DISPATCH_TS).select(
        "order_id", "driver_id", "attempt_number", *DISPATCH_TS, "network_jitter_clamped_flag")
    s = support_rollup(tickets)
    taken = {c for df in (m, k, d, s) for c in df.columns} - {"order_id", "merchant_id"}
    o = o.select(*[c for c in o.columns if c not in taken and c not in AUDIT_COLUMNS])
    f = (o.join(k, "order_id", "inner")
         .join(d, "order_id", "left")
         .join(s, "order_id", "left")
         .join(m, "merchant_id", "inner"))
    return f.withColumns({
        "ticket_count": F.coalesce(F.col("ticket_count"), F.lit(0)).cast("int"),
        "refund_amount_cents": F.coalesce(F.col("refund_amount_cents"), F.lit(0)).cast("long"),
    })


def stage_durations(fact: DataFrame) -> DataFrame:
    """Stage minutes, each clipped at 0 with null kept as null."""
    printed, ready = F.col("kds_printed_at"), F.col("kds_ready_at")
    placed, arrived = F.col("order_placed_at"), F.col("arrived_at_store_at")
    picked, delivered = F.col("picked_up_at"), F.col("delivered_at")
    sync = minutes_between(ready, arrived)
    return fact.withColumns({
        "stage1_merchant_lag_min": clip_low(minutes_between(placed, printed)),
        "actual_prep_min": minutes_between(printed, ready),
        "nominal_prep_min": F.col("estimated_prep_sec") / F.lit(60.0),
    }).withColumns({
        "stage2_prep_overrun_min": clip_low(F.col("actual_prep_min") - F.col("nominal_prep_min")),
        "stage3_dispatch_and_travel_min": clip_low(minutes_between(printed, arrived)),
        "rider_store_wait_min": clip_low(-sync),
        "food_counter_dwell_min": clip_low(sync),
        "stage4_store_handoff_min": clip_low(minutes_between(arrived, picked)),
        "stage5_last_mile_min": clip_low(minutes_between(picked, delivered)),
    })


def sla_flags(fact: DataFrame) -> DataFrame:
    """OTD minutes, completed, breached (null OTD never breaches)."""
    otd = minutes_between("order_placed_at", "delivered_at")
    done = F.coalesce(F.col("order_status") == COMPLETED, F.lit(False))  # a missing status is not completed
    return fact.withColumns({"total_otd_min": otd, "is_completed": done}).withColumn(
        "is_sla_breached", F.coalesce(F.col("total_otd_min") > SLA_MINUTES, F.lit(False)) & done)


def _first_max(values: list[Column], labels: list[str]) -> Column:
    """Arg-max, first listed wins ties; a null leader keeps its place and a
    null challenger never takes over (Python ``max`` over NaN)."""
    best, label = values[0], F.lit(labels[0])
    for v, lab in zip(values[1:], labels[1:]):
        take = F.coalesce(v > best, F.lit(False))
        best, label = F.when(take, v).otherwise(best), F.when(take, F.lit(lab)).otherwise(label)
    return label


def attribute_bottleneck(fact: DataFrame) -> DataFrame:
    """Built-in expression instead of a row-wise Python function."""
    last_mile = F.coalesce(F.greatest(F.col("stage5_last_mile_min") - LAST_MILE_NORMAL_MIN, F.lit(0.0)),
                           F.lit(0.0))
    vals = [F.col("stage1_merchant_lag_min"), F.col("stage2_prep_overrun_min"),
            F.col("rider_store_wait_min"), last_mile]
    incomplete = ~F.col("is_completed") | F.col("total_otd_min").isNull()
    return fact.withColumn("primary_delay_bottleneck",
                           F.when(incomplete, F.lit(INCOMPLETE_LABEL)).otherwise(_first_max(vals, BOTTLENECK_LABELS)))


def build_fact(orders, merchants, kds, dispatch, tickets) -> DataFrame:
    return attribute_bottleneck(sla_flags(stage_durations(join_fact(orders, merchants, kds, dispatch, tickets))))


def build_fact_from_calibration(silver, merchants: DataFrame, tickets: DataFrame) -> DataFrame:
    """The fact straight from a ``validate_and_calibrate`` result, in one
    plan. Only the orders are filtered against the quarantine: kitchen and
    dispatch rows of a quarantined order cannot survive the joins on
    order_id with the clean orders, so they need no anti-join of their own
    (one quarantined-id set per plan instead of three). Equal to
    ``build_fact`` over the three silver tables."""
    return build_fact(silver.orders, merchants, silver.kitchen.drop("_dlq"), silver.jittered.drop("_dlq"), tickets)


def bottleneck_distribution(fact: DataFrame) -> DataFrame:
    """Rows per bottleneck label, with the mode marked (tie -> smallest
    label). The window runs over the few grouped rows, not the fact."""
    from pyspark.sql import Window
    g = fact.groupBy("primary_delay_bottleneck").agg(F.count(F.lit(1)).alias("order_count"))
    w = Window.orderBy(F.desc("order_count"), F.asc("primary_delay_bottleneck"))
    return g.withColumn("is_mode", F.row_number().over(w) == 1)


def model_summary(fact: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """Completed count, breach %, P50 / P90 OTD of completed orders."""
    done = fact.filter("is_completed")
    a = agg_with_quantiles(done, [
        ("completed_orders", F.count(F.lit(1))),
        ("sla_breach_pct", F.round(rate_true(F.col("is_sla_breached")) * 100, 2)),
        ("p50_otd_min", Q("total_otd_min", 0.5)),
        ("p90_otd_min", Q("total_otd_min", 0.9)),
    ], approx=approx, distributed=distributed)
    c = fact.agg(F.count_if(~F.col("is_completed")).alias("cancelled_orders"))
    return combine_one_row(a, c)


__all__ = ["support_rollup", "join_fact", "stage_durations", "sla_flags", "attribute_bottleneck",
           "build_fact", "build_fact_from_calibration", "bottleneck_distribution", "model_summary", "pct"]
