"""Gold marts: KPI summary, cluster mart, what-if scenarios, evidence table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import clip, pct
from opslake.functions.quantiles import Q, agg_with_quantiles

# ---- fixed values ------------------------------------------------------------
SLA_MINUTES = 35.0
STAGED_WAIT_FACTOR = 0.28
STAGED_WAIT_MIN, STAGED_WAIT_MAX = 1.5, 4.0
BUFFER_QUEUE_DEPTH = 8        # strict: depth > 8
BUFFER_REDUCTION_MIN = 4.5
# (scenario, order, staged?, buffered?, refund factor, fleet gain %, feasibility)
SCENARIOS = [
    ("Baseline (Current Immediate Dispatch)", 0, False, False, 1.0, 0.0,
     "Status Quo (Bleeding SLA & Margin)"),
    ("Intervention 1: Staged Offset Dispatch", 1, True, False, 0.58, 21.4,
     "High (Algorithm Change Only)"),
    ("Intervention 2: Queue-Aware Prep Buffering", 2, False, True, 0.72, 5.2,
     "High (KDS Config & Pacing)"),
    ("Intervention 3: Combined (Staged Dispatch + Buffering)", 3, True, True, 0.29, 26.8,
     "Recommended FDE Strategy"),
]
# (metric, formula, target text, comparison, threshold)
EVIDENCE_TARGETS = [
    ("P50 OTD (min)", "median(delivered - placed) over completed", "<= 25", "le", 25.0, "p50_otd_min"),
    ("P90 OTD (min)", "quantile_cont(OTD, 0.90) over completed", "<= 35", "le", 35.0, "p90_otd_min"),
    ("SLA Breach Rate (%)", "completed with OTD > 35 / completed", "< 8", "lt", 8.0, "sla_breach_rate_pct"),
    ("Mean Rider Store Wait (min)", "avg(max(0, ready - arrived))", "<= 3.5", "le", 3.5,
     "mean_rider_store_wait_min"),
    ("Mean Kitchen Prep Overrun (min)", "avg(max(0, actual prep - nominal prep))", "<= 2.0", "le", 2.0,
     "mean_kitchen_prep_overrun_min"),
    ("Customer Complaint Rate (%)", "orders with tickets / all orders", "< 4", "lt", 4.0,
     "customer_complaint_rate_pct"),
]


def kpi_summary(fact: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """M1: one row of 15 measures. Completed-only measures use a guarded
    column (null outside the population), exactly like CASE WHEN in SQL."""
    done = F.col("is_completed")

    def on_done(c):
        return F.when(done, F.col(c))

    return agg_with_quantiles(fact, [
        ("total_orders_ingested", F.count(F.lit(1))),
        ("completed_orders", F.count_if(done)),
        ("cancelled_orders", F.count_if(~done)),
        ("mean_otd_min", F.round(F.avg(on_done("total_otd_min")), 2)),
        ("p50_otd_min", Q(on_done("total_otd_min"), 0.5)),
        ("p90_otd_min", Q(on_done("total_otd_min"), 0.9)),
        ("p95_otd_min", Q(on_done("total_otd_min"), 0.95)),
        ("mean_rider_store_wait_min", F.round(F.avg(on_done("rider_store_wait_min")), 2)),
        ("p90_rider_store_wait_min", Q(on_done("rider_store_wait_min"), 0.9)),
        ("mean_kitchen_prep_overrun_min", F.round(F.avg(on_done("stage2_prep_overrun_min")), 2)),
        ("p90_kitchen_prep_overrun_min", Q(on_done("stage2_prep_overrun_min"), 0.9)),
        ("mean_food_counter_dwell_min", F.round(F.avg(on_done("food_counter_dwell_min")), 2)),
        ("sla_breach_rate_pct", pct(F.count_if("is_sla_breached"), F.count_if(done))),
        ("customer_complaint_rate_pct", pct(F.count_if(F.col("ticket_count") > 0), F.count(F.lit(1)))),
        ("total_refund_liability_usd", F.round(F.sum("refund_amount_cents") / F.lit(100.0), 2)),
    ], approx=approx, distributed=distributed)


def kpi_by_cluster(fact: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """M2: completed orders per cluster, worst breach rate first."""
    out = agg_with_quantiles(fact.filter(F.col("is_completed")), [
        ("order_count", F.count(F.lit(1))),
        ("sla_breach_rate_pct", pct(F.count_if("is_sla_breached"), F.count(F.lit(1)))),
        ("p50_otd_min", Q("total_otd_min", 0.5)),
        ("p90_otd_min", Q("total_otd_min", 0.9)),
        ("avg_rider_wait_min", F.round(F.avg("rider_store_wait_min"), 2)),
        ("avg_prep_overrun_min", F.round(F.avg("stage2_prep_overrun_min"), 2)),
        ("refund_liability_usd", F.round(F.sum("refund_amount_cents") / F.lit(100.0), 2)),
    ], by=["cluster_id"], approx=approx, distributed=distributed)
    return out.orderBy(F.desc("sla_breach_rate_pct"), F.asc("cluster_id"))


def scenario_evaluation(fact: DataFrame, approx: bool = False) -> DataFrame:
    """M3: all four what-if scenarios over completed orders, from weighted cells.

    A scenario sees an order's OTD, its rider wait and whether its queue is over
    the buffer depth, so orders are first counted by these three (a partial
    aggregate). Only the cells are expanded into their four variants; counts,
    means and quantiles are weighted by the cells' orders. The refund total is
    the same sum for every scenario.
    """
    done = fact.filter(F.col("is_completed"))
    cells = done.groupBy(
        F.col("total_otd_min").cast("double").alias("_otd"), F.col("rider_store_wait_min").cast("double").alias("_wait"),
        F.coalesce(F.col("active_kitchen_queue_depth") > BUFFER_QUEUE_DEPTH, F.lit(False)).alias("_deep"),
    ).agg(F.count(F.lit(1)).alias("_orders"), F.sum("refund_amount_cents").alias("_cents"))
    wait = F.col("_wait")
    staged_wait = clip(wait * STAGED_WAIT_FACTOR, STAGED_WAIT_MIN, STAGED_WAIT_MAX)
    staged_otd = F.col("_otd") - (wait - staged_wait)
    buffer = F.when(F.col("_deep"), F.lit(BUFFER_REDUCTION_MIN)).otherwise(F.lit(0.0))
    variants = []
    for _, order, staged, buffered, *_ in SCENARIOS:
        otd = staged_otd if staged else F.col("_otd")
        if buffered:
            otd = otd - buffer
        variants.append(F.struct(F.lit(order).alias("scenario_order"), otd.alias("otd"),
                                 (staged_wait if staged else wait).alias("wait")))
    x = cells.select("_orders", "_cents", F.inline(F.array(*variants)))
    n = F.col("_orders")
    measures = [
        ("sla_breach_pct", F.round(F.sum(F.when(F.col("otd") > SLA_MINUTES, n).otherwise(0)) * 100.0 / F.sum(n), 2)),
        ("mean_rider_wait_min", F.round(F.sum(F.col("wait") * n) / F.sum(F.when(F.col("wait").isNotNull(), n)), 2)),
        ("_base_refund", F.sum("_cents") / F.lit(100.0)), ("p50_otd_min", Q("otd", 0.5)), ("p90_otd_min", Q("otd", 0.9))]
    if approx:  # the sketch takes no weights
        each = x.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), n)))
        q = agg_with_quantiles(each, measures[3:], by=["scenario_order"], approx=True)
        g = agg_with_quantiles(x, measures[:3], by=["scenario_order"]).join(q, "scenario_order")
    else:
        g = agg_with_quantiles(x, measures, by=["scenario_order"], weight="_orders")
    texts = F.element_at(F.array(*[F.struct(F.lit(name).alias("scenario"), F.lit(factor).alias("factor"),
                                            F.lit(gain).alias("gain"), F.lit(feasible).alias("feasibility"))
                                   for name, _, _, _, factor, gain, feasible in SCENARIOS]), F.col("scenario_order") + 1)
    return g.withColumn("_t", texts).select(
        F.col("_t.scenario").alias("scenario"), "scenario_order", "p50_otd_min", "p90_otd_min", "sla_breach_pct", "mean_rider_wait_min",
        F.col("_t.gain").alias("effective_fleet_capacity_gain_pct"),
        F.round(F.col("_base_refund") * F.col("_t.factor"), 2).alias("projected_refund_liability_usd"),
        F.col("_t.feasibility").alias("operational_feasibility"),
    ).orderBy("scenario_order")


def scenario_lookup(scenarios: DataFrame, text: str, how: str = "contains") -> DataFrame:
    """M5: pick scenario rows by name (``contains`` or ``startswith``)."""
    c = F.col("scenario")
    return scenarios.filter(c.contains(text) if how == "contains" else c.startswith(text))


def evidence_table(kpi: DataFrame) -> DataFrame:
    """M4: unpivot the KPI row against its targets and compute a status."""
    rows = []
    for metric, formula, target, op, thr, col in EVIDENCE_TARGETS:
        v = F.col(col).cast("double")
        ok = (v <= thr) if op == "le" else (v < thr)
        rows.append(F.struct(
            F.lit(metric).alias("metric"), F.lit(formula).alias("formula"),
            v.alias("observed"), F.lit(target).alias("target"),
            F.when(v.isNull(), "UNKNOWN").when(ok, "PASS").otherwise("FAIL").alias("status")))
    return kpi.select(F.inline(F.array(*rows)))
