"""Investigation queries over orders, tickets, app actions, interventions
and outcomes: late-delivery analysis, order timelines and the order-level
journey table (interaction -> intervention -> outcome).

1:N sources are always aggregated to order grain before they are joined,
so joins never multiply order rows; every pre-aggregate is keyed by
order_id and the joins reuse that partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions import (as_timestamps, combine_one_row, fmt_ts, minutes_between, norm_category, parse_ts, quantile,
                               rate_true)
from opslake.functions.quantiles import Q, agg_with_quantiles
from opslake.operators.contracts import dedupe_keep_first, keep_first_landed

# ---- fixed values --------------------------------------------------------------
LANDED = "_landed"  # column of the landing sequence
ORDER_TS = ["created_at", "promised_eta", "pickup_at", "actual_delivery_at"]
DELIVERED = "delivered"
CANCELLED = "cancelled"
SEVERE_DELAY_MIN = 10.0
TRAFFIC_ORDER = ["low", "medium", "high", "severe"]
# (label, lower bound exclusive, upper bound inclusive) as in pd.cut([0,5,10,15,25])
DISTANCE_BANDS = [("<5km", 0.0, 5.0), ("5-10km", 5.0, 10.0), ("10-15km", 10.0, 15.0), (">15km", 15.0, 25.0)]
ARRIVAL_EVENT_TYPES = ["ARRIVED_AT_RESTAURANT", "STORE_ARRIVED"]
ACTION_ETA, ACTION_CANCEL, ACTION_SUPPORT = "ETA_VIEWED", "CANCEL_CLICKED", "SUPPORT_OPENED"
NO_INTERVENTION = "NONE"
# (metric, kind, target)
METRICS = [("Late Delivery Rate", "Outcome", "< 15.0%"),
           ("Severe Delay Rate (>10m)", "Defect Outcome", "< 5.0%"),
           ("Frustration Escalation Rate", "Customer Interaction", "< 10.0%"),
           ("Operational Intervention Coverage", "Intervention", "> 30.0%"),
           ("Intervention Salvage Success Rate", "Intervention Efficacy", "> 60.0%")]
# timeline of an order: (event type, time column, actor, details before and after a column, that column)
ORDER_EVENTS = [("ORDER_CREATED", "created_at", "customer", "Placed order with restaurant ", "restaurant_id", ""),
                ("PROMISED_ETA", "promised_eta", "system", "Contractual delivery SLA promise", None, ""),
                ("COURIER_PICKUP", "pickup_at", "driver", "Driver ", "driver_id", " picked up order from store"),
                ("ORDER_DELIVERED", "actual_delivery_at", "driver", "Order delivered. Final status: ", "final_status", "")]
ACTION_EVENT, TICKET_EVENT, INTERVENTION_EVENT = "APP_", "SUPPORT_TICKET_", "INTERVENTION_"
ACTION_DETAILS, TICKET_DETAILS, INTERVENTION_DETAILS = "Channel: ", "Message: ", "Reason: "
CANONICAL_MODEL = [
    # (entity, role, pk, fks, grain)
    ("dim_customers", "Dimension", "customer_id", "", "1 row per customer"),
    ("dim_restaurants", "Dimension", "restaurant_id", "", "1 row per merchant"),
    ("dim_drivers", "Dimension", "driver_id", "", "1 row per driver"),
    ("fact_orders", "Core Fact Table", "order_id", "customer_id, restaurant_id, driver_id", "1 row per order"),
    ("fact_customer_actions", "Interaction Fact", "action_id", "order_id, customer_id", "1 row per in-app action"),
    ("fact_support_tickets", "Escalation Fact", "ticket_id", "order_id", "1 row per support ticket"),
    ("fact_interventions", "Action Fact", "intervention_id", "order_id", "1 row per operational intervention"),
    ("fact_order_outcomes", "Performance Fact", "order_id", "order_id", "1 row per evaluated order outcome"),
]


# ---- preparation -----------------------------------------------------------------
def parse_orders(raw: DataFrame) -> DataFrame:
    """Raw order rows with timestamps parsed (bad text -> null)."""
    return raw.withColumns({c: parse_ts(c) for c in ORDER_TS})


def first_orders(raw: DataFrame) -> DataFrame:
    """One row per order_id: the one that landed first where the rows carry
    their landing sequence, else the first by its times."""
    if LANDED in raw.columns:
        return keep_first_landed(raw, "order_id", LANDED)
    return dedupe_keep_first(raw, "order_id", ORDER_TS)


def prepare_orders(raw: DataFrame) -> DataFrame:
    """Dedupe (keep first per order_id), parse timestamps, normalise status,
    and derive delay minutes and the late flag for valid delivered orders."""
    d = parse_orders(first_orders(raw)).withColumn("final_status_norm", norm_category("final_status"))
    delivered = F.col("final_status_norm") == DELIVERED
    valid = delivered & F.col("actual_delivery_at").isNotNull() & F.col("promised_eta").isNotNull()
    return d.withColumns({
        "is_delivered": delivered,
        "is_valid_delivered": valid,
        "delay_min": F.when(valid, minutes_between("promised_eta", "actual_delivery_at")),
    }).withColumn("is_late", F.when(F.col("is_valid_delivered"), F.col("delay_min") > 0))


def outcomes(prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order outcomes: delivered flag, late flag (null without a delivery
    time), delay and outcome bucket; ``keep``: further columns of the order."""
    delay = minutes_between("promised_eta", "actual_delivery_at")
    delivered = F.col("is_delivered")
    return prepared.select(
        "order_id", *keep,
        F.when(delivered, 1.0).otherwise(0.0).alias("delivered_flag"),
        F.when(delivered & delay.isNotNull(), F.when(delay > 0, 1.0).otherwise(0.0)).alias("late_flag"),
        F.when(delivered, delay).alias("delay_min"),
        F.when(~delivered, "cancelled").when(delay.isNull(), "missing_timestamp")
        .when(delay <= 0, "on_time").when(delay <= SEVERE_DELAY_MIN, "late").otherwise("severe_late")
        .alias("outcome_bucket"))


def _valid(prepared: DataFrame) -> DataFrame:
    return prepared.filter("is_valid_delivered")


# ---- D1 - D8 ------------------------------------------------------------------------
def late_summary(prepared: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """Size of the late-delivery problem."""
    late_delay = F.when(F.col("is_late"), F.col("delay_min"))
    return agg_with_quantiles(prepared, [
        ("delivered_orders", F.count_if("is_delivered")),
        ("missing_delivery_time", F.count_if(F.col("is_delivered") & F.col("actual_delivery_at").isNull())),
        ("valid_delivered", F.count_if("is_valid_delivered")),
        ("late_orders", F.count_if("is_late")),
        ("late_rate_pct",
         F.round(F.count_if("is_late") * 100.0 / F.nullif(F.count_if("is_valid_delivered"), F.lit(0)), 2)),
        ("median_late_delay_min", Q(late_delay, 0.5)),
        ("mean_late_delay_min", F.round(F.avg(late_delay), 2)),
        ("p90_late_delay_min", Q(late_delay, 0.9)),
    ], approx=approx, distributed=distributed)


def top_delays(prepared: DataFrame, n: int = 5) -> DataFrame:
    """Worst n delays (top-k: TakeOrderedAndProject, no full sort)."""
    return (_valid(prepared)
            .select("order_id", "customer_id", "restaurant_id", fmt_ts("promised_eta").alias("promised_eta"),
                    fmt_ts("actual_delivery_at").alias("actual_delivery_at"), "delay_min")
            .orderBy(F.desc("delay_min"), F.asc("order_id")).limit(n))


def _late_stats(df: DataFrame, keys, approx=False, with_mean=True, with_median=True,
                distributed=None) -> DataFrame:
    measures = [("order_count", F.count("order_id")),
                ("late_rate_pct", F.round(F.avg(F.col("is_late").cast("double")) * 100, 2))]
    if with_median:
        measures.append(("median_delay_min", Q("delay_min", 0.5, 4)))
    if with_mean:
        measures.append(("mean_delay_min", F.round(F.avg("delay_min"), 4)))
    return agg_with_quantiles(df, measures, by=list(keys), approx=approx, distributed=distributed)


def late_by_category_ordered(prepared: DataFrame, col: str = "traffic_bucket",
                             order: list[str] = TRAFFIC_ORDER, approx: bool = False,
                             distributed: bool | None = None) -> DataFrame:
    """D3: only the listed categories, in the listed order. The order frame
    is a literal of len(order) rows, joined after the aggregation."""
    g = _late_stats(_valid(prepared).filter(F.col(col).isin(order)), [col], approx, distributed=distributed)
    ordinal = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)).cast("int")
    return g.withColumn("category_order", ordinal).orderBy("category_order")


def late_by_category(prepared: DataFrame, col: str = "weather_bucket", approx: bool = False,
                     distributed: bool | None = None) -> DataFrame:
    """Late rate per free category (rows without one are in none)."""
    known = _valid(prepared).filter(F.col(col).isNotNull())
    return _late_stats(known, [col], approx, distributed=distributed).orderBy(col)


def late_by_band(prepared: DataFrame, col: str = "distance_km_estimate", approx: bool = False,
                 distributed: bool | None = None) -> DataFrame:
    """Right-closed numeric bands; empty bands are kept with count 0,
    values outside every band are excluded."""
    x = F.col(col)
    band = None
    for label, lo, hi in DISTANCE_BANDS:
        cond = (x > lo) & (x <= hi)
        band = F.when(cond, F.lit(label)) if band is None else band.when(cond, F.lit(label))
    v = _valid(prepared).withColumn("distance_band", band).filter(F.col("distance_band").isNotNull())
    g = _late_stats(v, ["distance_band"], approx, with_mean=False, distributed=distributed)
    bands = prepared.sparkSession.createDataFrame(
        [(lab, i) for i, (lab, _, _) in enumerate(DISTANCE_BANDS)], "distance_band string, band_order int")
    return (bands.join(g, "distance_band", "left")
            .withColumn("order_count", F.coalesce(F.col("order_count"), F.lit(0).cast("long")))
            .orderBy("band_order"))


def late_by_hour(prepared: DataFrame) -> DataFrame:
    """Late rate by hour of order creation."""
    v = _valid(prepared).withColumn("order_hour", F.hour("created_at")).filter(F.col("order_hour").isNotNull())
    return _late_stats(v, ["order_hour"], with_mean=False, with_median=False).orderBy("order_hour")


def category_share(tickets: DataFrame, col: str = "category") -> DataFrame:
    """Count and % of all rows per category. The total is a scalar subquery over the
    same counts: no task sees all categories (they are free text). Rows without
    a category count in the total but get no row of their own (value
    counts leave the missing value out)."""
    g = tickets.groupBy(col).agg(F.count(F.lit(1)).alias("ticket_count"))
    total = tickets.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (g.filter(F.col(col).isNotNull())
            .withColumn("percentage", F.round(F.col("ticket_count") * 100.0 / total, 2))
            .orderBy(F.desc("ticket_count"), F.asc(col)))


def ticket_vs_operations(tickets: DataFrame, prepared: DataFrame) -> DataFrame:
    """Tickets joined to valid delivered orders vs the overall mean.
    Every ticket row counts once; tickets are first counted per order (a
    partial aggregate), so the join moves one row per order and the means
    are weighted by the ticket counts."""
    v = _valid(prepared).select("order_id", "is_late", "delay_min")
    t = (tickets.filter(F.col("order_id").isNotNull()).groupBy("order_id")
         .agg(F.count(F.lit(1)).alias("_n")))
    n, late, delay = F.col("_n"), F.col("is_late").cast("double"), F.col("delay_min")

    def weighted_mean(x):
        return F.sum(x * n) / F.sum(F.when(x.isNotNull(), n))

    m = t.join(v, "order_id", "inner").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("matched_tickets"),
        F.round(weighted_mean(late) * 100, 2).alias("matched_late_pct"),
        F.round(weighted_mean(delay), 4).alias("matched_mean_delay_min"))
    o = v.agg(F.round(F.avg("delay_min"), 4).alias("overall_mean_delay_min"))
    return combine_one_row(m, o)


# ---- S6 / D9 --------------------------------------------------------------------------
def flatten_documents(docs: DataFrame, parent_key: str = "driver_id", array_col: str = "events") -> DataFrame:
    """One row per nested event with the parent key repeated."""
    return docs.select(parent_key, F.explode(array_col).alias("e")).select(parent_key, "e.*")


def event_census(events: DataFrame, type_col: str = "type") -> DataFrame:
    """Rows per event type and whether an arrival event is ever recorded
    (a scalar subquery). Events without a type are not counted (value counts
    leave the missing value out)."""
    g = (events.filter(F.col(type_col).isNotNull())
         .groupBy(F.col(type_col).alias("event_type")).agg(F.count(F.lit(1)).alias("event_count")))
    has = events.agg(F.coalesce(F.bool_or(F.col(type_col).isin(ARRIVAL_EVENT_TYPES)), F.lit(False)).alias("x")).scalar()
    return g.withColumn("arrival_event_recorded", has).orderBy(F.desc("event_count"), "event_type")


# ---- D10 ---------------------------------------------------------------------------------
def order_timeline(orders_raw: DataFrame, actions: DataFrame, tickets: DataFrame,
                   interventions: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Timeline of every order from four sources.

    Order columns are unpivoted with ``stack``; all four projections are
    appended with ``unionByName``. ``event_no`` numbers an order's events by
    time, type and details; rows lie in that order within their task (no order
    among orders, so no global sort). A caller filters one order_id; the filter
    is pushed below the union into each source scan. Text times are parsed;
    unreadable ones are null and come last.

    Events without an order have no number. An order's events are dealt by slices of time (``slice_seconds``), so an
    order that holds a large part of all events is the work of many tasks. The
    counts of slices (a partial aggregate) give each slice its first
    number; a slice is numbered by itself.
    """
    actions = as_timestamps(actions, ["action_at"])
    tickets = as_timestamps(tickets, ["created_at"])
    interventions = as_timestamps(interventions, ["intervention_at"])
    def details(before, column, after):
        if column is None:
            return F.lit(before)
        return F.concat(F.lit(before), F.col(column).cast("string"), *([F.lit(after)] if after else []))

    s = first_orders(orders_raw).select("order_id", F.stack(F.lit(len(ORDER_EVENTS)), *[
        x for name, at, actor, before, column, after in ORDER_EVENTS
        for x in (F.lit(name), F.col(at), F.lit(actor), details(before, column, after))
    ]).alias("event_type", "event_time_raw", "actor", "details")).filter(F.col("event_time_raw").isNotNull())
    s = s.select("order_id", parse_ts("event_time_raw").alias("event_time"), "event_type", "actor",
                 F.lit("orders").alias("source_system"), "details")
    a = actions.select("order_id", F.col("action_at").alias("event_time"),
                       F.concat(F.lit(ACTION_EVENT), F.col("action_type")).alias("event_type"),
                       F.lit("customer").alias("actor"), F.lit("customer_app_actions").alias("source_system"),
                       F.concat(F.lit(ACTION_DETAILS), F.col("channel")).alias("details"))
    t = tickets.filter(F.col("order_id").isNotNull()).select(
        "order_id", F.col("created_at").alias("event_time"),
        F.concat(F.lit(TICKET_EVENT), F.upper("category")).alias("event_type"),
        F.lit("customer").alias("actor"), F.lit("support_tickets").alias("source_system"),
        F.concat(F.lit(TICKET_DETAILS), F.col("customer_message")).alias("details"))
    i = interventions.select(
        "order_id", F.col("intervention_at").alias("event_time"),
        F.concat(F.lit(INTERVENTION_EVENT), F.col("intervention_type")).alias("event_type"),
        F.col("initiated_by").alias("actor"), F.lit("order_interventions").alias("source_system"),
        F.concat(F.lit(INTERVENTION_DETAILS), F.col("reason")).alias("details"))
    u = reduce(DataFrame.unionByName, [s, a, t, i])
    # a slice after all others for events without a time
    at = F.coalesce(F.floor(F.unix_micros("event_time") / F.lit(slice_seconds * 1_000_000)), F.lit(1 << 62)).cast("long")
    u = u.withColumn("_slice", at)
    before = Window.partitionBy("order_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (u.filter(F.col("order_id").isNotNull()).groupBy("order_id", "_slice").agg(F.count(F.lit(1)).alias("_n"))
              .select("order_id", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    order = [F.asc_nulls_last("event_time"), "event_type", "details", "actor", "source_system"]
    inside = F.row_number().over(Window.partitionBy("order_id", "_slice").orderBy(*order))
    # the join and the numbering share one exchange of the events
    numbered = u.join(starts, ["order_id", "_slice"], "left").withColumn("event_no", F.col("_start") + inside)
    return numbered.drop("_slice", "_start")  # the numbering has sorted each task's rows


# ---- D11 - D14 -----------------------------------------------------------------------------
def actions_rollup(actions: DataFrame) -> DataFrame:
    """ETA views, cancel attempted 0/1, support opened 0/1 per order."""
    t = F.col("action_type")
    return (actions.filter(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.count_if(t == ACTION_ETA).alias("eta_view_count"),
                 F.max((t == ACTION_CANCEL).cast("int")).alias("cancel_attempted"),
                 F.max((t == ACTION_SUPPORT).cast("int")).alias("support_app_opened")))


def tickets_rollup(tickets: DataFrame) -> DataFrame:
    """Tickets per order (null keys removed) and a constant opened flag."""
    return (tickets.filter(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.count("ticket_id").alias("support_tickets_count"))
            .withColumn("support_ticket_opened", F.lit(1)))


def interventions_rollup(interventions: DataFrame) -> DataFrame:
    """Intervention count and the sorted distinct types joined by ', '.
    collect_set is bounded by the number of distinct types, and it
    aggregates partially map-side, so a hot order stays small."""
    return (interventions.filter(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.count("intervention_id").alias("intervention_count"),
                 F.array_join(F.array_sort(F.collect_set("intervention_type")), ", ").alias("intervention_types")))


def order_journey(prepared: DataFrame, actions: DataFrame, tickets: DataFrame, interventions: DataFrame) -> DataFrame:
    """Prepared orders (one row each) with their outcome + the three
    order-grain rollups."""
    j = (outcomes(prepared, ("customer_id", "restaurant_id", "driver_id", "final_status"))
         .join(actions_rollup(actions), "order_id", "left")
         .join(tickets_rollup(tickets), "order_id", "left")
         .join(interventions_rollup(interventions), "order_id", "left"))
    zero = F.lit(0)
    j = j.withColumns({
        "support_app_opened": F.coalesce("support_app_opened", zero).cast("int"),
        "cancel_attempted": F.coalesce("cancel_attempted", zero).cast("int"),
        "support_ticket_opened": F.coalesce("support_ticket_opened", zero).cast("int"),
        "intervention_count": F.coalesce("intervention_count", zero).cast("int"),
        "intervention_types": F.coalesce("intervention_types", F.lit(NO_INTERVENTION)),
    })
    return j.withColumn("support_opened",
                        ((F.col("support_app_opened") == 1) | (F.col("support_ticket_opened") == 1)).cast("int"))


# ---- D15 - D21 -------------------------------------------------------------------------------
def _is(c: str, v) -> F.Column:
    return F.coalesce(F.col(c) == v, F.lit(False))


def journey_questions(journey: DataFrame, interventions: DataFrame) -> DataFrame:
    """The four journey questions in one aggregate (+ the mode type)."""
    late = _is("late_flag", 1.0)
    support = F.col("support_opened") == 1
    frustrated = (support | (F.col("cancel_attempted") == 1)) & (F.col("intervention_count") == 0)
    a = journey.agg(
        F.count_if(late).alias("late_orders"),
        F.count_if(late & support).alias("late_with_support"),
        F.count_if(F.col("intervention_count") > 0).alias("intervened_orders"),
        F.round(rate_true(F.col("intervention_count") > 0) * 100, 2).alias("intervened_pct"),
        F.count_if(frustrated).alias("frustrated_without_intervention"),
        F.count_if(frustrated & late).alias("frustrated_without_intervention_late"),
        F.count_if(frustrated & (F.col("final_status") == CANCELLED)).alias("frustrated_without_intervention_cancelled"))
    a = a.withColumn("late_with_support_pct",
                     F.round(F.col("late_with_support") * 100.0 / F.nullif(F.col("late_orders"), F.lit(0)), 2))
    w = Window.orderBy(F.desc("n"), F.asc("intervention_type"))
    mode = (interventions.filter(F.col("intervention_type").isNotNull())
            .groupBy("intervention_type").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(F.col("intervention_type").alias("most_common_intervention"),
                    F.col("n").alias("most_common_intervention_count")))
    return combine_one_row(a, mode)


def journey_metrics(journey: DataFrame) -> DataFrame:
    """Five business metrics with kind and target, unpivoted to one row each."""
    delivered = F.col("delivered_flag") == 1
    intervened = F.col("intervention_count") > 0

    def rate_over(pop, cond):
        return F.round(F.avg(F.when(pop, F.coalesce(cond, F.lit(False)).cast("double"))) * 100, 2)

    a = journey.agg(
        rate_over(delivered, F.col("late_flag") == 1.0).alias("m1"),
        rate_over(delivered, F.col("delay_min") > SEVERE_DELAY_MIN).alias("m2"),
        rate_over(F.lit(True), (F.col("support_opened") == 1) | (F.col("cancel_attempted") == 1)).alias("m3"),
        rate_over(F.lit(True), intervened).alias("m4"),
        rate_over(intervened & delivered, F.col("late_flag") == 0.0).alias("m5"))
    rows = F.array(*[F.struct(F.lit(i + 1).alias("metric_no"), F.lit(name).alias("metric_name"),
                              F.lit(kind).alias("metric_type"), F.col(f"m{i + 1}").alias("value_pct"),
                              F.lit(target).alias("target")) for i, (name, kind, target) in enumerate(METRICS)])
    return a.select(F.inline(rows))


def _delivered(journey: DataFrame) -> DataFrame:
    return journey.filter(F.col("delivered_flag") == 1)


def delay_by_support(journey: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """Delay distribution with vs without support contact."""
    return agg_with_quantiles(_delivered(journey), [
        ("order_count", F.count("delay_min")),
        ("median_delay", Q("delay_min", 0.5, 4)),
        ("mean_delay", F.round(F.avg("delay_min"), 4)),
        ("p90_delay", Q("delay_min", 0.9, 4)),
    ], by=["support_opened"], approx=approx, distributed=distributed).orderBy("support_opened")


def late_by_intervened(journey: DataFrame, approx: bool = False, distributed: bool | None = None) -> DataFrame:
    """Late rate with vs without intervention (mean skips null flags)."""
    d = _delivered(journey).withColumn("received_intervention", F.col("intervention_count") > 0)
    return agg_with_quantiles(d, [
        ("order_count", F.count("order_id")),
        ("late_rate_pct", F.round(F.avg("late_flag") * 100, 2)),
        ("median_delay_min", Q("delay_min", 0.5, 4)),
    ], by=["received_intervention"], approx=approx, distributed=distributed).orderBy("received_intervention")


def late_by_intervention_type(interventions: DataFrame, outcome: DataFrame, approx: bool = False,
                              distributed: bool | None = None) -> DataFrame:
    """Per intervention type over delivered outcomes; every
    intervention row counts once (1:N).

    Exact mode pre-aggregates interventions to (order, type) counts before
    the join, so an order with a huge number of interventions ships a few
    rows, not all of them; averages and the median are weighted by the
    counts (``percentile`` with a frequency), which equals the row-level
    result. The approximate sketch takes no weights and joins row-level
    (AQE splits a skewed join key)."""
    interventions = interventions.filter(F.col("intervention_type").isNotNull())
    out = outcome.filter(F.col("delivered_flag") == 1).select("order_id", "late_flag", "delay_min")
    if approx:
        j = interventions.join(out, "order_id", "inner")
        agg = [F.count("intervention_id").alias("interventions_count"),
               F.round(F.avg("late_flag") * 100, 2).alias("late_rate_pct"),
               F.round(quantile("delay_min", 0.5, approx=True), 4).alias("median_delay_min")]
    else:
        per = (interventions.groupBy("order_id", "intervention_type")
               .agg(F.count(F.lit(1)).alias("_rows"), F.count("intervention_id").alias("_ids")))
        j = per.join(out, "order_id", "inner")
        rows, flag = F.col("_rows"), F.col("late_flag")
        return agg_with_quantiles(j, [
            ("interventions_count", F.sum("_ids")),
            ("late_rate_pct", F.round(F.sum(flag * rows) / F.sum(F.when(flag.isNotNull(), rows)) * 100, 2)),
            ("median_delay_min", Q("delay_min", 0.5, 4)),
        ], by=["intervention_type"], distributed=distributed, weight="_rows").orderBy("late_rate_pct", "intervention_type")
    return j.groupBy("intervention_type").agg(*agg).orderBy("late_rate_pct", "intervention_type")


def top_late_parents(journey: DataFrame, parents: DataFrame, n: int = 5,
                     key: str = "restaurant_id") -> DataFrame:
    """Top n parents by late orders; names are joined after the limit,
    so the join input is n rows. Orders without a parent take no place."""
    late = _delivered(journey).filter((F.col("late_flag") == 1.0) & F.col(key).isNotNull())
    top = (late.groupBy(key).agg(F.count("order_id").alias("late_orders_count"),
                                 F.round(F.avg("delay_min"), 4).alias("mean_delay_min"))
           .orderBy(F.desc("late_orders_count"), F.asc(key)).limit(n))
    return top.join(parents, key, "inner").orderBy(F.desc("late_orders_count"), F.asc(key))


def worst_journeys(journey: DataFrame) -> DataFrame:
    """Support opened + intervened + still late."""
    return journey.filter((F.col("support_opened") == 1) & (F.col("intervention_count") > 0)
                          & (F.col("late_flag") == 1.0)).select(
        "order_id", "customer_id", "restaurant_id", "intervention_types", "delay_min")


def model_census(tables: dict[str, DataFrame]) -> DataFrame:
    """Canonical model entities with key, foreign keys, grain and rows.
    fact_orders counts distinct order ids; the others count rows."""
    parts = []
    for entity, role, pk, fks, grain in CANONICAL_MODEL:
        df = tables[entity]
        cnt = F.count_distinct(pk) if entity == "fact_orders" else F.count(F.lit(1))
        parts.append(df.agg(cnt.alias("row_count")).select(
            F.lit(entity).alias("entity"), F.lit(role).alias("role"), F.lit(pk).alias("primary_key"),
            F.lit(fks).alias("foreign_keys"), F.lit(grain).alias("grain"), "row_count"))
    return reduce(DataFrame.unionByName, parts)
