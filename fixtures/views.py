"""Source-shaped tables derived from the driver's parquet tables.

The library operators expect the shapes of the operational sources (orders,
merchants, kitchen tickets, dispatch attempts, support tickets, app actions,
interventions, ...). The test data is TPC-H-like, so these adapters derive
those sources deterministically with integer arithmetic on keys
(k = o_orderkey). The same definitions exist as DuckDB SQL in
``fixtures/oracle.py``; both engines therefore produce the same rows.

Everything is lazy: each property is a DataFrame over a parquet scan, so
Catalyst prunes the columns each query actually uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.functions import fmt_ts
from opslake.sources.landing import with_landing_sequence


def K():
    return F.col("k")


def _plus(ts, secs):
    return F.timestamp_add("SECOND", secs, ts if not isinstance(ts, str) else F.col(ts))


def _pick(idx, values):
    """values[idx] for a small fixed list (idx is a 0-based integer column)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


class DriverTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    # declared schemas of the driver tables read here: no footer-inference job
    # per read, and a schema drift fails the scan instead of changing types
    SCHEMAS = {
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                 "p_retailprice double"),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp_ntz"),
        "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    }

    def raw(self, name: str) -> DataFrame:
        r = self.spark.read
        if name in self.SCHEMAS:
            r = r.schema(self.SCHEMAS[name])
        return r.parquet(f"{self.sf_dir}/{name}.parquet")

    def landed(self, name: str) -> DataFrame:
        """The raw table with its rows' landing sequence, ``_landed``."""
        return with_landing_sequence(self.raw(name))

    # ---- scalar: N = max(k) + 1, as a scalar subquery (no join) ----------
    def n_orders(self):
        return self.raw("orders").agg((F.max("o_orderkey") + 1).alias("n")).scalar()

    # ---- pipeline data set ------------------------------------------------
    @cached_property
    def lifecycle_src(self) -> DataFrame:
        """One row per order with every derived timestamp. A narrow,
        deterministic projection of the orders scan: each consumer
        recomputes it from the column-pruned scan, which is cheaper than
        shuffling and caching the whole derived frame."""
        return self._lifecycle(self.raw("orders"))

    def _lifecycle(self, rows: DataFrame, *also: str) -> DataFrame:
        o = rows.select(
            F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus",
            F.col("o_orderdate").cast("timestamp").alias("day"), *also)
        cancelled = (F.col("o_orderstatus") == "P") & (K() % 3 == 0)
        aborted = cancelled & (K() % 5 < 3)
        placed = _plus("day", K() % 86400)
        null_ts = F.lit(None).cast("timestamp")
        return o.select(
            K().alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_custkey").alias("merchant_id"),
            F.when(cancelled, "CANCELLED").otherwise("COMPLETED").alias("order_status"),
            aborted.alias("aborted"),
            placed.alias("placed"),
            _plus(placed, (K() * 7) % 720 - 400).alias("printed"),
            F.when(K() % 23 == 0, null_ts).otherwise(
                _plus(placed, (K() * 7) % 720 + 200 + (K() * 13) % 1000)).alias("ready"),
            F.when(aborted, null_ts).otherwise(_plus(placed, 900 + (K() * 11) % 1500)).alias("picked"),
            F.when(aborted, null_ts).otherwise(
                _plus(placed, 900 + (K() * 11) % 1500 + (K() * 17) % 1500 - 1410)).alias("arrived"),
            F.when(aborted, null_ts).otherwise(
                _plus(placed, 1200 + (K() * 11) % 1500 + (K() * 19) % 900)).alias("delivered"),
            (K() % 17).cast("int").alias("queue_depth"),
            (360 + 180 * (K() % 3)).cast("int").alias("estimated_prep_sec"),
            *also,
        )

    @cached_property
    def orders(self) -> DataFrame:
        s = self.lifecycle_src
        return s.select(
            "order_id", "customer_id", "merchant_id",
            F.when(F.col("order_id") % 211 != 5, F.col("order_status")).alias("order_status"),
            F.col("placed").alias("order_timestamp"),
            _plus("placed", F.lit(2100)).alias("promised_sla_timestamp"))

    @cached_property
    def merchants(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("merchant_id"),
            F.col("c_name").alias("merchant_name"),
            F.col("c_mktsegment").alias("cluster_id"),
            F.concat(F.lit("cuisine_"), (F.col("c_nationkey") % 6).cast("string")).alias("cuisine_type"),
            (4 + F.col("c_custkey") % 9).cast("int").alias("kitchen_capacity"),
            (8 + F.col("c_custkey") % 7).cast("int").alias("nominal_prep_min"))

    @cached_property
    def kds_logs(self) -> DataFrame:
        s = self.lifecycle_src
        return s.select(
            F.col("order_id").alias("kds_ticket_id"), "order_id", "merchant_id",
            F.col("printed").alias("ticket_printed_at"),
            F.col("ready").alias("food_ready_at"),
            F.col("queue_depth").alias("active_kitchen_queue_depth"),
            "estimated_prep_sec")

    @cached_property
    def dispatch_attempts(self) -> DataFrame:
        s = self.lifecycle_src.withColumn("k", F.col("order_id"))
        n = 1 + (K() % 7 == 0).cast("int") + (K() % 21 == 0).cast("int")
        a = F.col("attempt_number")
        last = a == F.col("n")
        null_ts = F.lit(None).cast("timestamp")
        return (s.withColumn("n", n)
                .withColumn("attempt_number", F.explode(F.sequence(F.lit(1), F.col("n"))))
                .select(
                    (K() * 3 + a - 1).alias("dispatch_id"),
                    F.when(last | (K() % 11 != 0), K()).alias("order_id"),
                    ((K() * 7 + a) % 500).alias("driver_id"),
                    a.alias("attempt_number"),
                    F.when(~last, "REJECTED").when(F.col("aborted"), "CANCELLED_BY_SYSTEM")
                    .otherwise("COMPLETED").alias("dispatch_status"),
                    _plus("placed", a * 60).alias("offered_at"),
                    _plus("placed", a * 60 + 20).alias("responded_at"),
                    F.when(last, F.col("arrived")).otherwise(null_ts).alias("arrived_at_store_at"),
                    F.when(last, F.col("picked")).otherwise(null_ts).alias("picked_up_at"),
                    F.when(last, F.col("delivered")).otherwise(null_ts).alias("delivered_at")))

    @cached_property
    def support_tickets(self) -> DataFrame:
        e = F.col("event_id")
        ev = self.raw("events").filter(F.col("event_type") == "error")
        n = self.n_orders()
        return ev.select(
            e.alias("ticket_id"),
            F.when(e % 50 == 0, F.lit(None).cast("long")).when(e % 97 == 0, -1 - e)
            .otherwise((e * 5) % n).alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("timestamp").alias("created_at"),
            F.when(e % 60 == 0, "Late Delivery").when(e % 61 == 0, "late_delivery ")
            .when(e % 67 == 0, "ETA issue").when(e % 71 == 0, F.lit(None).cast("string"))
            .otherwise(_pick(e % 3, ["late_delivery", "eta_changed", "restaurant_delay"])).alias("category"),
            F.col("props").alias("customer_message"),
            F.round(F.col("value") * 100).cast("long").alias("compensation_amount_cents"),
            (1 + e % 5).cast("int").alias("csat_score"))

    @cached_property
    def lines(self) -> DataFrame:
        return self._lines(self.raw("lineitem"))

    @cached_property
    def landed_lines(self) -> DataFrame:
        return self._lines(self.landed("lineitem"), "_landed")

    def _lines(self, li: DataFrame, *also: str) -> DataFrame:
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.round(F.col("l_extendedprice") * 100).cast("long").alias("unit_price_cents"),
            "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", *also)

    @cached_property
    def headers(self) -> DataFrame:
        per = (self.lines.groupBy("order_id")
               .agg(F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("s")))
        o = self.raw("orders").select(F.col("o_orderkey").alias("order_id"))
        j = o.join(per, "order_id", "left")
        oid = F.col("order_id")
        return j.select(
            "order_id",
            (F.coalesce(F.col("s"), F.lit(0)) + (oid % 250 == 0).cast("long")).alias("subtotal_cents"),
            (199 + (oid % 5) * 100).alias("delivery_fee_cents"),
            ((oid * 37) % 800).alias("tip_cents"))

    # ---- notebook data set --------------------------------------------------
    @cached_property
    def orders_nb(self) -> DataFrame:
        """Raw notebook orders: string timestamps in mixed layouts, status and
        traffic spellings that need normalising, rows landed twice."""
        return self._orders_nb(self.lifecycle_src)

    @cached_property
    def landed_orders_nb(self) -> DataFrame:
        """The same with their landing sequence, ``_landed``."""
        return self._orders_nb(self._lifecycle(self.landed("orders"), "_landed"))

    def _orders_nb(self, s: DataFrame) -> DataFrame:
        landed = [(F.col("_landed") * 2 + F.col("_copy")).alias("_landed")] if "_landed" in s.columns else []
        s = s.withColumn("k", F.col("order_id"))
        # rows with k % 500 = 0 land twice (one pass, the copy made by explode): the copy right after the
        # row, with another driver; the row itself has a time nobody can read where k % 1000 = 0
        copies = F.when(K() % 500 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        s = s.withColumn("_copy", F.explode(copies))
        copy = F.col("_copy")
        layout = K() % 3

        def as_text(ts):
            return (F.when(layout == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
                    .when(layout == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
                    .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))

        null_s = F.lit(None).cast("string")
        return s.select(
            F.col("order_id"), F.col("customer_id"),
            F.when(K() % 9 != 4, F.col("customer_id") % 60).alias("restaurant_id"),
            ((K() + copy) % 120).alias("driver_id"),
            F.when((K() % 1000 == 0) & (copy == 0), "unknown").when(K() % 131 != 6, as_text(F.col("placed"))).alias("created_at"),
            as_text(F.when(K() % 400 == 7, _plus("placed", F.lit(-600)))
                    .otherwise(_plus("placed", F.lit(2400)))).alias("promised_eta"),
            as_text(F.when(K() % 300 == 11, _plus("delivered", F.lit(60)))
                    .otherwise(F.col("picked"))).alias("pickup_at"),
            F.when(K() % 41 == 0, null_s).when(K() % 53 == 0, F.lit("pending"))
            .otherwise(as_text(F.col("delivered"))).alias("actual_delivery_at"),
            F.when(F.col("order_status") == "CANCELLED", "cancelled").when(K() % 97 == 0, "Delivered")
            .when(K() % 89 == 0, "delivered ").otherwise("delivered").alias("final_status"),
            F.when(K() % 500 == 3, "HIGH").otherwise(
                _pick(K() % 4, ["low", "medium", "high", "severe"])).alias("traffic_bucket"),
            F.when(K() % 83 != 2, _pick(F.col("customer_id") % 5, ["clear", "cloudy", "rain", "storm", "snow"]))
            .alias("weather_bucket"),
            (((K() * 29) % 300) / 10.0).alias("distance_km_estimate"), *landed)

    @cached_property
    def restaurants(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("restaurant_id"),
            F.col("s_name").alias("restaurant_name"),
            F.concat(F.lit("cuisine_"), (F.col("s_nationkey") % 6).cast("string")).alias("cuisine"))

    @cached_property
    def drivers(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("driver_id"),
                                       F.col("p_brand").alias("vehicle"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("customer_id"),
                                           F.col("c_mktsegment").alias("segment"))

    @cached_property
    def restaurant_status(self) -> DataFrame:
        s = self.lifecycle_src.withColumn("k", F.col("order_id")).filter(K() % 3 == 0)
        return s.select(
            "order_id", (F.col("customer_id") % 60).alias("restaurant_id"),
            _pick(K() % 7, ["preparing", "ready", "ready ", "READY", "handed_off", "handoff", "unknown"])
            .alias("status"),
            F.when(K() % 57 == 0, "soon").otherwise(
                F.date_format(_plus("placed", (K() * 13) % 3000), "yyyy-MM-dd HH:mm:ss")).alias("last_updated_at"))

    @cached_property
    def app_actions(self) -> DataFrame:
        e = F.col("event_id")
        ev = self.raw("events").filter(F.col("event_type").isin("view", "click", "signup"))
        n = self.n_orders()
        return ev.select(
            e.alias("action_id"),
            ((F.expr("event_id div 4") * 7) % n).alias("order_id"),
            F.col("ts").cast("timestamp").alias("action_at"),
            F.when(F.col("event_type") == "view", "ETA_VIEWED")
            .when(F.col("event_type") == "click", "CANCEL_CLICKED")
            .otherwise("SUPPORT_OPENED").alias("action_type"),
            F.when(F.col("user_id") % 2 == 0, "app").otherwise("web").alias("channel"))

    @cached_property
    def interventions(self) -> DataFrame:
        e = F.col("event_id")
        ev = self.raw("events").filter(F.col("event_type") == "purchase")
        n = self.n_orders()
        return ev.select(
            e.alias("intervention_id"),
            ((F.expr("event_id div 5") * 11) % n).alias("order_id"),
            F.col("ts").cast("timestamp").alias("intervention_at"),
            F.when(e % 37 != 0, _pick(e % 3, ["PRIORITY_DISPATCH", "DRIVER_REASSIGNMENT", "VOUCHER"]))
            .alias("intervention_type"),
            F.lit("ops").alias("initiated_by"),
            F.concat(F.lit("risk_"), (e % 4).cast("string")).alias("reason"))

    @cached_property
    def dispatch_pages(self) -> DataFrame:
        """Landed API pages: envelope {page, page_size, total_records,
        has_more, data[]}; 50 records per page, so each group is bounded."""
        ev = self.raw("events")
        total = ev.agg(F.count(F.lit(1))).scalar()
        last_page = ev.agg(F.max(F.expr("event_id div 50"))).scalar()
        rec = F.struct(
            F.col("event_id").alias("record_id"), F.col("user_id").alias("driver_id"),
            F.col("event_type").alias("dispatch_status"), fmt_ts(F.col("ts")).alias("assigned_at"))
        return (ev.groupBy(F.expr("event_id div 50").alias("page"))
                .agg(F.collect_list(rec).alias("data"))
                .select("page", F.lit(50).alias("page_size"), total.alias("total_records"),
                        (F.col("page") < last_page).alias("has_more"), "data"))

    @cached_property
    def driver_documents(self) -> DataFrame:
        """Nested driver documents {driver_id, events[]}; one document per
        driver and block of 64 event ids, so no document grows with a hot driver."""
        ev = self.raw("events")
        rec = F.struct(F.col("event_type").alias("type"), F.col("event_id"),
                       F.col("ts").cast("timestamp").alias("ts"), F.col("value"))
        return (ev.groupBy(F.col("user_id").alias("driver_id"), F.expr("event_id div 64").alias("block"))
                .agg(F.collect_list(rec).alias("events")))
