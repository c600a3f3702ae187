"""The batch pipeline: bronze -> silver (+ quarantine) -> gold, with the
completeness proof, the circuit breaker and a run manifest.

Each layer is written to storage and the next layer reads it back, which
cuts the lineage at every layer boundary: a lost executor re-runs at most
one layer's tasks, never the whole chain. Only one-row summaries (the
manifest values) ever reach the driver.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.functions import combine_one_row
from opslake.operators import calibrate as C
from opslake.operators import contracts as K
from opslake.operators import lifecycle as L
from opslake.operators import marts as M
from opslake.operators import proofs as P
from opslake.sources import landing as S

PIPELINE_VERSION = "1.0.0"


def breaker_summary(silver: C.Silver, threshold_pct: float = K.BREAKER_THRESHOLD_PCT) -> DataFrame:
    """One row: quarantine rate, breaker warning and run status."""
    return K.circuit_breaker(C.quarantine_rate(silver), threshold_pct).select(
        "quarantine_rate_pct", "quarantine_trip_warning", "status")


def fact_summary(fact: DataFrame, kpi: DataFrame) -> DataFrame:
    """One row: completed / cancelled counts, the modal bottleneck and the
    headline KPI values."""
    counts = fact.agg(F.count_if("is_completed").alias("completed_orders"),
                      F.count_if(~F.col("is_completed")).alias("cancelled_orders"))
    mode = (L.bottleneck_distribution(fact).filter("is_mode")
            .select(F.col("primary_delay_bottleneck").alias("primary_bottleneck")))
    k = kpi.select("p50_otd_min", "p90_otd_min", "sla_breach_rate_pct")
    return combine_one_row(counts, mode, k)


def run_summary(silver: C.Silver, fact: DataFrame, kpi: DataFrame, gate: DataFrame,
                threshold_pct: float = K.BREAKER_THRESHOLD_PCT) -> DataFrame:
    """One row with the values the run manifest records."""
    return combine_one_row(gate.select("completeness_verified"), breaker_summary(silver, threshold_pct),
                           fact_summary(fact, kpi))


@dataclass
class Sources:
    orders: DataFrame
    merchants: DataFrame
    line_items: DataFrame
    headers: DataFrame
    kds: DataFrame
    dispatch: DataFrame
    tickets: DataFrame
    #: SHA-256 of the landed file of a bronze table, by its name
    checksums: dict = field(default_factory=dict)


@dataclass
class RunResult:
    manifest: dict
    paths: dict = field(default_factory=dict)


def run_pipeline(spark: SparkSession, src: Sources, out_dir: str, batch_date: str,
                 run_id: str | None = None, threshold_pct: float = K.BREAKER_THRESHOLD_PCT,
                 halt_on_breaker: bool = False, distributed_quantiles: bool | None = None) -> RunResult:
    """Land, validate, model and publish one batch.

    ``distributed_quantiles=False`` computes the KPI and cluster quantiles with
    one value map per group (same values; for domains known to be small).

    Layer tables are partitioned by ``batch_date``; re-running a batch replaces
    exactly that batch's folders, also where a table has no rows any more. A
    run that raises leaves a manifest with status FAILED and the error.
    """
    started = time.time()
    run_id = run_id or f"RUN-{batch_date}"
    side = ThreadPoolExecutor(max_workers=2)
    held: list[C.Silver] = []  # with persisted frames
    try:
        return _run(spark, src, out_dir, batch_date, run_id, threshold_pct, halt_on_breaker, distributed_quantiles,
                    started, side, held)
    except Exception as e:
        failed = {"run_id": run_id, "pipeline_version": PIPELINE_VERSION, "batch_date": batch_date, "status": "FAILED",
                  "errors": [f"{type(e).__name__}: {e}"[:2000]], "duration_seconds": round(time.time() - started, 2)}
        S.write_manifest(S.manifest_frame(spark, failed), os.path.join(out_dir, "run_manifest"))
        raise
    finally:
        side.shutdown()
        for s in held:
            s.release()


def _run(spark, src, out_dir, batch_date, run_id, threshold_pct, halt_on_breaker, distributed_quantiles,
         started, side, held) -> RunResult:
    ingested_at = f"{batch_date}T00:00:00Z"
    p = {layer: os.path.join(out_dir, layer) for layer in ("bronze", "silver", "quarantine", "gold")}

    def path(layer, name):
        return os.path.join(p[layer], name)

    def put(df, layer, name):
        if callable(df):  # a builder that runs jobs of its own (e.g. a checkpoint)
            df = df()
        return S.replace_partition(df, path(layer, name), "batch_date", batch_date)

    def put_all(jobs):
        """Write independent tables of one layer concurrently (each is its own
        Spark job; small jobs then share the executors instead of queueing)."""
        with ThreadPoolExecutor(max_workers=min(len(jobs), 4)) as ex:
            futs = [ex.submit(put, df, layer, name) for df, layer, name in jobs]
            return [f.result() for f in futs]

    # ---- bronze ---------------------------------------------------------------
    seen = {}  # the sources' row counts, observed while bronze is written

    def stamped(name, df, source_type):
        rows, seen[name] = S.counted(S.bronze_stamp(
            df, batch_id=f"BATCH-{batch_date}", ingested_at=ingested_at, source_type=source_type,
            raw_checksum=src.checksums.get(name)), f"bronze {name}")
        return rows, "bronze", name

    orders, merchants, lines, headers, dispatch, kds, tickets = put_all([
        stamped("orders", src.orders, S.SOURCE_SQL),
        stamped("merchants", src.merchants, S.SOURCE_SQL),
        stamped("order_line_items", src.line_items, S.SOURCE_SQL),
        stamped("order_headers", src.headers, S.SOURCE_SQL),
        stamped("dispatch_attempts", src.dispatch, S.SOURCE_API),
        stamped("kds_logs", src.kds, S.SOURCE_CSV),
        stamped("support_tickets", src.tickets, S.SOURCE_JSON),
    ])
    kinds = {"orders": S.SOURCE_SQL, "merchants": S.SOURCE_SQL, "order_line_items": S.SOURCE_SQL, "order_headers": S.SOURCE_SQL,
             "dispatch_attempts": S.SOURCE_API, "kds_logs": S.SOURCE_CSV, "support_tickets": S.SOURCE_JSON}

    pk = P.pk_integrity([("orders", orders, "order_id"), ("order_line_items", lines, "line_item_id"),
                         ("dispatch_attempts", dispatch, "dispatch_id"), ("kds_logs", kds, "kds_ticket_id")])
    recon = P.reconcile_global(headers, lines)
    gate = P.completeness_gate(pk, recon)
    # the proof is recorded, not a precondition of silver: its one-row job
    # runs beside the silver and gold jobs instead of blocking them
    proof_job = side.submit(lambda: combine_one_row(gate, P.control_totals(headers)).first().asDict())

    # ---- silver + quarantine ------------------------------------------------------
    s = C.validate_and_calibrate(orders, kds, dispatch, quarantined_at=ingested_at)
    held.append(s)
    dlq = put(s.dlq, "quarantine", "quarantine_audit")
    s_orders, s_kds, s_disp, _, detected = put_all([
        (C.remove_quarantined(orders, dlq), "silver", "silver_orders"),
        (C.remove_quarantined(s.kitchen.drop("_dlq"), dlq), "silver", "silver_kds_calibrated"),
        (C.remove_quarantined(s.jittered.drop("_dlq"), dlq), "silver", "silver_dispatch_terminal"),
        (s.churn, "silver", "fact_dispatch_churn"),
        (C.detections(s), "silver", "calibration_detections"),
        (merchants, "silver", "silver_merchants"),
        (tickets, "silver", "silver_support_tickets"),
        (C.source_profile(orders, kds, dispatch), "silver", "source_profile"),
    ])[:5]
    s.release()
    stored = C.Silver(orders=s_orders, kds=s_kds, dispatch=s_disp, churn=s.churn, dlq=dlq,
                      jittered=s.jittered, kitchen=s.kitchen)
    breaker = K.circuit_breaker(C.quarantine_rate(stored), threshold_pct, halt_on_breaker)
    if halt_on_breaker:
        K.raise_if_tripped(breaker)
    # the silver part of the manifest needs only the stored silver tables:
    # its one-row job runs beside the fact and gold writes
    silver_job = side.submit(lambda: combine_one_row(
        breaker_summary(stored, threshold_pct), C.calibration_audit(stored, detected.drop("batch_date"))).first().asDict())

    # ---- model + gold ---------------------------------------------------------------
    fact = put(L.build_fact(s_orders, merchants, s_kds, s_disp, tickets), "silver", "fact_order_lifecycle")
    kpi, _, scen = put_all([
        (lambda: M.kpi_summary(fact, distributed=distributed_quantiles), "gold", "kpi_summary_daily"),
        (lambda: M.kpi_by_cluster(fact, distributed=distributed_quantiles), "gold", "kpi_cluster_performance"),
        (lambda: M.scenario_evaluation(fact), "gold", "kpi_intervention_simulation"),
    ])

    staged = M.scenario_lookup(scen, "Staged Offset").select(F.col("p90_otd_min").alias("staged_dispatch_p90_sim_min"))
    gold_row = combine_one_row(fact_summary(fact, kpi), staged).first().asDict()
    proof, silver_row = proof_job.result(), silver_job.result()
    put(M.evidence_table(kpi), "gold", "evidence_table")
    # the gate's verdict is already known from the proof: no rescan of bronze
    row = {"completeness_verified": bool(proof["completeness_verified"]), **silver_row, **gold_row}
    manifest = {
        "run_id": run_id, "pipeline_version": PIPELINE_VERSION, "batch_date": batch_date,
        "status": row["status"], "quarantine_trip_warning": bool(row["quarantine_trip_warning"]),
        "completeness": {k: proof[k] for k in proof},
        "sources": {name: {"rows": seen[name].get["rows"], "retrieval": kind, "sha256": src.checksums.get(name)}
                    for name, kind in kinds.items()},
        "errors": [] if not row["quarantine_trip_warning"] else [
            f"quarantine rate {row['quarantine_rate_pct']} % is over the limit of {threshold_pct} %"],
        "summary": row, "duration_seconds": round(time.time() - started, 2),
    }
    S.write_manifest(S.manifest_frame(spark, manifest), os.path.join(out_dir, "run_manifest"))
    return RunResult(manifest=manifest, paths=p)

