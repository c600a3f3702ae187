"""Readers, stamps, checksums, raw copies, layer writes, streaming landing,
and the end-to-end pipeline on the smallest driver tables."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from opslake.sources import landing as S

TICKET_SCHEMA = ("ticket_id string, order_id string, created_at string, issue_category string, "
                 "compensation_amount_cents long, csat_score int")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_json_array_document(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "tickets", "t.json")
    _write(p, json.dumps([
        {"ticket_id": "T1", "order_id": "O1", "created_at": "2024-01-01T10:00:00Z", "issue_category": "late",
         "compensation_amount_cents": 500, "csat_score": 2},
        {"ticket_id": "T2", "order_id": None, "created_at": "not a time", "issue_category": "eta",
         "compensation_amount_cents": 0, "csat_score": 4}]))
    df = S.read_json_array(spark, p, TICKET_SCHEMA)
    assert df.count() == 2
    from opslake.operators.calibrate import parse_timestamps
    parsed = {r.ticket_id: r.created_at for r in parse_timestamps(df, ["created_at"]).collect()}
    assert parsed["T2"] is None and parsed["T1"].hour == 10


def test_api_pages_flatten_and_completeness(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "pages")
    for page, recs, more in [(1, ["A", "B"], True), (2, ["C"], False)]:
        _write(os.path.join(d, f"page_{page:03d}.json"), json.dumps({
            "data": [{"order_id": r, "driver_id": "D1", "original_driver_id": "D1", "assigned_at": "2024-01-01",
                      "reassigned_at": None, "estimated_pickup_at": None, "current_delivery_eta": None,
                      "dispatch_status": "ASSIGNED", "eta_model_version": "v1"} for r in recs],
            "page": page, "page_size": 2, "has_more": more, "total_records": 3}))
    pages = S.read_pages(spark, d)
    flat = S.flatten_pages(pages)
    assert sorted(r.order_id for r in flat.collect()) == ["A", "B", "C"]
    from opslake.operators.proofs import page_completeness
    r = page_completeness(pages).first()
    assert r.complete and r.records_retrieved == 3
    # raw copy is kept unchanged and is never overwritten
    raw = S.land_raw_files(spark, d, os.path.join(tmpdir_fresh, "raw_zone"))
    expected = hashlib.sha256(open(os.path.join(d, "page_001.json"), "rb").read()).hexdigest()
    assert expected in [x.sha256 for x in raw.collect()]
    with pytest.raises(Exception):
        S.land_raw_files(spark, d, os.path.join(tmpdir_fresh, "raw_zone"))


def test_csv_with_schema_and_malformed_timestamp(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "kds.csv")
    _write(p, "kds_ticket_id,order_id,ticket_printed_at,active_kitchen_queue_depth\n"
              "K1,O1,2024-01-01 10:00:00,3\nK2,O2,garbage,4\n")
    df = S.read_csv(spark, p, "kds_ticket_id string, order_id string, ticket_printed_at string, "
                              "active_kitchen_queue_depth int")
    from opslake.functions import parse_ts
    got = {r.kds_ticket_id: r.t for r in df.select("kds_ticket_id", parse_ts("ticket_printed_at").alias("t")).collect()}
    assert got["K2"] is None and got["K1"] is not None


def test_checksums_match_hashlib(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "files", "a.bin")
    payload = os.urandom(200_000)
    os.makedirs(os.path.dirname(p))
    open(p, "wb").write(payload)
    r = S.file_checksums(spark, os.path.dirname(p)).first()
    assert r.sha256 == hashlib.sha256(payload).hexdigest() and r.length == len(payload)
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    rows = {x.id: x.row_sha256 for x in S.row_checksum(df).collect()}
    assert rows[1] == hashlib.sha256(b"1:11:a").hexdigest() and rows[2] == hashlib.sha256(b"1:2-").hexdigest()
    c1 = S.content_checksum(df).first()
    c2 = S.content_checksum(df.orderBy(F.desc("id"))).first()
    assert c1 == c2


def test_files_of_several_blocks_are_hashed_and_kept_whole(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 64)
    d, raw = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "raw")
    texts = {"a b.txt": "x" * 1000, "c.json": json.dumps({"k": "\u00e9" * 300})}
    for name, text in texts.items():
        _write(os.path.join(d, name), text)
    want = {name: hashlib.sha256(text.encode()).hexdigest() for name, text in texts.items()}
    got = {os.path.basename(r.path).replace("%20", " "): r for r in S.file_checksums(spark, d).collect()}
    assert {n: r.sha256 for n, r in got.items()} == want and got["a b.txt"].length == 1000
    kept = S.land_raw_files(spark, d, raw).collect()
    assert sorted(r.sha256 for r in kept) == sorted(want.values())
    for r in kept:
        with open(r.raw_path, "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == r.sha256
    with pytest.raises(Exception):
        S.land_raw_files(spark, d, raw)


def test_stamps_and_dynamic_overwrite(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    st = S.bronze_stamp(df, "B1", "2024-01-01T00:00:00Z", S.SOURCE_CSV, "abc")
    assert st.columns[-4:] == S.AUDIT_COLUMNS
    out = os.path.join(tmpdir_fresh, "layer")
    S.write_layer(st.withColumn("batch_date", F.lit("d1")), out, ["batch_date"])
    S.write_layer(st.withColumn("batch_date", F.lit("d2")), out, ["batch_date"])
    S.write_layer(st.limit(1).withColumn("batch_date", F.lit("d1")), out, ["batch_date"])
    counts = {r.batch_date: r["count"] for r in spark.read.parquet(out).groupBy("batch_date").count().collect()}
    assert counts == {"d1": 1, "d2": 2}  # re-running d1 replaced only d1
    spark.range(3).createOrReplaceTempView("opslake_probe")
    assert "opslake_probe" in [r.name for r in S.list_tables(spark).collect()]
    assert [r.id for r in S.preview(spark.range(10), "id", 3).collect()] == [0, 1, 2]


def test_streaming_landing_exactly_once(spark, tmpdir_fresh):
    from opslake.streaming.landing import land_stream
    src, sink = os.path.join(tmpdir_fresh, "incoming"), os.path.join(tmpdir_fresh, "bronze_tickets")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    rec = {"ticket_id": "T1", "order_id": "O1", "created_at": "2024-01-01T10:00:00Z", "issue_category": "late",
           "compensation_amount_cents": 1, "csat_score": 3}
    _write(os.path.join(src, "f1.json"), json.dumps([rec, dict(rec, ticket_id="T2")]))
    q = land_stream(spark, src, TICKET_SCHEMA, sink, S.SOURCE_JSON, "STREAM", checkpoint_location=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    _write(os.path.join(src, "f2.json"), json.dumps([dict(rec, ticket_id="T3")]))
    land_stream(spark, src, TICKET_SCHEMA, sink, S.SOURCE_JSON, "STREAM", checkpoint_location=ckpt).awaitTermination()
    landed = spark.read.parquet(sink)
    assert sorted(r.ticket_id for r in landed.collect()) == ["T1", "T2", "T3"]  # f1 not read again
    proof = spark.read.parquet(sink + "_proof")
    assert proof.agg(F.sum("landed_rows")).first()[0] == 3
    assert landed.select("_batch_id").distinct().count() == 2


@pytest.fixture(scope="module")
def pipeline_run(spark):
    import tempfile
    from fixtures.views import DriverTables
    from opslake.plans.pipeline import Sources, run_pipeline
    t = DriverTables(spark, "/root/testdata/sf0.001")
    src = Sources(orders=t.orders, merchants=t.merchants, line_items=t.lines.select(
        "line_item_id", "order_id", "quantity", "unit_price_cents"), headers=t.headers, kds=t.kds_logs,
        dispatch=t.dispatch_attempts, tickets=t.support_tickets)
    out = tempfile.mkdtemp(prefix="opslake-pipe-")
    r1 = run_pipeline(spark, src, out, "2024-01-01")
    # the rerun uses one value map per group for its quantiles: same manifest expected
    r2 = run_pipeline(spark, src, out, "2024-01-01", distributed_quantiles=False)
    return spark, t, out, r1, r2


def test_pipeline_invariants(pipeline_run):
    spark, t, out, r1, r2 = pipeline_run
    m = r1.manifest
    assert m["status"] == "SUCCESS_WITH_WARNINGS" and m["quarantine_trip_warning"]  # fixture DLQ rate > 5 %
    s = m["summary"]
    assert s["p90_otd_min"] > s["p50_otd_min"]
    silver = os.path.join(out, "silver")
    fact = spark.read.parquet(os.path.join(silver, "fact_order_lifecycle"))
    done = fact.filter("is_completed")
    for c in ("stage1_merchant_lag_min", "rider_store_wait_min", "stage5_last_mile_min"):
        assert done.filter(F.col(c) < 0).count() == 0
    assert done.filter("total_otd_min <= 0").count() == 0
    # grain: one fact row per clean order; clean + distinct quarantined = input orders
    clean = spark.read.parquet(os.path.join(silver, "silver_orders")).count()
    dlq = spark.read.parquet(os.path.join(out, "quarantine", "quarantine_audit"))
    assert fact.count() == clean
    assert clean + dlq.select("entity_id").distinct().count() == t.orders.count()
    gold = os.path.join(out, "gold")
    assert spark.read.parquet(os.path.join(gold, "kpi_summary_daily")).count() == 1
    assert spark.read.parquet(os.path.join(gold, "kpi_cluster_performance")).count() == 5
    assert spark.read.parquet(os.path.join(gold, "kpi_intervention_simulation")).count() == 4
    # breaker that only warns vs a 50 % threshold that does not trip
    assert s["quarantine_rate_pct"] < 50.0


def test_pipeline_is_idempotent(pipeline_run):
    spark, t, out, r1, r2 = pipeline_run
    from opslake.operators.proofs import output_fingerprint
    fact = spark.read.parquet(os.path.join(out, "silver", "fact_order_lifecycle"))
    assert fact.count() == r1.manifest["summary"]["completed_orders"] + r1.manifest["summary"]["cancelled_orders"]
    assert r1.manifest["summary"] == r2.manifest["summary"]
    assert r1.manifest["completeness"] == r2.manifest["completeness"]
    # stored output fingerprint equals the fingerprint of a fresh recomputation
    from fixtures.catalog import Ctx
    fresh = Ctx(spark, "/root/testdata/sf0.001").fact
    cols = ["order_id", "total_otd_min", "primary_delay_bottleneck"]
    assert output_fingerprint(fact.select(*cols)).first() == output_fingerprint(fresh.select(*cols)).first()


def test_halt_on_breaker(spark):
    import tempfile
    from fixtures.views import DriverTables
    from opslake.plans.pipeline import Sources, run_pipeline
    t = DriverTables(spark, "/root/testdata/sf0.001")
    src = Sources(orders=t.orders, merchants=t.merchants, line_items=t.lines.select(
        "line_item_id", "order_id", "quantity", "unit_price_cents"), headers=t.headers, kds=t.kds_logs,
        dispatch=t.dispatch_attempts, tickets=t.support_tickets)
    out = tempfile.mkdtemp(prefix="opslake-halt-")
    with pytest.raises(RuntimeError):
        run_pipeline(spark, src, out, "2024-01-01", halt_on_breaker=True)
    assert not os.path.exists(os.path.join(out, "gold"))  # nothing published


def test_fingerprint_is_order_insensitive_and_typed(spark):
    from opslake.operators.proofs import output_fingerprint
    rows = [(1, 1.5, "a", True), (2, None, None, False), (3, -0.25, "c", None)]
    schema = "k long, x double, s string, b boolean"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(list(reversed(rows)), schema).repartition(3)
    fa, fb = output_fingerprint(a).first(), output_fingerprint(b).first()
    assert fa == fb and fa.row_count == 3
    # a changed value (or a null turned into a value) changes the fingerprint
    c = spark.createDataFrame([(1, 1.5, "a", True), (2, 0.0, None, False), (3, -0.25, "c", None)], schema)
    assert output_fingerprint(c).first().content_hash != fa.content_hash
    # the fast Spark-only variant is order-insensitive as well
    assert output_fingerprint(a, portable=False).first() == output_fingerprint(b, portable=False).first()


def test_checkpoint_dir_is_read_from_the_session_and_never_invented_on_a_cluster():
    from opslake.session import checkpoint_dir

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    class Ctx:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, master, conf):
            self.conf, self.sparkContext = Conf(conf), Ctx(master)

    shared = "hdfs://cluster/checkpoints"
    s = Session("spark://master:7077", {"spark.checkpoint.dir": shared})
    assert checkpoint_dir(s) == shared and s.sparkContext.dir == shared
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session("yarn", {}))
    local = Session("local[2]", {})
    assert checkpoint_dir(local) == local.conf["spark.checkpoint.dir"]


def test_row_checksum_tells_null_empty_and_separators_apart(spark):
    df = spark.createDataFrame([("a|", "b"), ("a", "|b"), (None, "b"), ("", "b"), ("-", "b")], "x string, y string")
    assert S.row_checksum(df).select("row_sha256").distinct().count() == 5


def _small_sources(spark, bad_ready: bool, rejected: bool):
    from opslake.plans.pipeline import Sources
    o = spark.createDataFrame(
        [(i, 1, 7, "COMPLETED", "2024-01-01 10:00:00", "2024-01-01 10:35:00", 500 + i) for i in (1, 2)],
        "order_id long, customer_id long, merchant_id long, order_status string, order_timestamp string, "
        "promised_sla_timestamp string, total_cents long")
    m = spark.createDataFrame([(7, "M", "C", "thai", 4)], "merchant_id long, merchant_name string, cluster_id string, "
                              "cuisine_type string, kitchen_capacity int")
    k = spark.createDataFrame(
        [(10 + i, i, "2024-01-01 10:01:00", "2024-01-01 10:40:00" if bad_ready and i == 2 else "2024-01-01 10:10:00", 3, 600)
         for i in (1, 2)], "kds_ticket_id long, order_id long, ticket_printed_at string, food_ready_at string, "
        "active_kitchen_queue_depth int, estimated_prep_sec int")
    att = [(20 + i, i, 5, 1, "COMPLETED", "2024-01-01 10:02:00", "2024-01-01 10:03:00", "2024-01-01 10:12:00",
            "2024-01-01 10:13:00", "2024-01-01 10:30:00") for i in (1, 2)]
    if rejected:
        att.append((29, 1, 6, 0, "REJECTED", "2024-01-01 10:01:00", None, None, None, None))
    d = spark.createDataFrame(att, "dispatch_id long, order_id long, driver_id long, attempt_number int, dispatch_status string, "
                              "offered_at string, responded_at string, arrived_at_store_at string, picked_up_at string, "
                              "delivered_at string")
    lines = spark.createDataFrame([(1, 1, 1, 500), (2, 2, 1, 500)], "line_item_id long, order_id long, quantity int, "
                                  "unit_price_cents long")
    heads = spark.createDataFrame([(i, 500, 0, 0, 500) for i in (1, 2)], "order_id long, subtotal_cents long, "
                                  "delivery_fee_cents long, tip_cents long, total_amount_cents long")
    t = spark.createDataFrame([(1, 1, 100, 3)], "ticket_id long, order_id long, compensation_amount_cents long, csat_score int")
    return Sources(orders=o, merchants=m, line_items=lines, headers=heads, kds=k, dispatch=d, tickets=t,
                   checksums={"kds_logs": "abc"})


def test_corrected_rerun_empties_the_quarantine(spark, tmpdir_fresh):
    from opslake.plans.pipeline import run_pipeline

    def stored(layer, name):
        return spark.read.parquet(os.path.join(tmpdir_fresh, layer, name))

    run_pipeline(spark, _small_sources(spark, True, True), tmpdir_fresh, "2024-01-01")
    assert stored("quarantine", "quarantine_audit").count() == 1 and stored("silver", "silver_orders").count() == 1
    assert stored("silver", "fact_dispatch_churn").count() == 1
    spark.catalog.clearCache()
    r = run_pipeline(spark, _small_sources(spark, False, False), tmpdir_fresh, "2024-01-01")  # nothing to quarantine or reject
    spark.catalog.refreshByPath(tmpdir_fresh)
    assert stored("quarantine", "quarantine_audit").count() == 0 and stored("silver", "silver_orders").count() == 2
    assert stored("silver", "fact_dispatch_churn").count() == 0
    fact = stored("silver", "fact_order_lifecycle")
    assert {"promised_sla_at", "total_cents", "order_placed_at"} <= set(fact.columns) and fact.count() == 2
    assert r.manifest["sources"]["kds_logs"] == {"rows": 2, "retrieval": S.SOURCE_CSV, "sha256": "abc"}
    assert r.manifest["errors"] == []
    assert {x._raw_checksum for x in stored("bronze", "kds_logs").collect()} == {"abc"}
    for layer, name in (("silver", "silver_merchants"), ("silver", "silver_support_tickets"), ("silver", "source_profile"),
                        ("gold", "evidence_table"), ("bronze", "order_headers")):
        assert stored(layer, name).count() > 0, name


def test_a_run_that_raises_leaves_a_failed_manifest(spark, tmpdir_fresh):
    from opslake.plans.pipeline import run_pipeline
    src = _small_sources(spark, False, False)
    src.kds = src.kds.drop("food_ready_at")
    with pytest.raises(Exception):
        run_pipeline(spark, src, tmpdir_fresh, "2024-01-01")
    m = json.loads(spark.read.json(os.path.join(tmpdir_fresh, "run_manifest")).first()["manifest"])
    assert m["status"] == "FAILED" and m["errors"]


def test_files_to_gold(spark, tmpdir_fresh):
    """Landed CSV, JSON and page files through the raw zone and all layers."""
    from opslake.plans.ingest import CSV, JSON_ARRAY, PAGES, FileSource, ingest_files
    from opslake.plans.pipeline import run_pipeline

    def rows(name, df):
        os.makedirs(os.path.join(tmpdir_fresh, "in", name))
        return [r.asDict() for r in df.collect()], os.path.join(tmpdir_fresh, "in", name), ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def as_csv(name, df, files=1):
        data, at, schema = rows(name, df)
        for i in range(files):
            with open(os.path.join(at, f"part {i}.csv"), "w") as f:
                f.write(",".join(data[0]) + "\n")
                f.writelines(",".join("" if v is None else str(v) for v in r.values()) + "\n" for r in data[i::files])
        return FileSource(at, CSV, schema)

    src = _small_sources(spark, True, True)
    data, at, schema = rows("dispatch_attempts", src.dispatch)
    for page, r in enumerate(data):
        with open(os.path.join(at, f"page{page}.json"), "w") as f:
            json.dump({"page": page, "page_size": 1, "has_more": page + 1 < len(data), "total_records": len(data), "data": [r]}, f)
    inner = ",".join(f"{x.strip().split(' ')[0]}:{x.strip().split(' ')[1]}" for x in schema.split(","))
    pages = FileSource(at, PAGES, f"page long, page_size long, has_more boolean, total_records long, data array<struct<{inner}>>")
    data, at, schema = rows("support_tickets", src.tickets)
    with open(os.path.join(at, "tickets.json"), "w") as f:
        json.dump(data, f)
    files = {"orders": as_csv("orders", src.orders, files=2), "merchants": as_csv("merchants", src.merchants),
             "order_line_items": as_csv("order_line_items", src.line_items),
             "order_headers": as_csv("order_headers", src.headers), "kds_logs": as_csv("kds_logs", src.kds),
             "dispatch_attempts": pages, "support_tickets": FileSource(at, JSON_ARRAY, schema)}
    got = ingest_files(spark, files, os.path.join(tmpdir_fresh, "raw"))
    r = run_pipeline(spark, got, os.path.join(tmpdir_fresh, "a"), "2024-01-01")
    want = run_pipeline(spark, src, os.path.join(tmpdir_fresh, "b"), "2024-01-01")
    assert r.manifest["summary"] == want.manifest["summary"]
    for x in ("orders", "kds_logs", "dispatch_attempts"):
        assert r.manifest["sources"][x]["rows"] == want.manifest["sources"][x]["rows"]
    place = os.path.join(tmpdir_fresh, "in", "kds_logs", "part 0.csv")
    sha = hashlib.sha256(open(place, "rb").read()).hexdigest()
    assert r.manifest["sources"]["kds_logs"]["sha256"] == sha
    bronze = spark.read.parquet(os.path.join(tmpdir_fresh, "a", "bronze", "orders"))
    sums = {hashlib.sha256(open(os.path.join(files["orders"].path, f), "rb").read()).hexdigest()
            for f in os.listdir(files["orders"].path)}
    assert {x._raw_checksum for x in bronze.collect()} == sums and len(sums) == 2


def test_a_replacement_that_dies_leaves_the_old_partition(spark, tmpdir_fresh, monkeypatch):
    table = os.path.join(tmpdir_fresh, "layer")
    old = spark.createDataFrame([(1,), (2,)], "id long")
    S.replace_partition(old, table, "batch_date", "d1")
    S.replace_partition(old.limit(1), table, "batch_date", "d2")

    def ids(df):
        return sorted(r.id for r in df.collect())

    # while it writes: nothing of it is seen
    broken = spark.range(1).select(F.raise_error(F.lit("dies")).cast("long").alias("id"))
    with pytest.raises(Exception):
        S.replace_partition(broken, table, "batch_date", "d1")
    assert ids(spark.read.parquet(table).where("batch_date = 'd1'")) == [1, 2] == ids(S.read_partition(spark, table, "batch_date", "d1"))
    # between taking the old away and putting the new in its place
    move, calls = S._move, []

    def dies_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("killed")
        move(*args)

    new = spark.createDataFrame([(7,)], "id long")
    monkeypatch.setattr(S, "_move", dies_second)
    with pytest.raises(RuntimeError):
        S.replace_partition(new, table, "batch_date", "d1")
    monkeypatch.setattr(S, "_move", move)
    spark.catalog.refreshByPath(table)
    assert ids(S.read_partition(spark, table, "batch_date", "d1")) == [1, 2]
    assert ids(S.replace_partition(new, table, "batch_date", "d1")) == [7]
    spark.catalog.refreshByPath(table)
    rows = {(r.id, r.batch_date) for r in spark.read.parquet(table).collect()}
    assert len(rows) == 2 and (7, "d1") in rows


def test_files_without_bytes_and_folders_are_listed(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "in")
    texts = {"a.csv": "x,y\n1,2\n", "empty.csv": "", "deep/er/b.csv": "z\n", "deep/empty": "", "_skip": "s", "deep/.hid": "h"}
    for name, text in texts.items():
        _write(os.path.join(d, name), text)
    want = {n: hashlib.sha256(t.encode()).hexdigest() for n, t in texts.items() if "_skip" not in n and ".hid" not in n}
    got = {r.path.split("/in/")[1]: (r.length, r.sha256) for r in S.file_checksums(spark, d).collect()}
    assert got == {n: (len(texts[n]), h) for n, h in want.items()}
    kept = S.land_raw_files(spark, d, os.path.join(tmpdir_fresh, "raw")).collect()
    assert sorted(r.sha256 for r in kept) == sorted(want.values())
    for r in kept:
        with open(r.raw_path.replace("file:", ""), "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == r.sha256
    assert {r.path.rsplit("/", 1)[1] for r in S.file_checksums(spark, os.path.join(d, "*.csv")).collect()} == {"a.csv", "empty.csv"}
    with pytest.raises(FileNotFoundError):
        S.file_checksums(spark, os.path.join(d, "nothing*"))


def test_sources_are_counted_while_they_are_written(spark, tmpdir_fresh, monkeypatch):
    from opslake.plans.pipeline import run_pipeline
    r = run_pipeline(spark, _small_sources(spark, True, True), tmpdir_fresh, "2024-01-01")
    for name in ("orders", "merchants", "order_line_items", "order_headers", "dispatch_attempts", "kds_logs", "support_tickets"):
        stored = spark.read.parquet(os.path.join(tmpdir_fresh, "bronze", name)).count()
        assert r.manifest["sources"][name]["rows"] == stored > 0
