"""Sources and sinks: readers with declared schemas, audit stamps,
checksums, page / document flattening, raw-zone copies and layer writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ---- fixed values ----------------------------------------------------------------
SOURCE_SQL = "SQL_RDBMS"
SOURCE_API = "REST_API_STREAM"
SOURCE_CSV = "CSV_DAILY_EXPORT"
SOURCE_JSON = "JSON_DOC_STORE"
PAGE_SCHEMA = ("page long, page_size long, has_more boolean, total_records long, "
               "data array<struct<order_id:string, driver_id:string, original_driver_id:string, "
               "assigned_at:string, reassigned_at:string, estimated_pickup_at:string, "
               "current_delivery_eta:string, dispatch_status:string, eta_model_version:string>>")
BLOCK_BYTES = 1 << 20  # read and hashed at a time
AUDIT_COLUMNS = ["_ingested_at", "_batch_id", "_source_type", "_raw_checksum"]


# ---- S1 / S2 -----------------------------------------------------------------------
def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
              properties: dict | None = None) -> DataFrame:
    """Full-table extract, split into ``num_partitions`` range reads on a
    numeric key so the extract is parallel (needs the JDBC driver jar)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The catalog's tables as a DataFrame."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, table_type string, is_temporary boolean")


# ---- S3 ----------------------------------------------------------------------------
def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """S3: deterministic preview (top-n by key, no full sort)."""
    return df.orderBy(key).limit(n)


# ---- S4 / S5 / S7 ------------------------------------------------------------------
def read_json_array(spark: SparkSession, path: str, schema: StructType | str,
                    corrupt_column: str | None = None) -> DataFrame:
    """JSON array-of-objects documents -> rows, with a declared schema.
    A multi-line document is not splittable, so each file is one task: land
    large extracts as many files (or as JSON Lines, read without multiLine)."""
    r = spark.read.schema(schema).option("multiLine", True)
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    else:
        r = r.option("mode", "FAILFAST")
    return r.json(path)


def read_pages(spark: SparkSession, path: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    """Landed API pages (one JSON envelope per file)."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def flatten_pages(pages: DataFrame, data_col: str = "data") -> DataFrame:
    """Envelope {page, ..., data[]} -> one row per record (+ page)."""
    return pages.select("page", F.explode(data_col).alias("r")).select("page", "r.*")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, timestamp_format: str | None = None,
             corrupt_column: str | None = None) -> DataFrame:
    """Header CSV with a declared schema (no inference)."""
    r = spark.read.schema(schema).option("header", True)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    else:
        r = r.option("mode", "FAILFAST")
    return r.csv(path)


# ---- S9 ----------------------------------------------------------------------------
def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet layer write. With partition columns the overwrite is
    dynamic: only the partitions present in ``df`` are replaced, so a
    re-run of one batch date is idempotent and leaves other dates alone."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _store(spark: SparkSession, path: str):
    """(Hadoop filesystem, function to its paths) for a layer folder."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _move(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> DataFrame:
    """One partition of a layer table replaced by ``df`` and read back with
    its schema. Content without rows replaces what was there too.

    The rows are written beside the table, under ``_staging`` (readers skip such
    names), so a run that dies while it writes leaves the old partition as it
    is. Then two renames publish them: the old folder goes to ``_replaced``, the
    new one takes its place. A run that dies between the two leaves the old rows
    in ``_replaced``: ``read_partition`` follows them there, and the next
    replacement puts them back first. They stay until that replacement, for readers
    that began before it.
    """
    import re
    if not re.fullmatch(r"[A-Za-z0-9._-]+", value):
        raise ValueError(f"not a partition value: {value!r}")
    spark, name = df.sparkSession, f"{column}={value}"
    store, at = _store(spark, path)
    place, staging, replaced = (at(f"{path}/{x}") for x in (name, f"_staging/{name}", f"_replaced/{name}"))
    if not store.exists(place) and store.exists(replaced):
        _move(store, replaced, place)
    store.delete(staging, True)
    df.write.mode("overwrite").parquet(f"{path}/_staging/{name}")
    store.delete(replaced, True)
    if store.exists(place):
        store.mkdirs(replaced.getParent())
        _move(store, place, replaced)
    _move(store, staging, place)
    return spark.read.schema(df.schema).parquet(f"{path}/{name}")


def read_partition(spark: SparkSession, path: str, column: str, value: str, schema: StructType | str | None = None) -> DataFrame:
    """The published rows of a partition, also where a run died while it published new ones."""
    store, at = _store(spark, path)
    place = f"{path}/{column}={value}"
    if not store.exists(at(place)):
        place = f"{path}/_replaced/{column}={value}"
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(place)


# ---- C9 at the source ---------------------------------------------------------------
def with_landing_sequence(df: DataFrame, column: str = "_landed") -> DataFrame:
    """The rows of a file scan with their place in landing order, a long: files by
    path, rows as they stand in the file. ``df`` is a scan (it may be filtered or
    projected).

    Files are numbered in a table of one row for each file, or for each split where
    the format does not number its rows; the number and the row's position make
    the sequence. That table is broadcast, whatever the planner thinks of its size: dealt
    by file, all rows of a file would go through one task.
    """
    try:
        df.select("_metadata.row_index")
        part, position, bits = ["_file"], F.col("_metadata.row_index"), 40
    except Exception:  # noqa: BLE001 - text formats do not number rows: the position inside the split
        part, position, bits = ["_file", "_block"], F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)), 33
    where = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    rows = df.select("*", *[where[p].alias(p) for p in part], position.alias("_position"))
    order = F.row_number().over(Window.orderBy(*part))
    files = df.select(*[where[p].alias(p) for p in part]).distinct().withColumn("_number", order)
    sequence = F.shiftleft(F.col("_number").cast("long"), bits) + F.col("_position")
    return rows.join(F.broadcast(files), part).withColumn(column, sequence).drop("_number", "_position", *part)


# ---- S10 / S11 -----------------------------------------------------------------------
def bronze_stamp(df: DataFrame, batch_id: str, ingested_at: str, source_type: str,
                 raw_checksum: str | None = None, with_file: bool = False) -> DataFrame:
    """Audit stamp columns. Clock values are parameters, so re-running
    a batch gives identical rows. Rows that carry the checksum of their file
    keep it. ``with_file`` adds the source file path from the scan's hidden
    ``_metadata`` column."""
    checksum = F.lit(raw_checksum).cast("string")
    if "_raw_checksum" in df.columns:
        checksum = F.coalesce(F.col("_raw_checksum"), checksum)
    out = df.withColumns({
        "_ingested_at": F.lit(ingested_at),
        "_batch_id": F.lit(batch_id),
        "_source_type": F.lit(source_type),
        "_raw_checksum": checksum,
    })
    if with_file:
        out = out.withColumn("_source_file", F.col("_metadata.file_path"))
    return out


def _open(path: str):
    """(filesystem, path) of a landed file, for reading in a task."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the landed files, those without bytes included; no byte of a
    file is read. The driver lists what ``path`` (a folder, file or pattern) holds
    directly; each folder in it is listed to its depth by a task. Names
    beginning with ``_`` or ``.`` are left out. Files are dealt out one by one, so that
    they are hashed beside each other."""
    store, at = _store(spark, path)
    top = []
    for found in store.globStatus(at(path)) or []:
        for status in store.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if status.getPath().getName()[0] not in "_.":
                top.append((status.getPath().toString(), -1 if status.isDirectory() else status.getLen()))
    if not top:
        raise FileNotFoundError(f"nothing has landed in {path}")

    def deepen(batches):
        import pyarrow as pa
        from pyarrow import fs
        for batch in batches:
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [(name, length)]
                if length < 0:
                    files, base = _open(name)
                    inside = files.get_file_info(fs.FileSelector(base, recursive=True))
                    below = [(i.path[len(base):].lstrip("/"), i.size) for i in inside if i.type == fs.FileType.File]
                    found = [(f"{name}/{p}", size) for p, size in below if all(x[0] not in "_." for x in p.split("/"))]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()),
                                                  pa.array([n for _, n in found], pa.int64())], ["path", "length"])

    many = spark.sparkContext.defaultParallelism
    listed = spark.createDataFrame(top, "path string, length long").repartition(min(many, len(top)))
    return listed.mapInArrow(deepen, "path string, length long").repartition(many)


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every landed file, of any size, computed in the
    executors from blocks of BLOCK_BYTES."""

    def run(batches):
        import hashlib

        import pyarrow as pa
        for batch in batches:
            sums = []
            for name in batch.column(0).to_pylist():
                store, at = _open(name)
                h = hashlib.sha256()
                with store.open_input_stream(at) as f:
                    while block := f.read(BLOCK_BYTES):
                        h.update(block)
                sums.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], ["path", "length", "sha256"])

    return _listing(spark, path).mapInArrow(run, "path string, length long, sha256 string")


def row_checksum(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per-row SHA-256 over the columns' texts, each with its length before it
    (``4:text``; a missing value is ``-``), so that no two rows share a text."""
    cols = cols or df.columns
    values = [F.col(c).cast("string") for c in cols]
    text = F.concat(*[F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values])
    return df.withColumn("row_sha256", F.sha2(text, 256))


def content_checksum(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-insensitive checksum of a whole table: row count plus the sum
    of the first 60 bits of every row hash (exact decimal sum)."""
    h = row_checksum(df, cols).select(F.conv(F.substring("row_sha256", 1, 15), 16, 10)
                                      .cast("decimal(38,0)").alias("h"))
    return h.agg(F.count(F.lit(1)).alias("row_count"), F.sum("h").alias("content_sum"))


def land_raw_files(spark: SparkSession, src: str, raw_dir: str) -> DataFrame:
    """Preserve landed files unchanged, as files, before anything parses
    them: copied block by block in the executors to ``raw_dir/files`` and
    hashed on the way. A copy is written under a name of its task and renamed when it
    is whole, so a task that runs twice at once harms nothing. ``raw_dir/manifest`` (path, length, sha256, raw_path) is
    written last; where it exists the copy is refused, so a raw zone is never
    overwritten. Parsers read ``raw_dir/files``."""
    target = raw_dir.rstrip("/") + "/files"

    def run(batches):
        import hashlib
        import uuid

        import pyarrow as pa
        for batch in batches:
            sums, places = [], []
            for name in batch.column(0).to_pylist():
                store, at = _open(name)
                out, base = _open(target)
                out.create_dir(base, recursive=True)
                # a name of its own for each source path; a retried task writes the same bytes again
                place = f"{hashlib.sha256(name.encode()).hexdigest()[:16]}-{name.rsplit('/', 1)[-1]}"
                mine = f"{base}/.{uuid.uuid4().hex}"
                h = hashlib.sha256()
                with store.open_input_stream(at) as f, out.open_output_stream(mine) as g:
                    while block := f.read(BLOCK_BYTES):
                        h.update(block)
                        g.write(block)
                out.move(mine, f"{base}/{place}")
                sums.append(h.hexdigest())
                places.append(f"{target}/{place}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string()), pa.array(places, pa.string())],
                                             ["path", "length", "sha256", "raw_path"])

    manifest = raw_dir.rstrip("/") + "/manifest"
    rows = _listing(spark, src).mapInArrow(run, "path string, length long, sha256 string, raw_path string")
    rows.write.mode("errorifexists").parquet(manifest)
    return spark.read.parquet(manifest)


# ---- S12 ---------------------------------------------------------------------------
def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with an observation that has its row count (``rows``) once one
    action on it is done: rows are counted while they are written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def manifest_frame(spark: SparkSession, values: dict) -> DataFrame:
    """A one-row manifest from driver-side scalars (never data rows)."""
    import json
    return spark.createDataFrame([(json.dumps(values, sort_keys=True, default=str),)], "manifest string") \
        .select(F.from_json("manifest", "map<string,string>").alias("m"), "manifest")


def write_manifest(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
