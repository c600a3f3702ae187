"""From landed files to the sources of a batch run.

The files of each source are first copied unchanged into the raw zone and hashed
on the way; everything is parsed from that copy, with declared schemas, and each
row carries the checksum of the file it came from. Times stay text here: the
run parses them, and unreadable ones become missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.plans.pipeline import Sources
from opslake.sources import landing as S

CSV, JSON_ARRAY, PAGES = "csv", "json_array", "pages"
NAMES = ["orders", "merchants", "order_line_items", "order_headers", "kds_logs", "dispatch_attempts", "support_tickets"]


@dataclass(frozen=True)
class FileSource:
    """Where a source's files lie, how they are laid out, and the schema of a
    row (of an envelope for pages)."""
    path: str
    layout: str
    schema: str


def read_raw(spark: SparkSession, raw_dir: str, source: FileSource) -> DataFrame:
    """Rows of the raw copy with ``_raw_checksum``, the SHA-256 of their file."""
    r = spark.read.schema(source.schema).option("mode", "FAILFAST")
    place = f"{raw_dir.rstrip('/')}/files"
    rows = (r.option("header", True).csv(place) if source.layout == CSV else r.option("multiLine", True).json(place))
    # a raw file's name begins with a hash of the path it was copied from
    key = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9a-f]{16})-", 1)
    names = [F.col(f"`{c}`") for c in rows.columns]
    rows = rows.select(*names, key.alias("_file"))
    if source.layout == PAGES:
        rows = rows.select(F.explode("data").alias("r"), "_file").select("r.*", "_file")
    sums = spark.read.parquet(f"{raw_dir.rstrip('/')}/manifest").select(
        F.regexp_extract("raw_path", r"/([0-9a-f]{16})-[^/]*$", 1).alias("_file"), F.col("sha256").alias("_raw_checksum"))
    return rows.join(sums, "_file", "left").drop("_file")


def source_checksum(manifest: DataFrame) -> str | None:
    """One checksum for a source: its file's, or for several files the hash of
    the sum of their hashes' first 60 bits, which needs no order among them."""
    h = F.conv(F.substring("sha256", 1, 15), 16, 10).cast("decimal(38,0)")
    one = manifest.agg(F.count(F.lit(1)).alias("files"), F.min("sha256").alias("first"),
                       F.sha2(F.sum(h).cast("string"), 256).alias("all")).first()
    return one["first"] if one["files"] == 1 else one["all"]


def ingest_files(spark: SparkSession, sources: dict[str, FileSource], raw_dir: str) -> Sources:
    """The sources of ``run_pipeline`` from landed files. ``sources``: one entry
    for each of NAMES. ``raw_dir`` is a new folder; a raw zone is never
    overwritten."""
    missing = [n for n in NAMES if n not in sources]
    if missing:
        raise ValueError(f"no files named for: {', '.join(missing)}")
    frames, sums = {}, {}
    for name in NAMES:
        place = f"{raw_dir.rstrip('/')}/{name}"
        sums[name] = source_checksum(S.land_raw_files(spark, sources[name].path, place))
        frames[name] = read_raw(spark, place, sources[name])
    return Sources(orders=frames["orders"], merchants=frames["merchants"], line_items=frames["order_line_items"],
                   headers=frames["order_headers"], kds=frames["kds_logs"], dispatch=frames["dispatch_attempts"],
                   tickets=frames["support_tickets"], checksums=sums)
