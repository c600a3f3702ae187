"""Incremental bronze landing with Structured Streaming.

Source extracts (JSON documents, CSV exports, API pages) arrive as files in
a landing folder. ``land_stream`` picks up every new file once, stamps the
rows with the micro-batch's audit columns and appends them to the bronze
table, partitioned by batch id. Exactly-once comes from the checkpoint (the
file source records which files each epoch read) plus an idempotent sink:
a replayed epoch overwrites its own ``_batch_id`` partition with the same
source rows (only ``_ingested_at`` carries the replay's time). A per-epoch
row-count proof is written beside the data.

``availableNow`` processes what is there and stops, so the same code runs
as a scheduled batch or as a continuously running stream.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    opts = {"multiLine": "true"} if fmt == "json" else {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return r.options(**opts).load(path)


def land_stream(spark: SparkSession, src_dir: str, schema: StructType | str, sink_dir: str,
                source_type: str, batch_prefix: str, fmt: str = "json", options: dict | None = None,
                checkpoint_location: str | None = None, available_now: bool = True,
                processing_time: str | None = None):
    """Start the landing stream; returns the StreamingQuery.

    The checkpoint defaults to ``<spark.checkpoint.dir>/land/<sink name>``:
    the shared folder the cluster names, never a machine-local one.
    """
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), "land", os.path.basename(sink_dir.rstrip("/")))
    proof_dir = sink_dir.rstrip("/") + "_proof"
    stream = read_stream(spark, src_dir, schema, fmt, options).withColumn("_source_file", F.col("_metadata.file_path"))

    def write_batch(df: DataFrame, epoch_id: int) -> None:
        batch_id = f"{batch_prefix}-{epoch_id:08d}"
        stamped = df.withColumns({
            "_ingested_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "_batch_id": F.lit(batch_id),
            "_source_type": F.lit(source_type),
        })
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch_id").parquet(sink_dir))
        proof = (spark.read.parquet(sink_dir).filter(F.col("_batch_id") == batch_id)
                 .groupBy("_batch_id", "_source_file").agg(F.count(F.lit(1)).alias("landed_rows")))
        proof.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("_batch_id").parquet(proof_dir)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
