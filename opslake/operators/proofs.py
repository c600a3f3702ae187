"""Completeness proofs: row counts, control totals, reconciliation, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslake.functions import combine_one_row


def rowcount_proof(landed: dict[str, DataFrame], source: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows per landed table (and per source when given) in one frame. A
    source is its rows, or one row with the count it announces (``source_rows``)."""
    parts = []
    for name, df in landed.items():
        a = df.agg(F.count(F.lit(1)).alias("landed_rows")).withColumn("source", F.lit(name))
        if source and name in source:
            s = source[name]
            if s.columns != ["source_rows"]:
                s = s.agg(F.count(F.lit(1)).alias("source_rows"))
            a = combine_one_row(a.select("source", "landed_rows"), s)
        else:
            a = a.withColumn("source_rows", F.col("landed_rows"))
        parts.append(a.select("source", "landed_rows", "source_rows"))
    u = reduce(DataFrame.unionByName, parts)
    return u.withColumn("rows_match", F.col("landed_rows") == F.col("source_rows"))


def control_totals(headers: DataFrame) -> DataFrame:
    """Exact sums of long cents."""
    return headers.agg(
        F.sum("subtotal_cents").alias("gmv_subtotal_cents"),
        F.sum("delivery_fee_cents").alias("total_delivery_fee_cents"),
        F.sum("tip_cents").alias("total_tips_cents"),
    ).withColumn("total_gross_captured_cents",
                 F.col("gmv_subtotal_cents") + F.col("total_delivery_fee_cents") + F.col("total_tips_cents"))


def reconcile_global(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """|sum(header subtotal) - sum(quantity * unit price)|."""
    h = headers.agg(F.sum("subtotal_cents").alias("gmv_subtotal_cents"),
                    F.count(F.lit(1)).alias("order_count"))
    li = lines.agg(F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("items_subtotal_cents"))
    return combine_one_row(h, li).withColumn(
        "reconciliation_delta_cents",
        F.abs(F.col("gmv_subtotal_cents") - F.coalesce(F.col("items_subtotal_cents"), F.lit(0))))


def reconcile_by_order(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """C3 per order: locate the orders whose header disagrees with its lines.
    Lines are pre-aggregated per order (map-side partial sums), then one full
    outer join on the shared order_id partitioning."""
    li = lines.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("lines_subtotal_cents"))
    h = headers.select("order_id", F.col("subtotal_cents").alias("header_subtotal_cents"))
    j = h.join(li, "order_id", "full_outer")
    d = F.coalesce(F.col("header_subtotal_cents"), F.lit(0)) - F.coalesce(F.col("lines_subtotal_cents"), F.lit(0))
    return j.withColumn("delta_cents", d).filter(F.col("delta_cents") != 0)


def pk_integrity(tables: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """C4: rows, distinct keys and null keys per table; unique requires
    rows == distinct keys and zero nulls."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.count_distinct(F.col(key)).alias("distinct_keys"),
                    F.count_if(F.col(key).isNull()).alias("null_keys"))
             .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
             for name, df, key in tables]
    u = reduce(DataFrame.unionByName, parts)
    return u.withColumn("is_unique", (F.col("row_count") == F.col("distinct_keys")) & (F.col("null_keys") == 0))


def completeness_gate(pk: DataFrame, recon: DataFrame) -> DataFrame:
    """complete = every key unique AND delta <= number of orders."""
    a = pk.agg(F.bool_and("is_unique").alias("all_keys_unique"))
    r = recon.select("reconciliation_delta_cents", "order_count")
    g = combine_one_row(a, r)
    return g.withColumn("completeness_verified",
                        F.col("all_keys_unique") & (F.col("reconciliation_delta_cents") <= F.col("order_count")))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Records retrieved vs reported total, terminal page flag, and the
    number of pages missing from the first..last range. The gap count is
    arithmetic on (last - first + 1) and the distinct landed pages, so no
    page range is ever generated in one task."""
    recs = pages.select("page", "total_records", "has_more", F.size("data").alias("n"))
    a = recs.agg(F.sum("n").alias("records_retrieved"),
                 F.max("total_records").alias("reported_total"),
                 F.min("total_records").alias("min_reported_total"),
                 F.count(F.lit(1)).alias("pages_landed"),
                 F.count_distinct("page").alias("distinct_pages"),
                 F.min("page").alias("first_page"),
                 F.max("page").alias("last_page"),
                 F.max_by("has_more", "page").alias("last_page_has_more"))
    out = a.withColumn("missing_pages",
                       F.col("last_page") - F.col("first_page") + 1 - F.col("distinct_pages"))
    return out.withColumn(
        "complete",
        (F.col("records_retrieved") == F.col("reported_total"))
        & (F.col("reported_total") == F.col("min_reported_total"))
        & ~F.col("last_page_has_more") & (F.col("missing_pages") == 0))


# canonical row text for the portable fingerprint (fixed layout)
NULL_TOKEN = "\\N"
FIELD_SEPARATOR = "\x1f"
DOUBLE_SCALE = 1e6            # doubles are hashed as round(x * 1e6) integers


def canonical_text(df: DataFrame, cols: list[str]) -> Column:
    """One text per row that any SQL engine can rebuild: integers and strings
    as they are, doubles as round(x * 1e6), timestamps as
    ``yyyy-MM-dd HH:mm:ss.SSSSSS``, booleans as 1/0, null as ``\\N``."""
    parts = []
    for c in cols:
        t, x = df.schema[c].dataType, F.col(c)
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            x = F.round(x.cast("double") * F.lit(DOUBLE_SCALE)).cast("long").cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            x = F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            x = F.date_format(x, "yyyy-MM-dd")
        elif isinstance(t, T.BooleanType):
            x = F.when(x, F.lit("1")).when(~x, F.lit("0"))
        elif not isinstance(t, T.StringType):
            x = x.cast("string")
        parts.append(F.coalesce(x, F.lit(NULL_TOKEN)))
    return F.concat_ws(FIELD_SEPARATOR, *parts)


def output_fingerprint(df: DataFrame, cols: list[str] | None = None, portable: bool = True) -> DataFrame:
    """Order-insensitive fingerprint = row count + exact sum of per-row
    hashes. Equal rows in any order and any partitioning give equal
    fingerprints; the sum is a partial aggregate, so no row moves.

    ``portable`` (default): the hash is the first 60 bits of the md5 of the
    canonical row text, so another engine can recompute the same value.
    Otherwise xxhash64 of the typed columns (faster, Spark-only).
    The sum is rendered as text because it exceeds 64 bits.
    """
    cols = cols or df.columns
    if portable:
        h = F.conv(F.substring(F.md5(canonical_text(df, cols)), 1, 15), 16, 10).cast("decimal(38,0)")
    else:
        h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string").alias("content_hash"))
