"""Exact dedup on an extendible-hash index kept in the shared folder.

Texts are equal when identical after deleting space and U+0009 to U+000D.

1. The index: one entry for each row (64-bit hash of the normalised text, its
   SHA-256, length and doc_id), written to the shared checkpoint folder.
   Repeated entries are one entry with a count.
2. The directory: hash prefixes of ``g`` bits with the number of distinct
   hashes of each. A bucket is the shortest prefix that holds at most
   ``bucket_keys`` of them; while a bucket of all ``g`` bits is overfull, the
   directory is doubled (``g + 1``). Copies have one hash and count once, so a
   group of copies cannot overfill a bucket.
3. Copies combine: texts whose hash occurs more than once are grouped by the whole
   normalised text, not by a digest, with map-side combine, so a group of copies
   moves one row from each task.
4. Owner tasks: the distinct texts are dealt by the directory's buckets, so a task
   owns ranges of the key space, all texts of a key with it. Under a key they are
   chained by their bytes: each has its link in the chain, and links beyond the first are
   collisions of the hash.
5. The groups' results are joined back to the entries.

Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: distinct hashes of a bucket
BUCKET_KEYS = 4096
#: the directory is not doubled beyond this (hashes that differ always part earlier)
MAX_BITS = 40
#: bits of the filter that spares the text shuffle most rows with a unique hash
FILTER_BITS = 19


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")


def _hash(text: Column) -> Column:
    return F.xxhash64(normalised(text))


def _prefix(h: Column, bits: int) -> Column:
    """The upper ``bits`` of a 64-bit hash, from 0."""
    return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned(h, 64 - bits)


def _rank(chars: Column, doc_id: Column) -> Column:
    """Larger is better: more code points, then the smaller doc_id; null ids last."""
    ids = F.coalesce(doc_id.cast("decimal(38,0)"), _whole(1 << 63).cast("decimal(38,0)"))
    return (chars.cast("decimal(18,0)") * _whole(1 << 65) - ids).cast("decimal(38,0)")


def build_index(docs: DataFrame) -> DataFrame:
    """doc_id, h, sha, chars, copies (how often the entry is there)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    e = d.select("doc_id", _hash(F.col("text")).alias("h"), F.sha2(normalised(F.col("text")), 256).alias("sha"),
                 F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    return cut(e.groupBy("h", "sha", "chars", "doc_id").agg(F.count("*").alias("copies")))


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """(cell, bucket) for each used prefix of g bits, and g. ``keys``: distinct h."""
    n = keys.count()
    bits = max(4, (n // bucket_keys).bit_length() + 2)
    while True:
        cells = keys.groupBy(_prefix(F.col("h"), bits).alias("cell")).agg(F.count("*").alias("keys"))
        if bits >= MAX_BITS or cells.where(F.col("keys") > bucket_keys).isEmpty():
            break
        bits += 1  # directory doubling
    cells = cut(cells)
    levels = cells.select("cell", "keys", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn(
        "first", F.expr(f"shiftleft(shiftright(cell, {bits} - depth), {bits} - depth)"))
    fits = levels.groupBy("depth", "first").agg(F.sum("keys").alias("held")).where(
        (F.col("held") <= bucket_keys) | (F.col("depth") == bits))
    # the shortest prefix that fits; a bucket is named by the first cell under it
    found = (levels.join(fits, ["depth", "first"]).groupBy("cell")
             .agg(F.min(F.struct("depth", "first")).alias("b")))
    return cut(found.select("cell", F.col("b.first").alias("bucket"), F.col("b.depth").alias("depth"))), bits


def _filter(hashes: DataFrame) -> bytes:
    """A bitmap of the hashes' upper FILTER_BITS bits."""
    words = (hashes.select(_prefix(F.col("h"), FILTER_BITS).alias("p"))
             .selectExpr("shiftright(p, 6) word", "shiftleft(1L, int(p & 63)) bits")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect())  # at most 2**FILTER_BITS / 64 rows
    out = bytearray((1 << FILTER_BITS) // 8)
    for r in words:
        out[r["word"] * 8:r["word"] * 8 + 8] = r["bits"].to_bytes(8, "little", signed=True)
    return bytes(out)


def _in_filter(bits: bytes, p: Column) -> Column:
    byte = F.substring(F.lit(bits), (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))
    return F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), F.pmod(p, F.lit(8))).cast("int")) != 0


def owned_chains(docs: DataFrame, index: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """h, norm, best, rows, bucket, link: the distinct texts whose hash occurs more than
    once, each bucket in one task, chained under their hash by their bytes (link from 1)."""
    keys = cut(index.groupBy("h").agg(F.sum("copies").alias("rows")))
    cells, bits = directory(keys.select("h"), bucket_keys)
    repeated = keys.where("rows > 1").select("h", _prefix(F.col("h"), bits).alias("cell")).join(cells, "cell")
    repeated = cut(repeated.select("h", "bucket"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.select(normalised(F.col("text")).alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("chars"), "doc_id")
    d = d.withColumn("h", F.xxhash64("norm")).withColumn("p", _prefix(F.col("h"), FILTER_BITS))
    some = d.where(_in_filter(_filter(repeated), F.col("p"))).select(
        "h", "norm", _rank(F.col("chars"), F.col("doc_id")).alias("rank"))
    combined = some.groupBy("h", "norm").agg(F.max("rank").alias("best"), F.count("*").alias("rows"))
    owned = combined.join(repeated, "h").repartition("bucket")
    return owned.withColumn("link", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("norm")))


def duplicate_groups(docs: DataFrame, index: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """h, sha, best, group_size: one row for each group of at least two rows
    whose normalised texts have equal bytes: a link with several rows."""
    return owned_chains(docs, index, bucket_keys).where("rows > 1").select(
        "h", F.sha2("norm", 256).alias("sha"), "best", F.col("rows").alias("group_size"))


def exact_dedup(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chars, copy for each row
    of ``docs``, dropped ones too. Of equal texts the row with the most code
    points of the original text stays, then the smallest doc_id.

    A null text counts as empty; empty and blank texts are equal and form one
    group. Null doc_ids lose against others; keep_id is null where all are
    null. Of repeated rows (equal id and text) one is kept: ``copy`` numbers
    them from 1. Other columns are ignored; an empty table gives an empty one.
    """
    index = build_index(docs)
    groups = duplicate_groups(docs, index, bucket_keys)
    rows = index.join(groups, ["h", "sha"], "left")
    best = F.col("best")
    rows = rows.withColumn("own", _rank(F.col("chars"), F.col("doc_id")))
    step = _whole(1 << 65)
    # best = chars * step - id, and ids lie within a quarter of a step of 0
    chars = F.floor((best + _whole(1 << 64)) / step)
    ident = (chars.cast("decimal(18,0)") * step - best).cast("decimal(38,0)")
    keep = F.when(best.isNull(), F.col("doc_id")).when(ident < _whole(1 << 63), ident.cast("long"))
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    ((best.isNull() | (F.col("own") == best)) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256"), F.col("chars").alias("n_chars"), "copy"))


def deduplicated(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay (one of repeated rows)."""
    names = docs.columns
    found = cut(exact_dedup(docs, bucket_keys))
    kept = found.where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha"),
                                      F.col("n_chars").alias("k_chars"))
    used = {n.lower() for n in names}
    sha, chars, nth = (next(n for n in (f"{x}{'_' * i}" for i in range(len(names) + 1)) if n not in used)
                       for x in ("_sha", "_chars", "_nth"))
    text = F.col("text").cast("string")
    rows = docs.withColumn(sha, F.sha2(normalised(text), 256)).withColumn(
        chars, F.length(F.coalesce(text, F.lit(""))).cast("long"))
    rows = rows.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("k_id")) & (F.col(sha) == F.col("k_sha"))
                     & (F.col(chars) == F.col("k_chars")), "left_semi")
    if not found.where("copy > 1").isEmpty():
        # one of repeated rows: the first as they lie in the input, found without their texts
        rows = rows.withColumn(nth, F.monotonically_increasing_id())
        first = rows.groupBy("doc_id", sha, chars).agg(F.min(nth).alias(nth)).select(nth)
        rows = rows.join(first, nth, "left_semi")
    return rows.select(*[F.col(f"`{n}`") for n in names])
