"""Sharding by a k-d tree over metadata.

The corpus is split along the metadata dimension in which a node is widest, at
the median weighted by bytes, until a leaf holds one shard's share (the target
bytes). Medians are found by histograms of all rows' bytes: BINS bins over a
node's range, then over the bin that holds the median, until a bin is a small
part of the node or a single value. All nodes of a level share each pass. The
tree (fewer nodes than shards) is the only thing the driver holds; a row's leaf is
an expression of its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

BINS = 4096
#: a median is narrowed down until its bin holds this part of a node's bytes at most
PART = 1 / 8192
#: rows numbered by one task of the slot numbering
NUMBERED = 500_000

_BITS = 31


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, plus 1), text_crc32, uid (a number of
    the row's own), and the dimensions k0 to k3: size, position of doc_id, source, language.
    A dimension's value is its upper 31 bits; the lower ones part rows that agree in
    it, repeated rows too."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"),
                    *[(F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
                      for c in ("source", "lang")])
    d = cut(d).withColumn("uid", F.monotonically_increasing_id())  # fixed once the rows are written
    ends = d.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    low, high = ends["a"] or 0, ends["b"] or 0
    shift = max(0, (high - low).bit_length() - _BITS + 1)
    tie = F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "uid"), F.lit(1 << _BITS))

    def key(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("long") * F.lit(1 << _BITS) + tie

    def name(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << _BITS))

    return d.select("doc_id", "size", "text_crc32", "uid",
                    key(F.least(F.col("size"), F.lit((1 << _BITS) - 1))).alias("k0"),
                    key(F.shiftright("doc_id", shift) - F.lit(low >> shift)).alias("k1"),
                    key(name("source")).alias("k2"), key(name("lang")).alias("k3"))


def _node(tree: dict[int, tuple[str, int]], at: int = 1) -> Column:
    """The leaf of a row: nested comparisons, one for each split on its way."""
    if at not in tree:
        return F.lit(at)
    dim, cutoff = tree[at]
    return F.when(F.col(dim) < F.lit(cutoff), _node(tree, 2 * at)).otherwise(_node(tree, 2 * at + 1))


def _medians(rows: DataFrame, ranges: dict[int, tuple[str, int, int]], shares: dict[int, float],
             totals: dict[int, int]) -> dict[int, int]:
    """For each node the key below which nearest to its share of the bytes lies.
    ``rows``: node, size and dimensions; ``ranges``: dimension, smallest and largest key."""
    below = {n: 0 for n in ranges}  # bytes before the range
    cuts: dict[int, int] = {}
    open_ = dict(ranges)
    while open_:
        value, bin_ = F.lit(None).cast("long"), F.lit(None).cast("long")
        for n, (dim, low, high) in open_.items():
            width = max(1, -(-(high - low + 1) // BINS))
            own = (F.col("node") == n) & F.col(dim).between(low, high)
            bin_ = F.when(own, F.floor((F.col(dim) - F.lit(low)) / F.lit(width))).otherwise(bin_)
            value = F.when(own, F.col(dim)).otherwise(value)
        hist = (rows.select("node", bin_.cast("long").alias("bin"), value.alias("v"), "size").where("bin is not null")
                .groupBy("node", "bin").agg(F.sum("size").alias("bytes"), F.min("v").alias("low"), F.max("v").alias("high")))
        up_to = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))  # BINS rows a node at most
        goal = F.lit(0.0)
        for n in open_:
            goal = F.when(F.col("node") == n, F.lit(shares[n] * totals[n] - below[n])).otherwise(goal)
        crossing = (hist.withColumn("up_to", up_to).withColumn("goal", goal).where("up_to >= goal")
                    .withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("bin"))).where("nth = 1"))
        found = {r["node"]: r for r in crossing.collect()}  # one row a node
        for n in list(open_):
            r = found[n]
            before = r["up_to"] - r["bytes"]
            if r["low"] < r["high"] and r["bytes"] > PART * totals[n]:
                below[n] += before
                open_[n] = (open_[n][0], r["low"], r["high"])
                continue
            near_low = r["goal"] - before <= r["up_to"] - r["goal"]
            cuts[n] = r["low"] if near_low else r["high"] + 1
            del open_[n]
    return cuts


def build_tree(meta: DataFrame, shards: int) -> tuple[dict[int, tuple[str, int]], dict[int, int]]:
    """The splits (node: dimension, cutoff) and the shard of each leaf."""
    dims = ["k0", "k1", "k2", "k3"]
    tree: dict[int, tuple[str, int]] = {}
    holds = {1: (0, shards)}  # node: first shard, number of shards
    span: dict[str, int] | None = None
    while any(n > 1 for _, n in holds.values()):
        rows = meta.withColumn("node", _node(tree))
        stats = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[
            f(c).alias(f"{c}_{f.__name__}") for c in dims for f in (F.min, F.max)]).collect()  # one row a node
        stats = {r["node"]: r for r in stats}

        def width(n: int, c: str) -> int:
            return (stats[n][f"{c}_max"] >> _BITS) - (stats[n][f"{c}_min"] >> _BITS)

        if span is None:
            span = {c: max(1, width(1, c)) if 1 in stats else 1 for c in dims}
        ranges, shares = {}, {}
        for n, (_, count) in holds.items():
            if count > 1 and n in stats:
                dim = max(dims, key=lambda c: width(n, c) / span[c])  # the widest, against the whole corpus
                ranges[n] = (dim, stats[n][f"{dim}_min"], stats[n][f"{dim}_max"])
                shares[n] = (count // 2) / count
        cuts = _medians(rows, ranges, shares, {n: stats[n]["bytes"] for n in ranges}) if ranges else {}
        for n, (first, count) in list(holds.items()):
            if count > 1:
                tree[n] = (ranges[n][0], cuts[n]) if n in cuts else (dims[0], 0)
                holds[2 * n], holds[2 * n + 1] = (first, count // 2), (first + count // 2, count - count // 2)
                del holds[n]
    return tree, {n: first for n, (first, _) in holds.items()}


def kd_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null)
    for each row of ``docs``: shards of nearly equal bytes, slots from 0 without gaps.

    A null text has size 1 and the checksum of no bytes. Null doc_ids, sources
    and languages are values like others; missing source or lang columns count as
    null. Repeated rows each have a place, in any shard. Other columns are ignored; an empty table gives an empty one.
    """
    meta = cut(metadata(docs))
    tree, leaves = build_tree(meta, shards)
    shard = F.element_at(F.create_map(*[F.lit(x) for n, s in leaves.items() for x in (n, s)]), _node(tree))
    rows = meta.select("doc_id", "size", "text_crc32", "uid", shard.cast("int").alias("shard"))
    return number_slots(rows, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                             F.lit(None).cast("int").alias("grown_shard"))


def number_slots(rows: DataFrame, shards: int) -> DataFrame:
    """Adds slot: 0, 1, ... within each shard, by parts of a shard, so that no task
    numbers a whole shard of a large corpus."""
    parts = max(4, -(-rows.count() // (shards * NUMBERED)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("uid"))
    return (rows.withColumn("nth", nth).join(offsets, ["shard", "part"])
            .withColumn("slot", (F.col("before") + F.col("nth") - 1).cast("long")).drop("part", "nth", "before"))
