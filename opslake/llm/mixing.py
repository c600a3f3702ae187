"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised.
The exponent is bisected, between 0 (all sources alike) and 1 (their shares), to
the least one that keeps every source within a repetition limit, or the greatest
one that reaches an entropy. The weights are realised as budgeted block
permutations: each source is drawn in passes, each a permutation of its
documents, until its token budget is used; a draw's place in its source's stream
gives its block, so that every block holds the sources by their weights, and each
block is permuted again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: most passes over a source, tokens of a block
REPETITIONS, BLOCK_TOKENS = 2.0, 2_000_000
#: exponents tried in one pass of the bisection, and passes
GRID, ROUNDS = 32, 6
#: documents of a source that are put in order together, and salts of the join with the sources' budgets
NUMBERED, SALTS = 4096, 64


def token_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def exponent(totals: DataFrame, repetitions: float | None, entropy: float | None) -> float:
    """``totals``: one row for each source with its tokens (positive). Each pass
    tries GRID exponents over the interval left and keeps the part where the
    target is met."""
    low, high = 0.0, 1.0
    top = totals.agg(F.max("tokens").alias("m"), F.min("tokens").alias("l")).first()
    if top["m"] is None:
        return 1.0
    x = F.log(F.col("tokens") / F.lit(float(top["m"])))  # relative to the largest, so that powers stay in range
    for _ in range(ROUNDS):
        tries = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        e = totals.withColumn("a", F.explode(F.array(*[F.lit(a) for a in tries])))
        rows = e.groupBy("a").agg(F.sum(F.exp(F.col("a") * x)).alias("z"),
                                  F.sum(F.exp(F.col("a") * x) * F.col("a") * x).alias("zx")).collect()  # GRID + 1 rows
        ok = {}
        for r in rows:
            if entropy is not None:
                ok[r["a"]] = math.log(r["z"]) - r["zx"] / r["z"] >= entropy
            else:  # the budget takes the largest source once, so the smallest is repeated most
                ok[r["a"]] = (top["m"] / top["l"]) ** (1 - r["a"]) <= repetitions
        if entropy is not None:  # met by the flatter weights, that is up to some exponent
            good = [a for a in tries if ok[a]]
            if not good:
                return low
            low = max(good)
            high = min([a for a in tries if a > low], default=low)
        else:  # met from some exponent on
            good = [a for a in tries if ok[a]]
            if not good:
                return 1.0
            high = min(good)
            low = max([a for a in tries if a < high], default=high)
        if low == high:
            break
    return low if entropy is not None else high


def mix(docs: DataFrame, repetitions: float | None = REPETITIONS, entropy: float | None = None,
        budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> DataFrame:
    """All columns of ``docs`` and _tokens, _pass (from 0), _block, _place (within
    the block, from 0): one row for each draw.

    budget: tokens of the mix; by default as many as take the source with the
    fewest repetitions once, so that every document is drawn. With a smaller
    budget a source's last pass takes the first documents of a permutation.
    A null source is a source; texts that are null or without words have no
    tokens, weigh nothing, and are drawn with their source's first pass; a source
    without tokens is drawn once. Repeated rows are drawn each. The choice follows
    from doc_id, text and seed only. An empty table gives an empty one.
    """
    if (repetitions is None) == (entropy is None):
        raise ValueError("one target: repetitions or entropy")
    names = [c for c in docs.columns]
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("s"),
                    token_count(F.col("text").cast("string")).alias("tokens"),
                    F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"))
    d = cut(d.groupBy("s", "key", "doc_id", "tokens").agg(F.count("*").alias("rows")))
    totals = cut(d.groupBy("s").agg(F.sum(F.col("tokens") * F.col("rows")).alias("tokens"), F.sum("rows").alias("docs")))
    some = totals.where("tokens > 0")
    a = exponent(some, repetitions, entropy)
    top = some.agg(F.max("tokens").alias("m")).first()["m"] or 1
    x = F.pow(F.col("tokens") / F.lit(float(top)), F.lit(a))
    z = some.agg(F.sum(x).alias("z")).first()["z"] or 1.0
    weight = F.when(F.col("tokens") > 0, x / z).otherwise(0.0)
    # T ** a / z * budget >= T for all sources: the largest source is the last to reach it
    total = float(budget) if budget is not None else float(top) * z
    plan = totals.withColumn("budget", weight * total).withColumn(
        "passes", F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(1.0))
    blocks = max(1, math.ceil(total / block_tokens))
    # part of a source that one task permutes: a hot source has many
    plan = plan.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("docs") / NUMBERED)).cast("int"))
    # a whole number of passes up to rounding errors stays whole
    plan = plan.withColumn("times", F.greatest(F.lit(1), F.ceil(F.col("passes") - 1e-9)).cast("int"))
    # a source with a third of all documents is met by SALTS copies of its budget
    plan = plan.select("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.col("tokens").alias("all"),
                       "budget", "passes", "parts", "times")
    # each of repeated rows has a place of its own in the permutation
    each = d.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
    draws = (each.withColumn("salt", F.pmod(F.xxhash64("key", "copy"), F.lit(SALTS)).cast("int")).join(plan, ["s", "salt"]).drop("salt")
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
             .withColumn("order", F.xxhash64("key", "pass", F.lit(seed), "copy"))
             .withColumn("part", F.floor(F.shiftrightunsigned("order", 33) * F.col("parts") / F.lit(float(1 << 31))).cast("int")))
    sums = draws.groupBy("s", "pass", "part").agg(F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("s", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("s", "pass", "part", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("offset"))
    # the unsigned order: the upper half of a signed hash comes after
    within = (Window.partitionBy("s", "pass", "part").orderBy(F.shiftrightunsigned("order", 1), "order", "doc_id", "copy")
              .rowsBetween(Window.unboundedPreceding, -1))
    draws = (draws.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
             .join(offsets, ["s", "pass", "part"]).withColumn("before", F.col("offset") + F.col("inside")))
    # a document is drawn if its pass's budget is not used up where it begins
    left = (F.col("passes") - F.col("pass")) * F.col("all")
    draws = draws.where((F.col("passes") - F.col("pass") >= 1 - 1e-9) | (F.col("before") < left)
                        | ((F.col("pass") == 0) & (F.col("all") == 0)))
    # documents of a source without tokens lie evenly over the blocks
    even = F.shiftrightunsigned("order", 33) / F.lit(float(1 << 31))
    spot = F.when(F.col("all") > 0, (F.col("pass") * F.col("all") + F.col("before")) / F.col("budget")).otherwise(even)
    draws = draws.withColumn("block", F.least(F.floor(spot * blocks), F.lit(blocks - 1)).cast("long"))
    place = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("order", "copy"), "doc_id", "copy")) - 1
    draws = draws.select("key", "s", "doc_id", "tokens", "pass", "block", "copy", place.cast("long").alias("place"))
    return _hand_out(docs, draws, names)


def _hand_out(docs: DataFrame, draws: DataFrame, names: list[str]) -> DataFrame:
    """The documents' columns beside their draws. Equal rows (same id, text and
    source) take one draw list each, by their number among themselves."""
    used = {n.lower() for n in names}

    def free(n: str) -> str:
        while n.lower() in used:
            n += "_"
        return n

    key, src, copy = free("_key"), free("_source"), free("_copy")
    left = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    left = left.withColumn(src, F.coalesce(F.col("source").cast("string"), F.lit("\0")))
    if draws.where("copy > 1 and pass = 0").limit(1).count():  # rows that repeat at all
        # numbered within each partition of the input, after those of the partitions before it
        part, row, start = free("_part"), free("_row"), free("_start")
        left = left.withColumn(row, F.monotonically_increasing_id()).withColumn(part, F.shiftright(row, 33))
        before = Window.partitionBy(key, src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        starts = left.groupBy(key, src, part).agg(F.count("*").alias(start))
        starts = starts.withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0)))
        inside = F.row_number().over(Window.partitionBy(key, src, part).orderBy(row))
        left = left.join(starts, [key, src, part]).withColumn(copy, F.col(start) + inside)
    else:
        left = left.withColumn(copy, F.lit(1).cast("long"))
    right = draws.select(F.col("key").alias(key), F.col("s").alias(src), F.col("copy").alias(copy),
                         F.col("tokens").alias(free("_tokens")), F.col("pass").alias(free("_pass")),
                         F.col("block").alias(free("_block")), F.col("place").alias(free("_place")))
    return left.join(right, [key, src, copy]).select(
        *[F.col(f"`{n}`") for n in names], *[free(n) for n in ("_tokens", "_pass", "_block", "_place")])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, tokens, pass, block, place of each draw of ``mix``."""
    return mix(docs.select("doc_id", "text", "source"), **options).select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("_tokens").alias("tokens"), F.col("_pass").alias("pass"),
        F.col("_block").alias("block"), F.col("_place").alias("place"))
