"""Exact top-k search by inner product: columnar branch and bound.

Vectors lie in blocks, dimension by dimension (vertical layout), the dimensions with
the most mass first. Blocks hold vectors of one band of norms. A block of queries meets
a block of candidates: products are added up over one group of dimensions after
another; after each, a pair whose sum so far plus the most that the remaining
dimensions can give (the product of both remaining norms) stays under the k-th
best score known to its query is dropped, and the pairs that survive are compacted.
A first round against blocks of the largest norms gives each query its bound. With
it, blocks whose largest norm cannot reach the bound of any query of a block are
dropped by their numbers alone; only the others are joined with their vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.llm.graph import cut

#: bytes of a block of candidates and of queries, dimensions added up before each look at the bounds
CANDIDATES, QUERIES, DIMENSIONS = 4 << 20, 1 << 18, 16
#: bands of norms, with as many vectors each
BANDS = 64
#: part of a block's pairs under which they are gone on with one by one
FEW = 0.2
#: sums of products below this are exact in double precision
_EXACT = float(1 << 53)


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (floor(scale * x) as doubles) of vectors whose components are all finite."""
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    d = d.where("vec_id is not null and e is not null and "
                "not exists(e, x -> x is null or isnan(x) or abs(x) = double('Infinity'))")
    return d.select("vec_id", F.expr(f"transform(e, x -> floor(x * {scale}D))").cast("array<double>").alias("v"))


def _banded(vectors: DataFrame, number: int, name: str) -> DataFrame:
    """``vectors`` with their norm and block (named ``name``, from 0): bands of falling norms,
    and in each band blocks by the hash of the id."""
    bands = min(BANDS, number)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.withColumn("norm", norm)
    cuts = rows.agg(F.percentile_approx("norm", [i / bands for i in range(1, bands)] or [0.5], 10_000).alias("c")).first()["c"]
    cuts = sorted(cuts or [], reverse=True)[:bands - 1]
    band = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c >= F.col("norm")))
    each = -(-number // bands)
    return rows.withColumn(name, (band * each + F.pmod(F.xxhash64("vec_id"), F.lit(each))).cast("int"))


def _blocks(vectors: DataFrame, order: list[int], name: str) -> DataFrame:
    """One row for each block: its number, largest norm, ids and components by
    dimension, in ``order``."""
    dims = len(order)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        ids = table.column("vec_id").to_numpy().astype("<i8")
        m = np.zeros((dims, len(ids)))
        for i, v in enumerate(table.column("v")):
            v = v.values.to_numpy(zero_copy_only=False)
            m[:len(v), i] = v
        return pa.table({name: pa.array([key[0].as_py()], pa.int32()),
                         f"{name}_norm": pa.array([float(table.column("norm").to_numpy().max())]),
                         f"{name}_ids": pa.array([ids.tobytes()], pa.binary()),
                         f"{name}_data": pa.array([m[order].astype("<f8").tobytes()], pa.binary())})

    return vectors.groupBy(name).applyInArrow(build, f"{name} int, {name}_norm double, {name}_ids binary, {name}_data binary")


def search_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, least: np.ndarray, k: int,
                 step: int = DIMENSIONS, seen: list[int] | None = None):
    """Best ``k`` candidates (query index, candidate id, score) of each query in
    this block with a score of at least ``least``, ties to the smaller id.
    ``q``, ``c``: dimensions by vectors, integers held as doubles. ``seen`` takes the
    number of pairs alive before each group of dimensions."""
    dims = len(q)
    high = max(np.abs(q).max(initial=0), 1) * max(np.abs(c).max(initial=0), 1) * max(dims, 1)
    if high >= _EXACT:  # too large for doubles: plain integers
        q, c = np.vectorize(int, otypes=[object])(q), np.vectorize(int, otypes=[object])(c)
        return _pick(q_ids, np.arange(len(q_ids)), c_ids, q.T @ c, least.astype(object), k)
    tail_q = np.sqrt(np.cumsum((q * q)[::-1], axis=0)[::-1])
    tail_c = np.sqrt(np.cumsum((c * c)[::-1], axis=0)[::-1])
    alive = np.arange(len(c_ids))
    sums = np.zeros((len(q_ids), len(c_ids)))
    at = 0
    while True:
        if seen is not None:
            seen.append(sums.size)
        to = min(at + step, dims)
        sums += q[at:to].T @ c[at:to][:, alive]
        at = to
        if at >= dims or not len(alive):
            return _pick(q_ids, np.arange(len(q_ids)), c_ids[alive], sums, least, k)
        # remaining mass, a little up for rounding
        stay = sums + tail_q[at][:, None] * tail_c[at][alive][None, :] * (1 + 1e-9) + 1e-6 >= least[:, None]
        if stay.sum() < FEW * stay.size:
            i, j = np.nonzero(stay)
            return _pairs(q_ids, q, c_ids, c, i, alive[j], sums[stay], at, tail_q, tail_c, least, k, step, seen)
        some = stay.any(axis=0)
        if some.mean() < 0.9:
            alive, sums = alive[some], sums[:, some]


def _pairs(q_ids, q, c_ids, c, i, j, sums, at, tail_q, tail_c, least, k, step, seen):
    """The rest of a block from dimension ``at`` on, pair by pair (query i, candidate j)."""
    dims = len(q)
    while at < dims and len(i):
        if seen is not None:
            seen.append(len(i))
        to = min(at + step, dims)
        for d in range(at, to):
            sums = sums + q[d][i] * c[d][j]
        at = to
        if at < dims:
            stay = sums + tail_q[at][i] * tail_c[at][j] * (1 + 1e-9) + 1e-6 >= least[i]
            i, j, sums = i[stay], j[stay], sums[stay]
    for n in np.unique(i).tolist():
        own = i == n
        yield from ((n, v, s) for _, v, s in _pick(q_ids[n:n + 1], np.zeros(1, np.int64), c_ids[j[own]], sums[own][None, :], least[n:n + 1], k))


def _pick(q_ids, rows, ids, sums, least, k):
    for i in rows.tolist():
        s = sums[i]
        near = np.flatnonzero((s >= least[i]) & (ids != q_ids[i]))
        if len(near) > k and s.dtype != object:
            kth = np.partition(s[near], len(near) - k)[len(near) - k]
            near = near[s[near] >= kth]
        best = sorted(near.tolist(), key=lambda j: (-s[j], ids[j]))[:k]
        for j in best:
            yield i, int(ids[j]), int(s[j])


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the ``k`` highest inner products
    of each query, a row whose vec_id is divisible by ``every``, with all rows but
    its own. Components are taken as floor(scale * x); ties go to the smaller vec_id.

    Vectors that are null or hold a null or non-finite component, and rows with
    a null vec_id, take no part. Shorter vectors count as filled up with zeros.
    Rows that repeat a vec_id are candidates each (not for their own id) and one
    query: the one first in order of components. A query without candidates has no row;
    an empty table gives an empty one. Other columns are ignored. Scores beyond
    64 bits become the nearest 64-bit number.
    """
    data = cut(quantised(vectors, scale))
    size = data.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, dims = size["n"], size["d"] or 0
    queries = (data.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v")))
    row = 8 * max(dims, 1)
    parts = max(1, -(-n // max(1, CANDIDATES // row)))
    lots = max(1, -(-n // every // max(1, QUERIES // row)))
    # dimensions by falling mass, so that the first ones decide most
    mass = {r["i"]: r["m"] for r in data.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x") * F.col("x")).alias("m")).collect()}  # a row a dimension
    order = sorted(range(dims), key=lambda i: (-mass.get(i, 0.0), i))
    c = cut(_blocks(_banded(data, parts, "c"), order, "c"))
    asked = cut(_banded(queries, lots, "q"))
    q = cut(_blocks(asked, order, "q"))

    def matrix(ids: pa.Scalar, cells: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(ids.as_buffer(), "<i8")
        return ids, np.frombuffer(cells.as_buffer(), "<f8").reshape(dims, len(ids))

    def clip(v: int) -> int:
        return max(-(1 << 63), min((1 << 63) - 1, v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r] for i, name in enumerate(batch.schema.names)}
                (q_ids, qm), (c_ids, cm) = matrix(row["q_ids"], row["q_data"]), matrix(row["c_ids"], row["c_data"])
                least = np.full(len(q_ids), -np.inf)
                if "least" in row and row["least"].is_valid:
                    least = np.frombuffer(row["least"].as_buffer(), "<f8")
                found = list(search_block(q_ids, qm, c_ids, cm, least, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(q_ids[i]) for i, _, _ in found], pa.int64()), pa.array([v for _, v, _ in found], pa.int64()),
                     pa.array([clip(s) for _, _, s in found], pa.int64())], ["query_id", "vec_id", "score"])

    schema = "query_id long, vec_id long, score long"
    # each block of queries first meets one block of the largest norms ...
    top = cut(c.select("c", "c_norm").orderBy(F.desc("c_norm"), "c").limit(8))
    tops = [r["c"] for r in top.collect()]
    if not tops:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    start = F.element_at(F.array(*[F.lit(t) for t in tops]), (F.pmod("q", F.lit(len(tops))) + 1).cast("int"))
    begin = q.withColumn("c", start).join(c, "c")
    first = cut(begin.select("q_ids", "q_data", "c_ids", "c_data").mapInArrow(run, schema))
    bound = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
    bound = bound.join(asked.select(F.col("vec_id").alias("query_id"), "q", "norm"), "query_id")

    def bounds(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """A block's bounds, and the norm that a candidate needs to reach any of them."""
        out, need = [], []
        known = {i: (s, norm) for i, s, norm in zip(*(right.column(x).to_pylist() for x in ("query_id", "s", "norm")))}
        for ids in left.column("q_ids"):
            each = [known.get(i, (-np.inf, 1.0)) for i in np.frombuffer(ids.as_buffer(), "<i8").tolist()]
            low = np.array([float(s) if abs(s) < _EXACT else -np.inf for s, _ in each], "<f8")
            out.append(low.tobytes())
            norms = np.array([norm for _, norm in each])
            need.append(float(np.where(low > 0, low / np.maximum(norms, 1e-300) * (1 - 1e-9), 0.0).min()))
        return pa.table({"q": left.column("q"), "least": pa.array(out, pa.binary()), "need": pa.array(need)})

    known = cut(q.select("q", "q_ids").groupBy("q").cogroup(bound.groupBy("q")).applyInArrow(bounds, "q int, least binary, need double"))
    # ... then, with its bounds, those others that can reach them: settled by numbers alone
    numbers = c.select("c", "c_norm")
    last = c.agg(F.max("c")).first()[0]
    pairs = (known.select("q", "need").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(last)))).where(F.col("c") != start)
             .join(numbers, "c").where(F.col("c_norm") >= F.col("need")).select("q", "c"))
    rest = pairs.join(known.select("q", "least"), "q").join(q, "q").join(c, "c")
    others = rest.select("q_ids", "q_data", "c_ids", "c_data", "least").mapInArrow(run, schema)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (first.unionByName(others).withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
