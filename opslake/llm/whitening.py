"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors lie in blocks of rows, centred exactly (n * x - S in integers)
before anything is multiplied. Each step multiplies the centred rows X by a right
vector and the result by X transposed, block by block in Spark tasks; sums of as many
numbers as there are dimensions come back. Both sides are orthogonalised in full,
twice where needed. A left vector has an entry for every row; it is kept as the
combination of dimensions that gives it (u = X g), so no step writes rows. The
singular value decomposition of the small bidiagonal matrix gives components and
deviations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.graph import cut

#: bytes of a block of rows and of a partition of blocks; partial sums added up in one task or the driver
BLOCK, PART, FAN_IN = 4 << 20, 32 << 20, 64
#: what is added to each component of a vector
SHIFT = 1_000_000
#: entries beyond this are taken as this
LARGEST = 1 << 40
#: relative size under which a direction counts as empty
EMPTY = 1e-7


def shifted(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, x (long: floor(scale * c) + SHIFT) of vectors whose entries are all finite."""
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    d = d.where("e is not null and not exists(e, c -> c is null or isnan(c) or abs(c) = double('Infinity'))")
    bounded = f"greatest(least(floor(c * {scale}D), {LARGEST}L), -{LARGEST}L)"
    return d.select("vec_id", F.expr(f"transform(e, c -> {bounded} + {SHIFT}L)").cast("array<long>").alias("x"))


def _matrix(column, dims: int) -> np.ndarray:
    """An Arrow column of lists as rows of ``dims`` numbers; shorter lists are filled with SHIFT, the place of a zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    if (size == dims).all():
        return values[offsets[0]:offsets[-1]].reshape(len(size), dims)
    out = np.full((len(size), dims), SHIFT, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], size)] = values[offsets[0]:offsets[-1]]
    return out


@dataclass
class Fit:
    """n vectors with sums S by dimension; components (by rows, of unit length) with their
    eigenvalues; the trace of the covariance; the largest absolute entry of the whitened
    covariance minus the identity; products made."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    products: int


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, with the difference formed in integers."""
    s = np.array(sums, dtype=object)
    if n * int(np.abs(x).max(initial=0)) < 1 << 62 and max(map(abs, sums), default=0) < 1 << 62:
        return (n * x - s.astype(np.int64)) / n
    return ((n * x.astype(object) - s) / n).astype(float) if x.size else x.astype(float)


class Rows:
    """The distinct vectors in Spark, in blocks, and sums over all of them."""

    def __init__(self, distinct: DataFrame, dims: int, most: int):
        """``most``: a bound for the number of vectors."""
        self.dims, self.n, self.sums, self.products = dims, 0, [0] * dims, 0
        rows = max(1, BLOCK // (8 * dims))
        self.parts = max(1, -(-8 * dims * most // PART))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    m = _matrix(batch.column(0).slice(at, rows), dims)
                    yield pa.RecordBatch.from_arrays([pa.array([m.astype("<i8").tobytes()], pa.binary())], ["block"])

        self.blocks = cut(distinct.select("x").coalesce(self.parts).mapInArrow(build, "block binary"))

        def exact(x):  # high and low parts apart, so that no sum leaves 64 bits
            return np.concatenate(([len(x)], (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)))

        got = self._sum(exact, 2 * dims + 1, "<i8").tolist()
        self.n = got[0]
        self.sums = [(h << 20) + low for h, low in zip(got[1:dims + 1], got[dims + 1:])]

    def _sum(self, of, size: int, kind: str = "<f8") -> np.ndarray:
        """The sum over all blocks of the ``size`` numbers that ``of`` gives for each,
        added up in a tree: first by partition, then FAN_IN partitions a task."""
        dims = self.dims

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, kind)
            for batch in batches:
                for block in batch.column(0):
                    total += of(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dims))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, kind)
            for batch in batches:
                for v in batch.column(0):
                    total += np.frombuffer(v.as_buffer(), kind)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

        out, parts = self.blocks.mapInArrow(partial, "v binary"), self.parts
        while parts > FAN_IN:
            parts = -(-parts // FAN_IN)
            out = out.repartition(parts).mapInArrow(add, "v binary")
        total = np.zeros(size, kind)
        for r in out.collect():  # at most FAN_IN rows
            total += np.frombuffer(r["v"], kind)
        return total

    def product(self, h: np.ndarray) -> tuple[np.ndarray, float]:
        """Xᵀu and |u|² for u = Xh, X the centred rows."""
        self.products += 1
        n, sums = self.n, self.sums

        def of(x):
            c = centred(x, n, sums)
            u = c @ h
            return np.append(c.T @ u, u @ u)

        both = self._sum(of, self.dims + 1)
        return both[:-1], float(both[-1])

    def squares(self) -> np.ndarray:
        """Sums of the squared entries by dimension."""
        n, sums = self.n, self.sums
        return self._sum(lambda x: (centred(x, n, sums) ** 2).sum(axis=0), self.dims)

    def gram(self, w: np.ndarray) -> np.ndarray:
        """(Xw)ᵀ(Xw) for a few columns w."""
        n, sums, k = self.n, self.sums, w.shape[1]

        def of(x):
            p = centred(x, n, sums) @ w
            return (p.T @ p).ravel()

        return self._sum(of, k * k).reshape(k, k)


def bidiagonalise(product, dims: int, scale: float, enough=None, without: np.ndarray | None = None, seed: int = 1):
    """Right vectors V (by rows) and the upper bidiagonal matrix B with X V = U B.

    ``product``: h to (Xᵀu, |u|²) for u = Xh; ``scale``: the size of X, against which a
    vector counts as empty. Where a side runs out, a new random direction is taken, so
    that repeated singular values are found as often as they occur; the steps end when
    there is none left or ``enough(B, coupling to the next vector)`` holds. ``without``:
    orthonormal rows that all right vectors keep out of.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((0, dims)) if without is None else without
    rights: list[np.ndarray] = []
    lefts: list[np.ndarray] = []       # g, with u = X g of unit length (zeros: an empty u)
    backs: list[np.ndarray] = []       # Xᵀu
    alphas: list[float] = []
    betas: list[float] = []            # betas[i] couples u_i and v_(i + 1)

    def clean(v: np.ndarray) -> np.ndarray:
        m = np.vstack([out, *rights])
        for _ in range(2):
            v = v - m.T @ (m @ v)
        return v

    def fresh() -> np.ndarray | None:
        if len(rights) + len(out) >= dims:
            return None
        return clean(rng.standard_normal(dims))

    v, coupled = fresh(), 0.0
    while v is not None:
        v = v / np.linalg.norm(v)
        # u = X v - beta u_before, then without its parts along all u
        h = v - coupled * lefts[-1] if coupled else v
        back, square = product(h)
        live = [i for i, g in enumerate(lefts) if g.any()]
        for _ in range(2):
            if not live or square <= (EMPTY * scale) ** 2:
                break
            g = np.array([lefts[i] for i in live])
            part = g @ back                    # uᵢᵀu = gᵢᵀ(Xᵀu)
            h = h - g.T @ part
            if np.linalg.norm(part) <= 1e-9 * math.sqrt(square):
                back = back - np.array([backs[i] for i in live]).T @ part
                break
            back, square = product(h)          # too much was taken away: multiply again
        rights.append(v)
        if len(rights) > 1:
            betas.append(coupled)
        alpha = math.sqrt(max(square, 0.0))
        if alpha <= EMPTY * scale:
            alpha, h, back = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            h, back = h / alpha, back / alpha
        alphas.append(alpha)
        lefts.append(h)
        backs.append(back)
        # v_next = Xᵀu - alpha v, without its parts along all v
        v = clean(back)
        coupled = float(np.linalg.norm(v))
        if coupled <= EMPTY * scale or len(rights) + len(out) >= dims:
            v, coupled = fresh(), 0.0
        elif enough is not None and enough(_bidiagonal(alphas, betas), coupled):
            break
        else:
            v = clean(v / coupled)
    return np.array(rights).reshape(-1, dims), _bidiagonal(alphas, betas)


def principal(product, dims: int, scale: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values and right singular vectors (by rows) of X.

    Where they are settled to rounding before half of the dimensions are used up, a
    second run without them looks for one that the first start vector missed (a
    repeated value); if there is any, or if they settle late, all steps are made.
    """
    def settled(values: int, to: float):
        def enough(b: np.ndarray, coupled: float) -> bool:
            if len(b) % 8 or len(b) <= values or 2 * len(b) > dims:
                return False
            left, s, _ = np.linalg.svd(b)
            return bool((coupled * np.abs(left[-1, :values]) <= to * s[0]).all())
        return enough

    rights, b = bidiagonalise(product, dims, scale, settled(k, 1e-15))
    _, values, turned = np.linalg.svd(b)
    found = (turned @ rights)[:k]
    if len(rights) < dims:
        _, rest = bidiagonalise(product, dims, scale, settled(1, 1e-7), found, seed=2)
        if 2 * len(rest) > dims or np.linalg.svd(rest, compute_uv=False)[0] >= values[k - 1] * (1 - 1e-6):
            rights, b = bidiagonalise(product, dims, scale)
            _, values, turned = np.linalg.svd(b)
            found = (turned @ rights)[:k]
    return values[:k], found


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1)


def fit(distinct: DataFrame, dims: int, most: int, k: int = 16) -> Fit:
    """The components of ``distinct`` (x: arrays of ``dims`` longs, each once; ``most``: a bound for their number).

    Components whose eigenvalue is not above rounding (EMPTY squared, of the largest)
    do not exist: there are fewer than ``k`` where the vectors span fewer directions.
    """
    rows = Rows(distinct, dims, most)
    n, sums = rows.n, rows.sums
    squares = rows.squares()
    trace = float(squares.sum() / n)
    if trace <= 0:
        return Fit(n, sums, np.zeros((0, dims)), np.zeros(0), 0.0, 0.0, rows.products)
    values, components = principal(rows.product, dims, math.sqrt(squares.sum()), k)
    e = values * values / n
    there = np.flatnonzero(e > EMPTY * EMPTY * e[0])
    components, e = components[there], e[there]
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    error = np.abs(rows.gram((components / np.sqrt(e)[:, None]).T) / n - np.eye(len(e))).max(initial=0.0)
    return Fit(n, sums, components, e, trace, float(error), rows.products)


def whiten(vectors: DataFrame, k: int = 16, scale: int = 64) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for
    each vector and each of the first ``k`` components, by falling eigenvalue.

    Vectors that are null or hold a null or non-finite entry take no part, in the fit
    and the result. The fit takes each distinct vector once; rows that repeat a vec_id
    or a vector each have their rows in the result, a null vec_id stays null. Shorter
    vectors count as filled up with zeros, and vectors equal then are one. Entries with
    |scale * c| over 2^40 count as 2^40. A deviation beyond 64 bits is null. Directions
    in which the vectors do not differ give no component, so equal vectors only, one
    vector or an empty table give no row. Other columns are ignored.
    """
    data = shifted(vectors, scale)
    size = data.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    dims = size["d"] or 0
    data = data.select("vec_id", F.expr(f"concat(x, array_repeat({SHIFT}L, {dims} - size(x)))").alias("x"))
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    found = fit(data.select("x").distinct(), dims, size["n"], k) if dims else None
    if found is None or not len(found.eigenvalues):
        return data.sparkSession.createDataFrame([], schema)
    own = found  # at most k + 2 numbers a dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(own.eigenvalues)
        scaled = (own.components / np.sqrt(own.eigenvalues)[:, None]).T
        sums = np.array(own.sums, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(1), dims)
                y = centred(x, own.n, own.sums)
                bound = (float(np.abs(y).max(initial=0)) + 1) * own.n
                if bound < 1e9 and own.n * int(np.abs(x).max(initial=0)) < 1 << 62 and dims * bound * bound < 1 << 62:
                    d = own.n * x - sums.astype(np.int64)
                    deviation = pa.array(np.repeat((d * d).sum(axis=1), m))
                else:
                    exact = ((own.n * x.astype(object) - sums) ** 2).sum(axis=1).tolist()
                    deviation = pa.array([v if v < 1 << 63 else None for v in exact for _ in range(m)], pa.int64())
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(rows), m))),
                     pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)), pa.array(np.full(rows * m, own.n)), deviation,
                     pa.array((y @ scaled).ravel()), pa.array(np.tile(own.eigenvalues / own.trace, rows)),
                     pa.array(np.full(rows * m, own.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return data.mapInArrow(run, schema)
