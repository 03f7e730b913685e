"""Embedding whitening: leading eigenvectors of the covariance by block Jacobi-Davidson with distributed, matrix-free products.

Entries become integers, so sums, means and deviations are exact whatever the partitioning, and a vector is centred as
(n x - S) / n, one rounding. The distinct vectors are written once as blocks of 32-bit numbers. A product of the covariance with a
block of columns is one pass over them: every task adds up T'(T W) of its centred rows T, and the sums of the tasks are added
on Spark. The covariance itself is never formed.

The driver holds matrices of (dimensions x columns) only. One round: Rayleigh-Ritz on the subspace; pairs whose residual is at double
precision are locked and projected out; for the others the projected correction equations

    (I - Q Q') (V - e I) (I - Q Q') t = -r

are solved by a few MINRES steps, all columns in step so that a step is one pass; the solutions enlarge the subspace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialize, ship

ship(__name__)

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this do not fit the exact arithmetic.
LARGEST = 2.0**30
BLOCK = 4096
EPS = np.finfo(float).eps


def minres(product: Callable, values: np.ndarray, r: np.ndarray, basis: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Columns t with (P (V - e) P) t about -r, one value and one column of ``r`` each, P projecting out ``basis``.

    Lanczos recurrences of all columns run in step; a column that is solved to ``enough`` of its norm, or breaks down, stands still.
    """

    def project(m: np.ndarray) -> np.ndarray:
        return m - basis @ (basis.T @ m)

    v = project(-r)
    beta = np.linalg.norm(v, axis=0)
    t, w, older = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    before = np.zeros_like(v)
    going = beta > 0
    first, phi = beta.copy(), beta.copy()
    v = v / np.where(going, beta, 1)
    c, s, c_old, s_old, beta = np.ones_like(phi), np.zeros_like(phi), np.ones_like(phi), np.zeros_like(phi), np.zeros_like(phi)
    for _ in range(steps):
        if not going.any():
            break
        u = project(product(v) - v * values) - before * beta
        alpha = np.sum(v * u, axis=0)
        u = project(u - v * alpha)
        after = np.linalg.norm(u, axis=0)
        # Two old rotations on the new column of the tridiagonal matrix, then a new one.
        epsilon, middle = s_old * beta, c_old * beta
        delta, gamma = c * middle + s * alpha, c * alpha - s * middle
        rho = np.hypot(gamma, after)
        going &= rho > 0
        safe = np.where(going, rho, 1)
        c_old, s_old, c, s = c, s, gamma / safe, after / safe
        d = (v - w * delta - older * epsilon) / safe
        older, w = w, d
        t = t + np.where(going, c * phi, 0) * d
        phi = -s * phi
        going &= (np.abs(phi) > enough * first) & (after > EPS * np.abs(values).max())
        before, beta = v, after
        v = np.where(going, u / np.where(after > 0, after, 1), 0)
    return t


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns spanning what ``new`` adds to ``basis``; columns that add nothing are left out."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(3):
        new = new - basis @ (basis.T @ new)
        u, sizes, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, sizes > 1e-10 * max(sizes.max(initial=0), 1e-300)]
    return new[:, : max(basis.shape[0] - basis.shape[1], 0)]


def jacobi_davidson(product: Callable, d: int, k: int, steps: int = 4, rounds: int = 80, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric positive matrix given by its product with (d x columns), vectors, residual norms.

    The subspace starts with 2 k random columns and is cut back to k + 8 Ritz vectors beyond 4 k. A pair is locked when its residual is at
    most 8 eps sqrt(d) of the largest eigenvalue; the residuals returned are measured anew with the final vectors.
    """
    k = min(k, d)
    locked, locked_av = np.zeros((d, 0)), np.zeros((d, 0))
    space = orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, 2 * k))), locked)
    av = product(space)
    best, still = np.inf, 0
    for _ in range(rounds):
        inner = space.T @ av
        values, s = np.linalg.eigh((inner + inner.T) / 2)
        values, s = values[::-1], s[:, ::-1]
        want = k - locked.shape[1]
        space, av = space @ s, av @ s
        ritz, own = space[:, :want], values[:want]
        r = av[:, :want] - ritz * own
        r = r - locked @ (locked.T @ r)
        norms = np.linalg.norm(r, axis=0)
        top = max(values.max(initial=0), np.linalg.norm(locked_av, axis=0).max(initial=0))
        small = norms <= 8 * EPS * np.sqrt(d) * top
        # Only a leading run is locked, so that no smaller eigenvalue takes the place of one still missing.
        ready = int(np.argmin(small)) if not small.all() else len(small)
        locked, locked_av = np.hstack([locked, space[:, :ready]]), np.hstack([locked_av, av[:, :ready]])
        space, av = space[:, ready:], av[:, ready:]
        if locked.shape[1] >= k or not space.shape[1]:
            break
        rest = slice(ready, want)
        worst = norms[rest].max()
        still = still + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if still >= 6 and worst <= 1e-11 * top or locked.shape[1] + space.shape[1] >= d and still >= 2:
            break  # at the rounding of the products
        if space.shape[1] > max(4 * k - locked.shape[1], want + 8):
            space, av = space[:, : want - ready + 8], av[:, : want - ready + 8]
        n_open = want - ready
        t = minres(product, values[rest], r[:, rest], np.hstack([locked, space[:, :n_open]]), steps, 0.05)
        # A breakdown gives no direction; the residual itself is one.
        t = np.where(np.linalg.norm(t, axis=0) > 0, t, r[:, rest])
        more = orthonormal(t, np.hstack([locked, space]))
        if not more.shape[1]:
            more = orthonormal(np.random.default_rng(seed + locked.shape[1]).standard_normal((d, k)), np.hstack([locked, space]))
        if more.shape[1]:
            space, av = np.hstack([space, more]), np.hstack([av, product(more)])
    basis = np.hstack([locked, space])[:, :k]
    basis = np.linalg.qr(basis)[0]
    image = product(basis)
    inner = basis.T @ image
    values, s = np.linalg.eigh((inner + inner.T) / 2)
    values, s = values[::-1], s[:, ::-1]
    basis, image = basis @ s, image @ s
    return values, basis, np.linalg.norm(image - basis * values, axis=0)


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """floor(64 c) of all entries, the bounds of each vector in them, and whether it is sound."""
    lists = vectors.cast(pa.list_(pa.float64()))
    sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.asarray(lists.flatten().fill_null(np.nan), np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * flat)
        bad = ~(np.abs(scaled) < LARGEST)
    faults = np.concatenate([[0], np.cumsum(bad)])
    sound = (faults[bounds[1:]] == faults[bounds[:-1]]) & np.asarray(lists.is_valid()) & (sizes > 0)
    return np.where(bad, 0, scaled).astype("<i4"), bounds, sound


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, size, x): sound vectors as little-endian 32-bit floor(64 c). Others are left out."""
    schema = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, bounds, sound = whole_numbers(batch.column(1))
            at = np.flatnonzero(sound)
            raw = entries.tobytes()
            x = [raw[4 * a : 4 * b] for a, b in zip(bounds[at], bounds[at + 1], strict=True)]
            ids = batch.column(0).take(pa.array(at))
            size = pa.array((bounds[at + 1] - bounds[at]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids, size, pa.array(x, pa.binary())], schema=schema)

    return vectors.select(F.col(id_col).cast("long"), F.col(vec_col)).mapInArrow(run, "id long, size int, x binary")


def fit_blocks(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, as a written table of blocks (size, n, sums of the x, block)."""
    schema = pa.schema([("size", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[bytes]] = {}

        def block(size: int) -> pa.RecordBatch:
            own = waiting.pop(size)
            raw = b"".join(own)
            sums = np.frombuffer(raw, "<i4").reshape(-1, size).sum(0, dtype=np.int64) + SHIFT * len(own)
            return pa.RecordBatch.from_pylist([{"size": size, "n": len(own), "sums": sums.tolist(), "block": raw}], schema=schema)

        for batch in batches:
            for size, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = waiting.setdefault(size, [])
                own.append(x)
                # Bounded in rows and in bytes.
                if len(own) >= BLOCK or 4 * size * len(own) >= 8 << 20:
                    yield block(size)
        for size in sorted(waiting):
            yield block(size)

    distinct = rows.select("size", "x").distinct()
    return materialize(distinct.mapInArrow(run, "size int, n long, sums array<long>, block binary"), "fit")


def centred(block: bytes, size: int, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S of every vector of a block, exact."""
    x = np.frombuffer(block, "<i4").reshape(-1, size).astype(np.int64) + SHIFT
    return n * x - sums


class Covariance:
    """The covariance of the vectors of one size: products with blocks of columns, each one pass over the fit table."""

    def __init__(self, fit: DataFrame, size: int, n: int, sums: np.ndarray):
        self.fit, self.size, self.n, self.sums = fit.where(F.col("size") == size).select("block"), size, n, sums
        self.passes = 0

    def total(self, of: Callable[[np.ndarray], np.ndarray], cells: int) -> np.ndarray:
        """Sum over all blocks of ``of`` (centred vectors), an array of ``cells`` numbers, divided by n."""
        size, n, sums = self.size, self.n, self.sums
        schema = pa.schema([("cell", pa.int32()), ("value", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(cells)
            for batch in batches:
                for block in batch.column(0):
                    found += of(centred(block.as_buffer(), size, n, sums) / n).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(found)], schema=schema)

        self.passes += 1
        added = self.fit.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(cells)
        out[added["cell"].to_numpy()] = added["value"].to_numpy()
        return out / n

    def product(self, w: np.ndarray) -> np.ndarray:
        return self.total(lambda t: t.T @ (t @ w), w.size).reshape(w.shape)

    def trace(self) -> float:
        return float(self.total(lambda t: np.array([np.vdot(t, t)]), 1)[0])

    def whitened(self, w: np.ndarray) -> np.ndarray:
        """Covariance of the vectors projected on the columns of ``w``."""
        k = w.shape[1]
        return self.total(lambda t: (t @ w).T @ (t @ w), k * k).reshape(k, k)


class Model:
    """What whitens vectors of one size: n, S, projection (eigenvectors over the root of the eigenvalue), explained shares, checks."""

    def __init__(self, of: Covariance, components: int):
        self.size, self.n, self.sums = of.size, of.n, of.sums
        trace = of.trace()
        values, vectors, residuals = jacobi_davidson(of.product, of.size, components)
        # Directions without variance have no whitened coordinate.
        there = values > 64 * EPS * of.size * max(trace, 0)
        values, vectors, self.residuals = values[there], vectors[:, there], residuals[there]
        sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]) if len(values) else np.ones(0)
        self.values, self.vectors = values, vectors * sign
        self.projection = self.vectors / np.sqrt(values)
        self.explained = values / trace if trace > 0 else values
        k = len(values)
        self.identity_error = float(np.abs(of.whitened(self.projection) - np.eye(k)).max()) if k else 0.0
        self.passes = of.passes


def fit(rows: DataFrame, components: int = 16) -> dict[int, Model]:
    """A model for each length of vector among ``rows`` of :func:`integer_rows`."""
    blocks = fit_blocks(rows)
    sums = blocks.select("size", F.posexplode("sums").alias("at", "value")).groupBy("size", "at").agg(F.sum("value").alias("value"))
    counts = {r["size"]: r["n"] for r in blocks.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    found = {size: np.zeros(size, np.int64) for size in counts}
    for size, at, value in sums.collect():
        found[size][at] = value
    return {size: Model(Covariance(blocks, size, n, found[size]), components) for size, n in sorted(counts.items())}


def squares(deviation: np.ndarray) -> pa.Array:
    """Exact sum of squares of each row as a decimal; null beyond 38 digits."""
    largest = int(np.abs(deviation).max(initial=0))
    kind = pa.decimal128(38, 0)
    if largest * largest * max(deviation.shape[1], 1) < 2**62:
        return pa.array((deviation * deviation).sum(1)).cast(pa.decimal128(19, 0)).cast(kind)
    totals = [sum(v**2 for v in row) for row in deviation.tolist()]
    return pa.array([Decimal(v) if v < 10**38 else None for v in totals], kind)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 16) -> DataFrame:
    """Whitened coordinates of all sound vectors: one row for each vector and component, numbered from 1.

    Columns: the id, component, n (distinct vectors of this length), deviation (decimal; exact sum of (n x - S)^2), whitened, explained (share of
    the trace), identity_error (largest entry of the whitened covariance less the identity). x = floor(64 c) + 1000000.

    A vector that is null, empty, or holds a null, a NaN, an infinity or an entry of 2^24 or more in size gives no rows. Vectors of each length are
    fitted for themselves. Repeated vectors count once in the fit and are all returned; a null id stays null. Only components with variance are
    returned: fewer than asked where the dimensions or the distinct vectors are fewer, none where all vectors are equal. An empty
    table gives no rows; other columns are ignored. The order of equal eigenvalues is any.
    """
    rows = integer_rows(vectors, id_col, vec_col)
    models = {size: m for size, m in fit(rows, components).items() if len(m.values)}
    known = {size: (m.n, m.sums, m.projection, m.explained, m.identity_error) for size, m in models.items()}
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                if int(size) not in known:
                    continue
                n, sums, projection, explained, error = known[int(size)]
                own = batch.filter(pa.array(sizes == size))
                deviation = centred(b"".join(own.column(2).to_pylist()), int(size), n, sums)
                out = (deviation / n) @ projection
                rows, k = out.shape
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n)),
                        squares(deviation).take(each),
                        pa.array(out.ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    schema=schema,
                )

    ddl = f"`{id_col}` long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, ddl)
