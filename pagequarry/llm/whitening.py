"""Whitening of vectors by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance is never formed. A product with it is one pass over the stored
vectors: every task centres its vectors and returns the sum of what they add to
the product with a block of directions, and the partial sums are added up by Spark first, so
that at most PARTIALS small matrices reach the driver. The driver holds the search
subspace: (dimensions x directions) numbers, whatever the number of vectors.

Each round extracts Ritz pairs from the subspace, locks those whose residual is at
the level of rounding, and asks MINRES for an approximate solution of the projected
correction equation of each other wanted pair; all of them share their passes. The
corrections widen the subspace, which is cut back to its best directions when full.

Vectors that are null, empty or hold null or non-finite entries are left out, and so
are those whose length is not the most common one (ties: the longest). Equal rows count
each. A component without variance cannot be scaled and is left out, so vectors that
are all equal, and empty tables, give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.session import Workspace

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_BYTES = 1 << 20  # of whole numbers in a stored block
PARTIALS = 64
INNER = 4  # MINRES steps for each correction
ROUNDS = 200


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """vectors(vec_id, column) of the most common length, without nulls and non-finite entries."""
    kept = vectors.select("vec_id", F.col(column).cast("array<double>").alias("v"))
    kept = kept.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(F.forall("v", lambda c: c.isNotNull()))
    kept = kept.where(F.forall("v", lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = kept.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return kept.where(F.size("v") == (first["d"] if first else 0))


def _blocks(vectors: DataFrame) -> DataFrame:
    """Rows (ids, width, data): many vectors of whole numbers floor(SCALE * c) each, in the least width."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            if not batch.num_rows:
                continue
            flat = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            flat = np.floor(flat * SCALE)
            if np.abs(flat).max() >= 2.0**62:
                raise ValueError("an entry is too large for a whole number of 64 bits")
            step = max(1, BLOCK_BYTES // (8 * flat.shape[1]))
            for a in range(0, len(flat), step):
                part = flat[a : a + step].astype(np.int64)
                low, high = part.min(), part.max()
                width = next(w for w in (1, 2, 4, 8) if np.iinfo(f"i{w}").min <= low and high <= np.iinfo(f"i{w}").max)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("vec_id").slice(a, step).to_pylist()], pa.list_(pa.int64())),
                        pa.array([width], pa.int32()),
                        pa.array([part.astype(f"<i{width}").tobytes()], pa.binary()),
                    ],
                    names=["ids", "width", "data"],
                )

    return vectors.mapInArrow(packed, "ids array<long>, width int, data binary")


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    for batch in batches:
        for ids, width, data in zip(*batch.columns):
            numbers = np.frombuffer(data.as_buffer(), f"<i{width.as_py()}")
            yield ids, numbers.reshape(-1, d)


def _sum(blocks: DataFrame, partial, shape: tuple[int, ...], dtype: str) -> np.ndarray:
    """Sum over all blocks of arrays of one shape that ``partial`` makes of an iterator of batches.

    Tasks return one array each; these are summed in at most PARTIALS tasks, in a fixed order.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = partial(batches)
        yield pa.RecordBatch.from_arrays([pa.array([made.astype(dtype).tobytes()], pa.binary())], names=["data"])

    def added(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        total = np.zeros(shape, dtype)
        for row in rows.column("data"):
            total += np.frombuffer(row.as_buffer(), dtype).reshape(shape)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(own, "data binary").withColumn("part", F.spark_partition_id())
    group = F.pmod("part", F.lit(PARTIALS)).alias("key")
    summed = parts.select(group, "part", "data").groupBy("key").applyInArrow(added, "part int, data binary")
    total = np.zeros(shape, dtype)
    for row in sorted(summed.collect(), key=lambda r: r["part"]):
        total += np.frombuffer(row["data"], dtype).reshape(shape)
    return total


@dataclass(frozen=True)
class Centre:
    """Takes the mean off whole numbers: its whole part exactly, then the rest."""

    sums: np.ndarray
    n: int

    def __call__(self, y: np.ndarray) -> np.ndarray:
        whole, rest = np.divmod(self.sums, self.n)
        return (y - whole) - rest / self.n


class Covariance:
    """The covariance (divisor n) of stored whole-number vectors, as products only."""

    def __init__(self, blocks: DataFrame, d: int):
        self.blocks, self.d = blocks, d

        def sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(d + 1, np.int64)
            for _, y in _matrices(batches, d):
                if np.abs(y.sum(axis=0, dtype=float)).max(initial=0) + np.abs(out.astype(float)).max() >= 2.0**62:
                    raise ValueError("sums are too large for 64 bits")
                out[:d] += y.sum(axis=0, dtype=np.int64)
                out[d] += len(y)
            return out

        total = _sum(blocks, sums, (d + 1,), "<i8")
        self.n, self.sums = int(total[d]), total[:d]
        self.centred = Centre(self.sums, self.n)

    def times(self, u: np.ndarray) -> np.ndarray:
        centred, d = self.centred, self.d

        def product(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(u.shape)
            for _, y in _matrices(batches, d):
                c = centred(y)
                out += c.T @ (c @ u)
            return out

        return _sum(self.blocks, product, u.shape, "<f8") / self.n

    def trace(self) -> float:
        centred, d = self.centred, self.d

        def squares(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            return np.array([sum((centred(y) ** 2).sum() for _, y in _matrices(batches, d))], float)

        return float(_sum(self.blocks, squares, (1,), "<f8")[0]) / self.n


def _orthonormal(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Directions of ``new`` outside the span of ``old``, orthonormal to rounding."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        new = new - old @ (old.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 1e-12] / size[size > 1e-12]
        if not new.shape[1]:
            return new
        left, weight, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, weight > 1e-10 * weight[0]]
    new = new - old @ (old.T @ new)
    return np.linalg.qr(new)[0]


def minres(times, b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of A_j x_j = b_j, one symmetric operator a column, sharing products.

    ``times(v)`` applies to each column its operator. The residual norm falls in each step.
    """
    beta = np.linalg.norm(b, axis=0)
    alive = beta > 0
    v = np.where(alive, b / np.where(alive, beta, 1), 0)
    before, x = np.zeros_like(b), np.zeros_like(b)
    w, w_before = np.zeros_like(b), np.zeros_like(b)
    eta, b_k = beta.copy(), np.zeros_like(beta)
    c, s = np.ones((2, len(beta))), np.zeros((2, len(beta)))
    floor = 1e-14 * np.maximum(beta, 1e-300)
    for _ in range(steps):
        av = times(v)
        alpha = (v * av).sum(axis=0)
        nxt = av - alpha * v - b_k * before
        b_next = np.linalg.norm(nxt, axis=0)
        # two old Givens rotations on the new column of the tridiagonal matrix, then a new one
        delta = c[0] * alpha - c[1] * s[0] * b_k
        rho1 = np.hypot(delta, b_next)
        rho2 = s[0] * alpha + c[1] * c[0] * b_k
        rho3 = s[1] * b_k
        ok = alive & (rho1 > 0)
        safe = np.where(ok, rho1, 1)
        c_new, s_new = np.where(ok, delta / safe, 1), np.where(ok, b_next / safe, 0)
        w_new = np.where(ok, (v - rho3 * w_before - rho2 * w) / safe, 0)
        x = x + np.where(ok, c_new * eta, 0) * w_new
        eta = np.where(ok, -s_new * eta, 0)
        alive = ok & (b_next > floor)
        before, v = v, np.where(alive, nxt / np.where(b_next > 0, b_next, 1), 0)
        w_before, w, b_k = w, w_new, b_next
        c, s = np.stack([c_new, c[0]]), np.stack([s_new, s[0]])
        if not alive.any():
            break
    return x


def eigenpairs(times, d: int, k: int, seed: int = 1, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues (falling), their unit eigenvectors [d, k], the worst residual.

    ``times`` multiplies the symmetric operator with a [d, m] block. Residuals are at
    the level of rounding, d * 2^-52 of the largest eigenvalue, when this returns.
    """
    k = min(k, d)
    most = min(d, 4 * k + 8)
    w = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(d, k + 8))))[0]
    vw = times(w)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    scale, worst = 0.0, 0.0
    for _ in range(ROUNDS):
        theta, y = np.linalg.eigh((w.T @ vw + vw.T @ w) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        w, vw = w @ y, vw @ y
        scale = max(scale, float(theta[0]), float(values.max(initial=0.0)))
        left = k - len(values)
        r = vw[:, :left] - w[:, :left] * theta[:left]
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        whole = w.shape[1] + len(values) == d  # the subspace is everything: only rounding is left
        done = size <= d * 2.0**-52 * max(scale, 1e-300) * (16 if whole else 1)
        # pairs are locked in falling order, so that no larger one is missed
        count = int(np.argmin(done)) if not done.all() else left
        worst = max(worst, float(size[:count].max(initial=0.0)))
        locked, values = np.hstack([locked, w[:, :count]]), np.r_[values, theta[:count]]
        w, vw, theta, r, left = w[:, count:], vw[:, count:], theta[count:], r[:, count:], left - count
        if not left:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order], worst
        if w.shape[1] + left > most - len(values):
            keep = max(left + 8, (most - len(values)) // 2)
            if w.shape[1] > keep and most < d:
                w, vw = w[:, :keep], vw[:, :keep]
        fixed = np.hstack([locked, w[:, :left]])

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - fixed @ (fixed.T @ t)
            t = times(t) - t * theta[:left]
            return t - fixed @ (fixed.T @ t)

        t = minres(projected, -(r - fixed @ (fixed.T @ r)), inner)
        t = _orthonormal(np.hstack([t, r]) if whole else t, np.hstack([locked, w]))
        if not t.shape[1]:
            if whole:  # a fresh product, since sums of old ones have collected rounding
                w = np.linalg.qr(w - locked @ (locked.T @ w))[0]
                vw = times(w)
                continue
            t = _orthonormal(np.random.default_rng(seed + len(values)).standard_normal((d, left)), np.hstack([locked, w]))
        w, vw = np.hstack([w, t]), np.hstack([vw, times(t)])
    raise ArithmeticError(f"{left} of {k} eigenpairs have not converged in {ROUNDS} rounds")


def whitened(
    vectors: DataFrame, ws: Workspace, column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row for each usable vector and component, see the fields at the end.

    ``deviation`` is the exact sum of (n * x - S)^2; one that 64 bits cannot hold is an error.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    blocks = ws.save(_blocks(usable(vectors, column)), "blocks")
    first = blocks.select(F.size("ids").alias("rows"), "width", F.length("data").alias("bytes")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d = first["bytes"] // (first["rows"] * first["width"])
    cov = Covariance(blocks, d)
    trace = cov.trace()
    values, directions = np.zeros(0), np.zeros((d, 0))
    if trace > 0:
        values, directions, _ = eigenpairs(cov.times, d, components)
    kept = values > d * 2.0**-50 * max(float(values.max(initial=0.0)), 0.0)
    values, directions = values[kept], directions[:, kept]
    # the same sign for all rows and runs: the entry of largest size is positive
    if len(values):
        directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    axes = directions / np.sqrt(values)
    k, n, sums, centred = len(values), cov.n, cov.sums, cov.centred
    explained = values / trace if trace > 0 else values

    def means(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum(((centred(y) @ axes).sum(axis=0) for _, y in _matrices(batches, d)), np.zeros(k))

    centre = _sum(blocks, means, (k,), "<f8") / n

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k, k))
        for _, y in _matrices(batches, d):
            white = centred(y) @ axes - centre
            out += white.T @ white
        return out

    identity = _sum(blocks, products, (k, k), "<f8") / n
    error = float(np.abs(identity - np.eye(k)).max(initial=0.0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _matrices(batches, d):
            for a in range(0, len(y) if k else 0, 1024):
                part = y[a : a + 1024].astype(np.int64)
                if n * float(np.abs(part).max()) + np.abs(sums.astype(float)).max() >= 2.0**62:
                    raise ValueError("a deviation is too large for 64 bits")
                off = n * part - sums  # SHIFT cancels out
                if (off.astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
                    raise ValueError("a deviation is too large for 64 bits")
                many = len(part)
                named = pa.array(ids.as_py()[a : a + many], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        named.take(pa.array(np.repeat(np.arange(many), k))),
                        pa.array(np.tile(np.arange(1, k + 1), many), pa.int32()),
                        pa.array(np.full(many * k, n)),
                        pa.array(np.repeat((off * off).sum(axis=1), k)),
                        pa.array((centred(part) @ axes).ravel()),
                        pa.array(np.tile(explained, many)),
                        pa.array(np.full(many * k, error)),
                    ],
                    names=[field.split()[0] for field in schema.split(", ")],
                )

    return blocks.mapInArrow(rows, schema)
