"""Embedding whitening by Jacobi-Davidson over distributed, matrix-free covariance products.

Every entry c of a vector becomes the integer x = floor(64 c) + 1000000. The covariance V of the
x-vectors (divisor n) is never formed: a product V q is a job in which every task centres its
vectors ((n x - S) / n, the numerator exact), multiplies twice and adds up. Jacobi-Davidson finds
the leading eigenpairs: Rayleigh-Ritz on a small subspace; for every pair that isn't converged the
projected correction equation is solved by a few steps of MINRES (all pairs in step, so a step is
one job); the corrections widen the subspace, which restarts from its best Ritz vectors when full;
converged pairs are locked and projected out, until all residuals are at rounding level. The
driver holds arrays of dimensions x subspace, whatever the number of vectors.

Defined results: rows whose vector is null or holds null or non-finite entries go, and so do
those whose length isn't the table's (the most frequent one, the longer in ties; empty vectors
have no entries and only count where all are empty). Repeated rows and null ids stay. Components
whose eigenvalue is zero to double precision can't be whitened and aren't returned, so constant
vectors, a single row and an empty table give no rows. Equal eigenvalues take any orthonormal
basis. A deviation that no long can hold is null. Extra columns don't matter. Entries beyond
2**43 can't be centred exactly and raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frontier.session import cut_lineage

from . import kernels as K

#: Components, vectors in a packed row, MINRES steps of a correction, and most rounds.
COMPONENTS, PACK, INNER_STEPS, MAX_ROUNDS = 32, 2048, 8, 200
#: A residual at rounding level, as a share of the largest eigenvalue.
TOLERANCE = 128 * np.finfo(float).eps
SCALE, SHIFT = 64, 1_000_000


class Vectors:
    """Integer vectors, packed by thousands into the rows of a written table, and their sums."""

    def __init__(self, rows: DataFrame, id_col: str, vector_col: str):
        spark = rows.sparkSession
        self.spark = spark
        self.id_kind = rows.schema[id_col].dataType.simpleString()
        entry = F.col("v").cast("array<double>")
        sound = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(
            F.col("v").isNotNull() & F.forall(F.col("v"), lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf), F.lit(False))))
        lengths = sound.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), F.desc("d")).first()
        self.dims = lengths["d"] if lengths else 0
        self.packed = cut_lineage(sound.where(F.size("v") == self.dims).select("id", entry.alias("v")).mapInArrow(
            _packer(self.dims), f"ids array<{self.id_kind}>, x binary"))
        self.n, self.total = self._sums()
        #: rows of partial sums are added up by this many tasks before the driver sees them
        self.adders = max(1, math.isqrt(self.packed.rdd.getNumPartitions()))

    def _sums(self) -> tuple[int, np.ndarray]:
        dims = self.dims

        def run(batches):
            n, total = 0, np.zeros(dims, np.int64)
            for x in _unpacked(batches, dims):
                n, total = n + len(x), total + x.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "s"])

        if not dims:
            return 0, np.zeros(0, np.int64)
        parts = self.packed.select("x").mapInArrow(run, "n bigint, s array<bigint>")
        sums = parts.agg(F.sum("n"), *[F.sum(F.col("s")[j]) for j in range(dims)]).first()
        n, total = sums[0] or 0, np.array([s or 0 for s in sums[1:]], np.int64)
        if n and 2.0 * n * np.abs(total / n).max() >= 2.0**62:
            raise ArithmeticError("vectors can't be centred in longs")
        return n, total

    def add_up(self, part, shape: tuple[int, ...]) -> np.ndarray:
        """Sum over all vectors of ``part(centred)``, an array of ``shape`` for rows of centred vectors."""
        dims, n, total, adders, size = self.dims, self.n, self.total, self.adders, math.prod(shape)

        def run(batches):
            out = np.zeros(shape)
            for x in _unpacked(batches, dims):
                out += part((n * x - total) / n)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["s"])

        def add(batches):
            out = np.zeros(size)
            for batch in batches:
                for s in batch.column(0):
                    out += np.frombuffer(s.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["s"])

        sums = self.packed.select("x").mapInArrow(run, "s binary")
        if adders > 1:
            sums = sums.repartition(adders).mapInArrow(add, "s binary")
        return np.sum([np.frombuffer(bytes(r.s)).reshape(shape) for r in sums.collect()], axis=0)

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        """V q for the columns of ``q``, in one job."""
        return self.add_up(lambda d: d.T @ (d @ q), q.shape) / self.n

    def trace(self) -> float:
        return float(self.add_up(lambda d: (d * d).sum(keepdims=True).reshape(1), (1,))[0] / self.n)


def _packer(dims: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PACK):
                part = batch.slice(at, PACK)
                c = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                if c.size and np.abs(c).max() >= 2.0**43:
                    raise ArithmeticError("an entry is too large to be centred in longs")
                x = np.floor(c * SCALE).astype(np.int64) + SHIFT
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)), pa.array([x.tobytes()], pa.binary())],
                                                 names=["ids", "x"])
    return run


def _unpacked(batches, dims: int):
    for batch in batches:
        for x in batch.column(batch.schema.get_field_index("x")):
            yield np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dims)


def _widened(basis: np.ndarray, fixed: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``more`` that ``basis`` and ``fixed`` don't have."""
    out = np.zeros((len(more), 0))
    for t in more.T:
        size = np.linalg.norm(t)
        if not size > 0 or fixed.shape[1] + basis.shape[1] + out.shape[1] >= len(more):
            continue
        t = t / size
        for _ in range(3):
            for space in (fixed, basis, out):
                t = t - space @ (space.T @ t)
            size = np.linalg.norm(t)
            if size < 1e-8:
                break
            t = t / size
        else:
            out = np.column_stack([out, t])
    return out


def minres(times, theta: np.ndarray, held: np.ndarray, ritz: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of P (V - theta) P t = rhs, one for every column, by ``steps`` of
    MINRES (Paige and Saunders), where P projects ``held`` and the column's Ritz vector out; a
    step is one product for all columns."""
    def project(x):
        x = x - held @ (held.T @ x)
        x = x - ritz * (ritz * x).sum(axis=0)
        return x - held @ (held.T @ x)

    safe = lambda x: np.where(x > 0, x, 1.0)
    v = project(rhs)
    beta = np.linalg.norm(v, axis=0)
    v, before = v / safe(beta), np.zeros_like(v)
    t, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    eta, beta = beta, np.zeros_like(beta)
    c, c_before, s, s_before = (np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta))
    for _ in range(steps):
        a = project(times(v) - theta * v)
        alpha = (v * a).sum(axis=0)
        new = project(a - alpha * v - beta * before)
        beta_new = np.linalg.norm(new, axis=0)
        # QR of the tridiagonal matrix by Givens rotations
        delta = c * alpha - c_before * s * beta
        rho = safe(np.hypot(delta, beta_new))
        r2, r3 = s * alpha + c_before * c * beta, s_before * beta
        w_new = (v - r3 * w_before - r2 * w) / rho
        c_before, s_before = c, s
        c, s = delta / rho, beta_new / rho
        t = t + c * eta * w_new
        eta = -s * eta
        live = beta_new > 1e-14 * rho
        eta = np.where(live, eta, 0.0)
        w_before, w = w, w_new
        before, v, beta = v, np.where(live, new / safe(beta_new), 0.0), np.where(live, beta_new, 0.0)
    return t


def leading_pairs(times, dims: int, wanted: int, max_space: int | None = None, inner: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of the symmetric operator ``times`` (block of columns
    to block of columns), falling, and their unit eigenvectors as columns."""
    wanted = min(wanted, dims)
    if not wanted:
        return np.zeros(0), np.zeros((dims, 0))
    max_space = min(dims, max_space or 3 * wanted + 8)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    basis = _widened(np.zeros((dims, 0)), locked, np.random.default_rng(0).standard_normal((dims, min(max_space, wanted + 4))))
    image = times(basis)
    top, refreshed = 0.0, False
    for _ in range(MAX_ROUNDS):
        theta, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        open_ = wanted - locked.shape[1]
        ritz, at = basis @ y, image @ y
        rest = at - ritz * theta
        rest -= locked @ (locked.T @ rest)
        sizes = np.linalg.norm(rest, axis=0)
        top = max(top, float(np.abs(theta).max()), float(np.abs(values).max()) if len(values) else 0.0)
        good = sizes <= TOLERANCE * max(top, np.finfo(float).tiny)
        done = min(open_, int(np.argmin(good)) if not good.all() else len(good))
        full = locked.shape[1] + basis.shape[1] >= dims
        if not done and full and refreshed:
            raise ArithmeticError(f"residual {sizes[:open_].max():.3g} of the eigenvalue {top:.3g} doesn't fall")
        if done:
            locked, values = np.column_stack([locked, ritz[:, :done]]), np.concatenate([values, theta[:done]])
            if locked.shape[1] >= wanted:
                break
            # the rest of the subspace goes on without the locked pairs
            basis = _widened(np.zeros((dims, 0)), locked, ritz[:, done:])
            image = times(basis) if basis.shape[1] else np.zeros((dims, 0))
            refreshed = False
            if basis.shape[1]:
                continue
        if full and basis.shape[1]:
            # the subspace is complete: what is left is rounding in the basis and its image
            basis = _widened(np.zeros((dims, 0)), locked, ritz)
            image, refreshed = times(basis), True
            continue
        if not basis.shape[1]:
            basis = _widened(basis, locked, np.random.default_rng(locked.shape[1]).standard_normal((dims, open_ + 4)))
            image = times(basis)
            continue
        work = np.flatnonzero(~good[:open_])
        t = minres(times, theta[work], locked, ritz[:, work], -rest[:, work], inner)
        if basis.shape[1] + len(work) > max_space:
            keep = max(1, min(max_space - len(work), open_ + 4, basis.shape[1]))
            basis, image = ritz[:, :keep], at[:, :keep]
        new = _widened(basis, locked, np.column_stack([t, rest[:, work]]))[:, :max(1, max_space - basis.shape[1])]
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, times(new)])
        else:
            basis = _widened(np.zeros((dims, 0)), locked, np.column_stack([ritz, np.random.default_rng(0).standard_normal((dims, 4))]))
            image = times(basis)
    else:
        raise ArithmeticError("eigenpairs don't converge")
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: ``id_col``, ``component``, ``n``, ``deviation`` (exact
    sum of squares of n x - S), ``whitened``, ``explained`` and ``identity_error``."""
    K.bounded_batches(rows.sparkSession)
    vectors = Vectors(rows, id_col, vector_col)
    dims, n, total = vectors.dims, vectors.n, vectors.total
    values, axes, explained, error = np.zeros(0), np.zeros((dims, 0)), np.zeros(0), 0.0
    if n and dims:
        trace = vectors.trace()
        if trace > 0:
            values, axes = leading_pairs(vectors.covariance_times, dims, components)
            rank = int((values > dims * np.finfo(float).eps * values[0]).sum())
            values, axes, explained = values[:rank], axes[:, :rank], values[:rank] / trace
    axes = axes / np.sqrt(values)
    k = len(values)
    if k:
        mean = vectors.add_up(lambda d: (d @ axes).sum(axis=0), (k,)) / n
        spread = vectors.add_up(lambda d: (d @ axes - mean).T @ (d @ axes - mean), (k, k)) / n
        error = float(np.abs(spread - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            for ids, x in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dims)
                m, off = len(x), n * x - total
                sure = (off.astype(float) ** 2).sum(axis=1) < 2.0**62
                deviation = pa.array((off * off).sum(axis=1), pa.int64(), mask=np.repeat(~sure, 1))
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation.take(each),
                     pa.array(((off / n) @ axes).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return (vectors.packed if k else vectors.packed.where("false")).mapInArrow(
        run, f"`{id_col}` {vectors.id_kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
