"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

A step multiplies the centred rows X by one vector and the product by Xᵀ in the same pass over the table. The left
vectors u = Xw are never stored: each has its w (as long as a row), so a pass finds the overlaps of a new u with all
earlier ones, and the correction is applied to w. Both sides are reorthogonalised in full. The driver keeps vectors as
long as a row and a small bidiagonal matrix, whose singular values and vectors give deviations and components.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfields.session import materialise

#: A component counts as found when its residual is below this share of the largest singular value.
TOLERANCE = 1e-14
#: A singular value below this share of the largest is none: its direction has no spread.
RANK = 1e-12
#: Rows that a task multiplies at once.
BLOCK = 4_096
#: Partial sums that the driver adds up; more are first added by tasks.
SUMS = 64
SEED = 20_240_607


def quantised(vectors: DataFrame, vector: str = "embedding", step: int = 256) -> DataFrame:
    """``vectors`` whose entries are all finite, with ``_x`` = floor(step * entry) as whole numbers.

    Null vectors and those with null or non-finite entries go. An entry whose product is no exact whole number of a double
    (2^53 or more) is an error.
    """
    def whole(c):
        return F.when(F.abs(c * F.lit(float(step))) < 2.0**53, F.floor(c * F.lit(float(step))).cast("long")).otherwise(
            F.raise_error(F.lit("an entry is too large")).cast("long"))

    double = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(double, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~bad).withColumn("_x", F.transform(double, whole))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, parts: int, work, size: int) -> np.ndarray:
    """Sum of the arrays of ``size`` doubles that ``work(batch)`` gives, over all ``parts`` partitions."""
    def partial(batches):
        total = np.zeros(size)
        for batch in batches:
            total += work(batch)
        from pyspark import TaskContext

        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def merged(batches):
        found = sorted((p, s) for b in batches for p, s in zip(b.column("part").to_pylist(), b.column("sums").to_pylist(), strict=True))
        if found:
            total = np.sum([np.frombuffer(s) for _, s in found], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([found[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    sums = rows.mapInArrow(partial, "part long, sums binary")
    while parts > SUMS:
        parts = -(-parts // SUMS)
        sums = sums.repartition(parts, F.floor(F.col("part") / SUMS)).mapInArrow(merged, "part long, sums binary")
    found = sorted((r.part, bytes(r.sums)) for r in sums.collect())
    return np.sum([np.frombuffer(s) for _, s in found], axis=0) if found else np.zeros(size)


class Rows:
    """The distinct vectors, centred block by block as they are multiplied."""

    def __init__(self, fit: DataFrame, n: int, sums: np.ndarray):
        self.fit, self.n, self.sums, self.d = fit, n, sums, len(sums)
        self.parts, self.passes = fit.rdd.getNumPartitions(), 0

    def _blocks(self):
        n, s = self.n, self.sums  # what is sent to tasks

        def blocks(batch):
            x = _matrix(batch.column("_x"), len(s))
            for at in range(0, len(x), BLOCK):
                yield (n * x[at : at + BLOCK] - s) / n

        return blocks

    def products(self, left: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For u = Xw: the overlaps with X times each column of ``left``, u's squared length, and Xᵀu."""
        k, d = left.shape[1], self.d
        blocks, both = self._blocks(), np.column_stack([left, w])

        def work(batch):
            out = np.zeros(k + 1 + d)
            for x in blocks(batch):
                u = x @ both
                out[: k + 1] += u.T @ u[:, k]
                out[k + 1 :] += x.T @ u[:, k]
            return out

        self.passes += 1
        out = _summed(self.fit, self.parts, work, k + 1 + d)
        return out[:k], float(out[k]), out[k + 1 :]

    def moments(self, components: np.ndarray) -> np.ndarray:
        """Covariance (divisor n) of the centred rows times ``components``."""
        k, blocks = components.shape[1], self._blocks()

        def work(batch):
            out = np.zeros((k + 1, k))
            for x in blocks(batch):
                y = x @ components
                out[:k] += y.T @ y
                out[k] += y.sum(axis=0)
            return out.ravel()

        out = _summed(self.fit, self.parts, work, (k + 1) * k).reshape(k + 1, k) / self.n
        return out[:k] - np.outer(out[k], out[k])

    def spread(self) -> float:
        """Trace of the covariance."""
        blocks = self._blocks()
        return float(_summed(self.fit, self.parts, lambda batch: np.array([sum((x * x).sum() for x in blocks(batch))]), 1)[0]) / self.n


@dataclass
class Lanczos:
    """X V = U B with orthonormal V (``right``), U (as ``left``: U = X left) and upper bidiagonal B."""

    rows: Rows
    away: np.ndarray  # directions that are left out, as orthonormal columns
    alpha: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)

    def __post_init__(self):
        d = self.rows.d
        self.right, self.left, self.back = (np.zeros((d, 0)) for _ in range(3))
        self.random = np.random.default_rng(SEED + self.away.shape[1])
        self.next = self._apart(self.random.standard_normal(d))
        self.next /= np.linalg.norm(self.next)

    def _apart(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.away @ (self.away.T @ v)
            v = v - self.right @ (self.right.T @ v)
        return v

    def step(self) -> float:
        """Add a left and a right vector; the length of what is left over for the next right one."""
        v = self.next
        w = v.copy()
        while True:
            overlap, square, z = self.rows.products(self.left, w)
            kept = square - overlap @ overlap
            w, z = w - self.left @ overlap, z - self.back @ overlap
            if kept >= 0.5 * square or square == 0:
                break
            if square <= (1e-15 * max(self.alpha, default=0.0)) ** 2:
                kept = 0.0
                break
        a = float(np.sqrt(max(kept, 0.0)))
        if a > RANK * max([a, *self.alpha]):
            w, z = w / a, z / a
        else:  # this direction has no spread of its own
            a, w, z = 0.0, np.zeros_like(w), np.zeros_like(z)
        self.right = np.column_stack([self.right, v])
        self.left, self.back = np.column_stack([self.left, w]), np.column_stack([self.back, z])
        self.alpha.append(a)
        rest = self._apart(z)
        b = float(np.linalg.norm(rest))
        if b <= TOLERANCE * max(self.alpha):
            # The vectors so far are closed under X: go on from a fresh direction, if there is one.
            b = 0.0
            rest = self._apart(self.random.standard_normal(len(v)))
            rest = rest if np.linalg.norm(rest) > 1e-8 else np.zeros_like(rest)
        self.beta.append(b)
        self.next = rest / (np.linalg.norm(rest) or 1.0)
        return b

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right vectors and residuals, by falling value."""
        b = np.diag(self.alpha) + np.diag(self.beta[:-1], 1)
        p, s, q = np.linalg.svd(b)
        return s, self.right @ q.T, self.beta[-1] * np.abs(p[-1])

    def run(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``wanted`` largest singular values and their right vectors, as far as there are any."""
        room = self.rows.d - self.away.shape[1]
        while len(self.alpha) < room:
            self.step()
            s, v, residual = self.found()
            if len(s) > wanted and (residual[:wanted] <= TOLERANCE * s[0]).all():
                break
        return s[:wanted], v[:, :wanted]


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with ``sums``, unit ``components`` (columns, by falling spread) and their ``variances``."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int = 0


def fit(vectors: DataFrame, components: int = 4, vector: str = "embedding", step: int = 256) -> Whitening | None:
    """Components of the distinct quantised vectors; None where there is no vector.

    Vectors must be of one length (else an error). Only directions with spread have components, so there may be fewer
    than asked for. A start vector can miss the second of two equal deviations, so runs are repeated away from what is
    found until a run finds nothing larger than the least of the components.
    """
    x = materialise(quantised(vectors, vector, step).select("_x").distinct(), "vectors")
    about = x.agg(F.count(F.lit(1)), F.min(F.size("_x")), F.max(F.size("_x"))).first()
    n, shortest, d = about
    if not n or not d:
        return None
    if shortest != d:
        raise ValueError(f"vectors of {shortest} and of {d} entries")
    sums = np.array([r.s for r in x.select(F.posexplode("_x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).orderBy("i").collect()], dtype=np.int64)
    rows = Rows(x, n, sums)
    trace = rows.spread()
    s, v = np.zeros(0), np.zeros((d, 0))
    while trace and v.shape[1] < d:
        more, w = Lanczos(rows, v).run(1 if len(s) else components)
        larger = len(s) < components or more[0] > s[components - 1] * (1 + 1e-9)
        s, v = np.concatenate([s, more]), np.column_stack([v, w])
        order = np.argsort(-s, kind="stable")
        s, v = s[order], v[:, order]
        if not larger:
            break
    keep = np.flatnonzero(s[:components] > RANK * s[0]) if trace else np.zeros(0, dtype=int)
    v = np.linalg.qr(v[:, keep])[0] if len(keep) else v[:, keep]
    variances = s[keep] ** 2 / n
    whitened = v / np.sqrt(variances) if len(keep) else v
    error = float(np.abs(rows.moments(whitened) - np.eye(len(keep))).max()) if len(keep) else 0.0
    return Whitening(n, sums, v, variances, variances / (trace or 1.0), error, rows.passes)


def whiten(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding", step: int = 256) -> DataFrame:
    """For each row that ``quantised`` keeps and each component: ``key, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is the sum over entries of (n * x - sum)², exact; one beyond 64 bits is an error. Null and repeated
    keys stay as they are. Other columns are not read. No rows where no direction has spread (an empty table, or a
    single distinct vector).
    """
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums, k, d = model.n, model.sums, len(model.variances), len(model.sums)
    scaled = model.components / np.sqrt(model.variances)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("_x"), d)
            for at in range(0, len(x), BLOCK):
                rough = ((n * x[at : at + BLOCK].astype(float) - sums) ** 2).sum(axis=1)
                if len(rough) and rough.max() >= 2.0**63:
                    raise OverflowError("a deviation does not fit 64 bits")
                off = n * x[at : at + BLOCK] - sums
                m = len(off)
                white = (off / n) @ scaled
                each = lambda values: pa.array(np.repeat(values, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(at, m).take(each(np.arange(m))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     each(np.full(m, n, dtype=np.int64)), each(np.einsum("ij,ij->i", off, off)), pa.array(white.ravel()),
                     pa.array(np.tile(model.explained, m)), each(np.full(m, model.identity_error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = quantised(vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")), "_vector", step).select("_key", "_x")
    return rows.mapInArrow(run, schema)
