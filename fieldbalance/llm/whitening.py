"""Whitening of embeddings by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.llm.common import stored, table

#: Components beyond this magnitude would leave the range in which integers stay exact.
LARGEST = 2.0 ** 30
COMPONENTS = 8
#: Columns iterated beside the wanted ones, and degree of the filter polynomial.
SPARE, DEGREE = 24, 16


class Fit(NamedTuple):
    n: int
    sums: list           # exact sum of every dimension
    values: object       # eigenvalues, falling
    vectors: object      # a unit column per eigenvalue
    trace: float
    residual: float      # largest |V q - e q| of the wanted pairs, over the largest eigenvalue


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(vec_id, x): components as floor(scale * c) + shift.

    Vectors that are null or empty, hold null, non-finite or larger components than
    LARGEST, or have another length than most (ties: the longer) take no part. Rows
    without an id and repeated ids are rows like others; other columns are not read.
    """
    v = F.col(vector)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST))
    kept = (df.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_column).alias("vec_id"), F.transform(
                v, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift)).alias("x")))
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).agg(
        F.max(F.struct("n", "d"))["d"].alias("d"))
    width = lengths.first()[0]
    return kept.where(F.size("x") == (width or 0))


def _matrices(batches):
    import numpy as np
    for batch in batches:
        rows = batch.column("x")
        if len(rows):
            yield batch, rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), -1)


def _centred(x, whole, rest):
    """x minus the mean: the integer part of the mean leaves exactly, the rest is one rounding."""
    return (x - whole) - rest


def _summed(vectors: DataFrame, cells: int, work: Callable):
    """Sum over all tasks of the array of ``cells`` doubles that ``work`` makes of a matrix of rows."""
    import numpy as np

    def run(batches):
        import pyarrow as pa
        total = np.zeros(cells)
        for _, x in _matrices(batches):
            total += work(x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], ["cell", "value"])

    got = (vectors.select("x").mapInArrow(run, "cell long, value double").groupBy("cell")
           .agg(F.sum("value").alias("value")).toPandas())
    out = np.zeros(cells)
    out[got["cell"]] = got["value"]
    return out


def _moments(vectors: DataFrame) -> tuple[int, list[int]]:
    """Rows and the exact sum of every dimension."""
    import numpy as np

    def run(batches):
        import pyarrow as pa
        for _, x in _matrices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1])), pa.array(x.sum(axis=0)),
                                              pa.array(np.full(x.shape[1], len(x)))], ["i", "s", "n"])

    got = (vectors.select("x").mapInArrow(run, "i long, s long, n long").groupBy("i")
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    return (got[0]["n"], [r["s"] for r in got]) if got else (0, [])


def fit(vectors: DataFrame, components: int = COMPONENTS, *, spare: int = SPARE, degree: int = DEGREE,
        rounds: int = 200, tolerance: float = 1e-12, seed: int = 7) -> Fit | None:
    """Largest eigenpairs of the covariance (divisor n) of ``x``; None without rows.

    A block of ``components + spare`` columns is filtered by a Chebyshev polynomial that
    stays within 1 on the unwanted part of the spectrum, from 0 (a covariance has no
    less) to the smallest Ritz value of the block, and grows fast above it. Each step
    of its recurrence is one pass over all rows, which sums centred XᵀXQ in the tasks.
    QR and Rayleigh-Ritz follow. The pairs are certified when every wanted residual is
    below ``tolerance`` times the largest value and a further round no longer halves
    it; without that after ``rounds`` it raises. What the driver holds is the block.
    """
    import numpy as np
    n, sums = _moments(vectors)
    if not n:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    d = len(sums)
    k = min(d, components + spare)
    trace = float(_summed(vectors, 1, lambda x: np.square(_centred(x, whole, rest)).sum())[0]) / n
    if trace == 0:
        return Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0)

    def covariance(q):
        def work(x):
            y = _centred(x, whole, rest)
            return y.T @ (y @ q)
        return _summed(vectors, q.size, work).reshape(q.shape) / n

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, k)))[0]
    last = np.inf
    for _ in range(rounds):
        image = covariance(q)
        values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        wanted = slice(0, min(components, k))
        residual = float(np.linalg.norm(image - q * values, axis=0)[wanted].max() / values[0])
        if residual <= tolerance and (k == d or residual > last / 2 or residual < 1e-15):
            keep = [i for i in range(min(components, k)) if values[i] > 1e-12 * values[0]]
            vectors_ = q[:, keep]
            signs = np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(len(keep))])
            return Fit(n, sums, values[keep], vectors_ * signs, trace, residual)
        last = residual
        edge = max(float(values[-1]), 1e-9 * float(values[0]))
        q = np.linalg.qr(_filtered(covariance, q, image, edge, float(values[0]), degree))[0]
    raise RuntimeError(f"eigenpairs not certified after {rounds} rounds: residual {last:.1e}")


def _filtered(covariance: Callable, q, image, edge: float, top: float, degree: int):
    """The scaled Chebyshev recurrence on [0, edge], 1 at ``top``; ``image`` is V q already."""
    centre = half = edge / 2
    first = half / (top - centre)
    sigma = first
    before, now = q, (image - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (covariance(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def whitened(vectors: DataFrame, found: Fit) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row and component.

    deviation is the exact sum of (n x - S)², null where it passes 64 bits. Components
    whose eigenvalue is 0 have no rows: vectors that do not vary give none.
    """
    import numpy as np
    n, sums, values, q, trace, _ = found
    whole = np.array([s // n for s in sums], np.int64)
    rest_int = [s % n for s in sums]
    rest = np.array([r / n for r in rest_int])
    scaled = q / np.sqrt(values)
    m = len(values)

    def products(x):
        w = _centred(x, whole, rest) @ scaled
        return w.T @ w

    error = 0.0
    if m:
        error = float(np.abs(_summed(vectors, m * m, products).reshape(m, m) / n - np.eye(m)).max())
    explained = values / trace if m else values

    def deviations(x):
        apart = x - whole
        if (float(np.abs(apart).max(initial=0)) + 1) ** 2 * float(n) ** 2 * x.shape[1] < 2.0 ** 62:
            return np.square(apart * n - np.array(rest_int, np.int64)).sum(axis=1).tolist()
        exact = [sum((n * v - r) ** 2 for v, r in zip(row, rest_int)) for row in apart.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]

    def run(batches):
        import pyarrow as pa
        for batch, x in _matrices(batches):
            w = _centred(x, whole, rest) @ scaled
            each = np.repeat(np.arange(len(x)), m)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), n)), pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every usable row of a table of vectors, whitened along its largest components.

    The integers are stored once; every pass reads them there. An empty table gives no rows.
    """
    vectors = stored(integer_vectors(df, id_column, vector), "op13-vectors")
    found = fit(vectors, components)
    if found is None:
        found = Fit(1, [], *_nothing())
    return whitened(vectors, found)


def _nothing():
    import numpy as np
    return np.zeros(0), np.zeros((0, 0)), 0.0, 0.0


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
