"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows A are never multiplied into a covariance. Each step sends one vector
through the rows: u = A p and, in the same pass, A'u, u'u and the products of u with all
earlier u. An earlier u is A times a known vector of the row's length, so the left
vectors need no storage and a lost executor loses nothing; both sides are
reorthogonalised in full. What grows with the rows stays in the tasks: the driver holds
matrices of (length x steps). The singular values and right vectors of the small
bidiagonal matrix give deviations and components.

Steps end when the wanted components have converged and the variance that is not yet
spanned is too small to hide another one, at the vectors' length at the latest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, stored

# Fixed values of the contract: entries are counted in steps of 1 / SCALE from -SHIFT.
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(2 ** 50)     # of |64 c|; larger entries count as this one
BLOCK_BYTES = 4 << 20        # rows kept together
TINY = 1e-12                 # of the matrix's norm: taken as zero


def _grid(batches):
    """Vectors as blocks of rows of one length: (dim, ids, whole numbers)."""
    import pyarrow as pa

    schema = pa.schema([("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("x", pa.binary())])
    for batch in batches:
        lists = batch.column("numbers")
        ids = batch.column("vec_id")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        sizes = np.diff(offsets)
        for dim in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == dim)
            step = max(1, BLOCK_BYTES // (8 * dim))
            for a in range(0, len(rows), step):
                own = rows[a:a + step]
                c = flat[offsets[own][:, None] + np.arange(dim)]
                x = np.floor(np.clip(c, -LARGEST / SCALE, LARGEST / SCALE) * SCALE).astype(np.int64) + SHIFT
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([ids.take(pa.array(own)).to_pylist()], schema[1].type),
                     pa.array([x.tobytes()], pa.binary())], schema=schema)


def whole_rows(vectors: DataFrame) -> DataFrame:
    """The rows that take part, packed in blocks, in the shared folder."""
    numbers = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), numbers.alias("numbers")).where(
        F.col("numbers").isNotNull()
        & F.forall("numbers", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return stored(rows.mapInArrow(_grid, "dim int, ids array<long>, x binary"), "whitening-rows")


@dataclass
class Centre:
    """Count and per-dimension sums of the fit list; rows minus their mean, without rounding it first."""

    n: int
    sums: np.ndarray         # whole numbers (Python)

    def __post_init__(self):
        self.floor = np.array([int(s) // self.n for s in self.sums], np.int64)
        self.rest = np.array([int(s) % self.n for s in self.sums], np.int64)

    def rows(self, data: bytes) -> np.ndarray:
        x = np.frombuffer(data, np.int64).reshape(-1, len(self.floor))
        return (x - self.floor) - self.rest / self.n

    def deviations(self, data: bytes) -> list:
        """Sum over dimensions of (n x - S)^2, exact; None beyond 63 bits."""
        x = np.frombuffer(data, np.int64).reshape(-1, len(self.floor)) - self.floor
        most = (np.abs(x).max(initial=0) + 1.0) * self.n
        if most * most * len(self.floor) < 2.0 ** 62:
            t = x * np.int64(self.n) - self.rest
            return (t * t).sum(1).tolist()
        t = x.astype(object) * self.n - self.rest.astype(object)
        return [v if v < 1 << 63 else None for v in (t * t).sum(1).tolist()]


def _summed(rows: DataFrame, partial: Callable, length: int) -> np.ndarray:
    """Sum over all blocks of ``partial(block bytes)``, arrays of ``length``; added up on the cluster."""
    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            for data in batch.column("x").to_pylist():
                own = partial(data)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(length, dtype=np.int32)), pa.array(total, pa.float64())], ["j", "value"])

    out = np.zeros(length)
    for j, value in rows.select("x").mapInArrow(run, "j int, value double").groupBy("j").agg(
            F.sum("value")).collect():
        out[j] = value
    return out


def _centre(rows: DataFrame, dim: int) -> Centre:
    def run(batches):
        import pyarrow as pa

        n, sums = 0, np.zeros(dim, object)
        for batch in batches:
            for data in batch.column("x").to_pylist():
                x = np.frombuffer(data, np.int64).reshape(-1, dim)
                n += len(x)
                sums = sums + x.sum(0).astype(object)
        # in two halves of 32 bits, so that no sum of tasks leaves 63 bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dim + 1, dtype=np.int32)),
             pa.array([0, *(int(s) >> 32 for s in sums)], pa.int64()),
             pa.array([n, *(int(s) & 0xFFFFFFFF for s in sums)], pa.int64())], ["j", "high", "low"])

    found = dict((j, (int(high) << 32) + int(low)) for j, high, low in rows.select("x").mapInArrow(
        run, "j int, high long, low long").groupBy("j").agg(F.sum("high"), F.sum("low")).collect())
    return Centre(found[0], np.array([found[j + 1] for j in range(dim)], object))


def bidiagonalise(product: Callable, dim: int, norm: float, rows: int, want: int, seed: int = 0):
    """Right singular vectors (dim x found) and singular values of the matrix behind ``product``.

    ``product(P, p)`` gives u'u, U'u and A'u for u = A p and U = A P. ``norm`` is the
    matrix's Frobenius norm.
    """
    rng = np.random.default_rng(seed)
    right, from_right, back = (np.zeros((dim, 0)) for _ in range(3))    # V, P, A'U
    alpha, beta = [], []
    steps = min(dim, rows)

    def fresh():
        while True:
            v = rng.normal(size=dim)
            for _ in range(2):
                v -= right @ (right.T @ v)
            size = np.linalg.norm(v)
            if size > 1e-8:
                return v / size

    if not norm > 0:
        return np.zeros((dim, 0)), np.zeros(0)
    v, last = fresh(), 0.0
    while True:
        k = len(alpha)
        p = v - last * from_right[:, -1] if k else v.copy()
        square, along, w = product(from_right, p)
        p, w = p - from_right @ along, w - back @ along
        a = float(np.sqrt(max(square - along @ along, 0.0)))
        if a <= TINY * norm:
            a, p, w = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            p, w = p / a, w / a
        right, from_right, back = (np.column_stack([m, c]) for m, c in ((right, v), (from_right, p), (back, w)))
        alpha.append(a)
        k += 1
        r = w - a * v
        for _ in range(2):
            r -= right @ (right.T @ r)
        last = float(np.linalg.norm(r))
        small = np.diag(alpha) + np.diag(beta, 1)
        done = k >= steps
        if not done and k >= want and k % 8 == 0:
            left, sigma, _ = np.linalg.svd(small)
            open_ = norm * norm - (sigma * sigma).sum()
            done = (last * np.abs(left[-1, :want]).max() <= 1e-15 * norm
                    and max(open_, 0.0) + 1e-13 * norm * norm < sigma[want - 1] ** 2)
        if done:
            _, sigma, turn = np.linalg.svd(small)
            found = min(want, int((sigma > TINY * norm).sum()))
            return right @ turn[:found].T, sigma[:found]
        if last <= TINY * norm:          # an invariant subspace: go on outside of it
            v, last = fresh(), 0.0
        else:
            v = r / last
        beta.append(last)


@dataclass
class Whitening:
    """Components (dim x found) with the deviation of the rows along each, largest first."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    trace: float             # of the covariance

    def rows(self, data: bytes) -> np.ndarray:
        return self.centre.rows(data) @ (self.components / self.deviations)


def fit_whitening(rows: DataFrame, dim: int, want: int = 32, seed: int = 0) -> Whitening:
    """Fit on all blocks of ``rows`` (``whole_rows``), vectors of ``dim`` entries."""
    spark = rows.sparkSession
    centre = _centre(rows, dim)
    norm = float(np.sqrt(_summed(rows, lambda data: np.array([(centre.rows(data) ** 2).sum()]), 1)[0]))

    def product(from_right, p):
        k = from_right.shape[1]
        load = shipped(spark, np.column_stack([from_right, p]))

        def partial(data):
            a = centre.rows(data)
            through = a @ load()
            u = through[:, -1]
            return np.concatenate([u @ through, u @ a])

        found = _summed(rows, partial, k + 1 + dim)
        return found[k], found[:k], found[k + 1:]

    components, sigma = bidiagonalise(product, dim, norm, centre.n, want, seed)
    return Whitening(centre, components, sigma / np.sqrt(centre.n), norm * norm / centre.n)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, n = model.components.shape[1], model.centre.n
    if not k:
        return 0.0
    mean = _summed(rows, lambda data: model.rows(data).sum(0), k) / n

    def partial(data):
        y = model.rows(data) - mean
        return (y.T @ y).ravel()

    return float(np.abs(_summed(rows, partial, k * k).reshape(k, k) / n - np.eye(k)).max())


def _whitened(model: Whitening, error: float):
    explained = model.deviations ** 2 / model.trace if model.trace > 0 else model.deviations
    k = len(explained)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("x").to_pylist()):
                ids, deviation = ids.values, pa.array(model.centre.deviations(data), pa.int64())
                y = model.rows(data)
                for a in range(0, len(y), 2048):
                    m = min(2048, len(y) - a)
                    row = pa.array(np.repeat(np.arange(a, a + m), k))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, model.centre.n, np.int64)), deviation.take(row),
                         pa.array(y[a:a + m].ravel()), pa.array(np.tile(explained, m)),
                         pa.array(np.full(m * k, error))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def whiten_embeddings(vectors: DataFrame, components: int = 32, seed: int = 0) -> DataFrame:
    """Whitened coordinates of ``vectors`` (vec_id, embedding) along the leading components.

    An entry c counts as floor(64 c) + 1000000. Returns per row and component (from 1,
    by falling variance): vec_id, component, n (vectors of the fit), deviation (sum over dimensions
    of (n x - S)^2; null if it takes more than 63 bits), whitened, explained (share of the
    variance), identity_error (of the whitened covariance, one value). Dropped are null vectors and those with a
    null or non-finite entry; empty vectors have no components and no rows. Zero vectors, repeated rows, repeated and null ids take part
    like any others. Directions without variance have no deviation to divide by: they are no
    components, so that n equal vectors give no rows (without: under 1e-12 of the norm). Vectors of
    another length are another fit list with components of its own; there should be few
    lengths, each is fitted in turn. Entries beyond 2^44 count as 2^44. An empty table gives no rows. Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    rows = whole_rows(vectors)
    out = spark.createDataFrame([], _RESULT)
    for (dim,) in sorted(rows.select("dim").distinct().collect()):
        own = rows.where(F.col("dim") == dim)
        model = fit_whitening(own, dim, components, seed)
        if model.components.shape[1]:
            out = out.union(own.select("ids", "x").mapInArrow(
                _whitened(model, identity_error(own, model)), _RESULT))
    return out
