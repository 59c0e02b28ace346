"""Embedding whitening from exact integer covariances, recovered by polarisation.

Entries become integers ``x = floor(1024 * c) + 100000``. A first pass sums them, which gives the number of
rows n and the sums S. A second pass takes the centred values ``y = n * x - S``, which are integers as well,
and sums the squares of each ``y[i]`` and of each ``y[i] + y[j]``: no product of two different entries is
ever formed. Differences of these variances are the covariances, ``cov(i, j) = (var(i + j) - var(i) - var(j)) / 2``,
exact until the last division. Their eigenvectors give the whitening, which a third pass applies.

Sums are kept in limbs of ``LIMB`` bits, so they neither round nor overflow. A task sends its sums only: one
row for each pair of dimensions and limb, whatever its number of rows. The driver gets these sums once
added up, d * (d + 1) / 2 of them for vectors of d entries, and solves for the eigenvectors.

Defined cases: vectors that are null or hold null or non-finite entries take no part; rows without vec_id and
repeated rows do. Vectors of different lengths are whitened apart, each length with its own list; empty ones
have no components. A component without variance (rank below its number) has null ``whitened``, and
``identity_error`` is over the others, null if there are none. Entries beyond 2**51 count as that. A
``deviation`` that does not fit 64 bits is null. An empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import staged

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 61)  # bound of 1024 * c, so that x fits 64 bits
LIMB = 31
MASK = (1 << LIMB) - 1
CELLS = 1 << 21  # entries of a matrix that are worked on at once


def integral(vectors: DataFrame) -> DataFrame:
    """``(vec_id, d, x)`` of the rows that take part: the entries as integers, and their number."""
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        return F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + SHIFT

    kept = vectors.where(F.col("embedding").isNotNull() & sound)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("d"), F.transform("embedding", whole).alias("x"))


def _matrices(batch: pa.RecordBatch):
    """The vectors of a batch by length, in matrices of bounded size: (rows of the batch, matrix)."""
    lists = batch.column("x")
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        step = max(1, CELLS // d)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield some, flat[ends[some][:, None] + np.arange(d)]


def _limbs_of(value: int) -> list[int]:
    out = []
    while value:
        out.append(value & MASK)
        value >>= LIMB
    return out


class _Sums:
    """Sums of non-negative integers by place, in limbs."""

    def __init__(self, shape):
        self.shape, self.limbs = shape, []

    def limb(self, k: int) -> np.ndarray:
        while len(self.limbs) <= k:
            self.limbs.append(np.zeros(self.shape, np.int64))
        return self.limbs[k]

    def add_products(self, at, p: np.ndarray, limb: int, times: int = 1) -> None:
        """Add the column sums of ``p`` (at most 62 bits each), ``times`` over, from a limb on."""
        self.limb(limb)[at] += times * (p & MASK).sum(axis=0)
        self.limb(limb + 1)[at] += times * (p >> LIMB).sum(axis=0)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` as 64-bit integers, or as Python's where they do not fit."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums)) < 1 << 60:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def add_squares(total: _Sums, y: np.ndarray) -> None:
    """Add the squares of each ``y[i]`` (at [i, i]) and of each ``y[i] + y[j]`` (at [i, j], i < j)."""
    narrow = y.dtype != object and len(y) and int(np.abs(y).max()) < 1 << 30
    for i in range(y.shape[1]):
        z = y[:, i:] + y[:, i : i + 1]
        z[:, 0] = y[:, i]
        at = (i, slice(i, None))
        if narrow:
            total.add_products(at, z * z, 0)
        elif y.dtype != object:
            z = np.abs(z)
            high, low = z >> LIMB, z & MASK
            total.add_products(at, low * low, 0)
            total.add_products(at, high * low, 1, 2)
            total.add_products(at, high * high, 2)
        else:
            for j, value in enumerate((z * z).sum(axis=0).tolist()):
                for k, part in enumerate(_limbs_of(value)):
                    total.limb(k)[i, i + j] += part


def _sums(x: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length of vectors: their number and the sums of their entries."""

    def add(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for rows, matrix in _matrices(batch):
                n, high, low = totals.setdefault(matrix.shape[1], [0, 0, 0])
                totals[matrix.shape[1]] = [n + len(rows), high + (matrix >> LIMB).sum(axis=0), low + (matrix & MASK).sum(axis=0)]
        for d, (n, high, low) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
                "high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64()),
            })

    parts = x.select("x").mapInArrow(add, "d int, i int, n bigint, high bigint, low bigint")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("d", "i").agg(*wide).orderBy("d", "i").collect():
        out.setdefault(r.d, (int(r.n), []))[1].append((int(r.high) << LIMB) + int(r.low))
    return out


def _squares(x: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length: the exact sums that ``add_squares`` makes, as Python integers."""

    def add(batches):
        totals: dict[int, _Sums] = {}
        for batch in batches:
            for _, matrix in _matrices(batch):
                d = matrix.shape[1]
                add_squares(totals.setdefault(d, _Sums((d, d))), centred(matrix, *sums[d]))
        for d, total in totals.items():
            i, j = np.triu_indices(d)
            for k, limb in enumerate(total.limbs):
                columns = [np.full(len(i), d, np.int32), i.astype(np.int32), j.astype(np.int32), np.full(len(i), k, np.int32), limb[i, j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d", "i", "j", "limb", "part"])

    parts = x.select("x").mapInArrow(add, "d int, i int, j int, limb int, part bigint")
    added = parts.groupBy("d", "i", "j", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).toArrow()
    out = {d: np.zeros((d, d), object) for d in sums}
    for d, i, j, limb, part in zip(*(added[c].to_pylist() for c in ("d", "i", "j", "limb", "part")), strict=True):
        out[d][i, j] += int(part) << (LIMB * limb)
    return out


def covariance(squares: np.ndarray, n: int) -> np.ndarray:
    """Covariances by polarisation, each rounded once."""
    d, cube = len(squares), n**3
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = squares[i, i] / cube
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (squares[i, j] - squares[i, i] - squares[j, j]) / (2 * cube)
    return out


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First eigenvectors (columns) and eigenvalues by falling eigenvalue, and their shares of the trace.

    Of an eigenvector's two signs that is taken in which its largest entry is positive.
    """
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = np.trace(v)
    values = np.where(values > max(values[0], 0.0) * len(v) * np.finfo(float).eps, values, 0.0)
    return vectors, values, values / trace if trace > 0 else np.full(len(values), np.nan)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every row that takes part."""
    x = staged(integral(vectors), "integral")
    sums = _sums(x)
    squares = _squares(x, sums)
    models = {}
    for d, (n, s) in sums.items():
        axes, values, explained = principal(covariance(squares[d], n), components)
        models[d] = n, s, axes / np.sqrt(np.where(values > 0, values, np.nan)), [None if np.isnan(e) else float(e) for e in explained]

    def apply(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for rows, matrix in _matrices(batch):
                d = matrix.shape[1]
                n, s, axes, explained = models[d]
                y = centred(matrix, n, s)
                whitened = (y / n).astype(float) @ axes
                wide = y.dtype == object or d * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 63
                deviation = ((y.astype(object) if wide else y) ** 2).sum(axis=1).tolist()
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array([n] * len(rows), pa.int64()),
                    pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                    pa.array([[None if np.isnan(w) else w for w in row] for row in whitened.tolist()], pa.list_(pa.float64())),
                    pa.array([explained] * len(rows), pa.list_(pa.float64())),
                ], ["vec_id", "d", "n", "deviation", "whitened", "explained"])

    schema = "vec_id bigint, d int, n bigint, deviation bigint, whitened array<double>, explained array<double>"
    rows = staged(x.mapInArrow(apply, schema), "whitened")
    error = F.lit(None).cast("double")
    for d, value in _identity_errors(rows, components).items():
        error = F.when(F.col("d") == d, F.lit(value)).otherwise(error)
    each = F.arrays_zip("whitened", "explained")
    placed = rows.select("vec_id", "n", "deviation", error.alias("identity_error"), F.posexplode(each).alias("at", "c"))
    return placed.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error",
    )


def _identity_errors(rows: DataFrame, components: int) -> dict[int, float]:
    """For each length of vectors: how far the covariance of the whitened rows is from the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = [F.get("whitened", F.lit(k)) for k in range(components)]
    measured = rows.groupBy("d").agg(*(F.covar_pop(found[i], found[j]).alias(f"c_{i}_{j}") for i, j in pairs)).collect()
    out = {}
    for r in measured:
        errors = [abs(r[f"c_{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c_{i}_{j}"] is not None]
        if errors:
            out[r.d] = float(max(errors))
    return out


def op13(vectors: DataFrame) -> DataFrame:
    """The first eight whitened components of every embedding."""
    return whiten(vectors.select("vec_id", "embedding"))
