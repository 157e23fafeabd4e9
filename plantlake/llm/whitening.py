"""Whitening of embeddings by a bit-sliced scatter matrix.

Each entry c becomes the whole number ``floor(scale * c) + offset``. A task subtracts the least entry of every
dimension, writes each dimension as bit planes and packs a plane's bits of 64 rows into one word. The sum of
products of two dimensions is then the sum over their planes of 2^(a+b) times the set bits of ``plane_a & plane_b``.
Sums of all tasks are added as 32-bit limbs by Spark, so that they are exact for any number of rows. The
driver gets one sum per pair of dimensions, centres them as integers, ``n * sum(xy) - sum(x) * sum(y)``, and
takes the eigenvectors. Nothing is grouped by a vector or an id, so copies load no task.

Left out: null vectors, vectors with null or non-finite entries, empty ones and those of another than the commonest
length. Entries beyond +-2^62 after scaling count as +-2^62. Null and repeated ids keep their rows. Further columns are
ignored. Of dimensions without spread (a single row, constant columns) no more components are given than the
matrix has rank: for the rest ``whitened`` is null; ``explained`` is null if there is no spread at all.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plantlake.llm.vectors import matrix, usable

#: Rows whose planes are counted at a time.
BLOCK = 4096
_LIMBS = 6


def scaled(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.clip(np.floor(scale * values), -2.0 ** 62, 2.0 ** 62).astype(np.int64) + offset


def bit_planes(u: np.ndarray) -> np.ndarray:
    """``(dimensions, planes, words)`` of a matrix of numbers from 0 on, one row per line."""
    n, size = u.shape
    count = max(int(u.max(initial=0)).bit_length(), 1)
    padded = np.zeros((-(-n // 64) * 64, size), np.uint64)
    padded[:n] = u
    bits = np.stack([((padded >> np.uint64(a)) & np.uint64(1)).astype(np.uint8) for a in range(count)])
    return np.ascontiguousarray(np.packbits(bits, axis=1).transpose(2, 0, 1)).view(np.uint64)


def plane_products(planes: np.ndarray, n: int) -> np.ndarray:
    """Sums of products of all pairs of dimensions, upper triangle. Whole numbers of any size."""
    size, count, words = planes.shape
    flat = planes.reshape(size * count, words)
    wide = 2 * count + n.bit_length() >= 63
    weights = np.array([1 << b for b in range(count)], object if wide else np.int64)
    out = np.zeros((size, size), weights.dtype)
    for i in range(size):
        rest = flat[i * count:]
        for a in range(count):
            both = np.bitwise_count(rest & flat[i * count + a]).sum(axis=1, dtype=np.int64).reshape(-1, count)
            out[i, i:] += (both.astype(object) if wide else both) @ weights * weights[a]
    return out.astype(object)


def scatter(blocks: Iterable[np.ndarray], size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """``(rows, sums, sums of products)`` of blocks of whole numbers, exact."""
    n, sums, products = 0, np.zeros(size, object), np.zeros((size, size), object)
    for x in blocks:
        least = x.min(axis=0)
        u = x.astype(np.uint64) - least.astype(np.uint64)  # modulo 2^64, so right for every spread
        planes = bit_planes(u)
        weights = np.array([1 << b for b in range(planes.shape[1])], object)
        own = np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(object) @ weights
        low = least.astype(object)
        moved = np.outer(low, own)
        products += plane_products(planes, len(x)) + np.triu(moved + moved.T + len(x) * np.outer(low, low))
        sums += own + len(x) * low
        n += len(x)
    return n, sums, products


def _limbs(value: int) -> list[tuple[int, int]]:
    """The number in steps of 2^32; the last one has the sign."""
    parts = [(k, (value >> 32 * k) & 0xFFFFFFFF) for k in range(_LIMBS - 1)] + [(_LIMBS - 1, value >> 32 * (_LIMBS - 1))]
    return [(k, p) for k, p in parts if p]


@dataclass(frozen=True)
class Whitening:
    """Exact sums of the fitted rows, and eigenvectors (columns) by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, as long numbers where they fit."""
        largest = max((abs(s) for s in self.sums), default=0) + self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if largest < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def projected(self, centred: np.ndarray) -> np.ndarray:
        """One column per component; NaN for those without spread."""
        flat = (centred / self.n).astype(np.float64)
        spread = np.where(self.values > 0, self.values, np.nan)
        return flat @ self.vectors / np.sqrt(spread)


def deviations(centred: np.ndarray) -> list[int]:
    """Sum of squares of each row."""
    largest = int(np.abs(centred).max(initial=0))
    if centred.dtype != object and centred.shape[1] * largest * largest < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    wide = centred.astype(object)
    return (wide * wide).sum(axis=1).tolist()


def fit(rows: DataFrame, size: int, components: int, scale: int = 1024, offset: int = 100_000) -> Whitening | None:
    """Of rows as ``usable`` gives them; None without rows."""
    def sums(batches):
        n, s, p = scatter((scaled(matrix(b.column(0), size)[k:k + BLOCK], scale, offset) for b in batches
                           for k in range(0, b.num_rows, BLOCK)), size)
        cells = [(-1, -1, n), *((i, -1, v) for i, v in enumerate(s)), *((i, j, p[i, j]) for i in range(size) for j in range(i, size))]
        out = [(i, j, k, part) for i, j, v in cells for k, part in _limbs(v)]
        for at in range(0, len(out), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at:at + 50_000]), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                             names=["i", "j", "k", "part"])

    parts = rows.select("v").mapInArrow(sums, "i int, j int, k int, part long").groupBy("i", "j", "k").agg(F.sum("part").alias("part"))
    total: dict[tuple[int, int], int] = {}
    for i, j, k, part in parts.collect():  # one number per pair of dimensions and limb
        total[i, j] = total.get((i, j), 0) + (part << 32 * k)
    n = total.get((-1, -1), 0)
    if n == 0:
        return None
    s = [total.get((i, -1), 0) for i in range(size)]
    v = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            v[i, j] = v[j, i] = (n * total.get((i, j), 0) - s[i] * s[j]) / (n * n)
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    e = np.where(e > max(e[0], 0) * size * np.finfo(float).eps, e, 0.0)
    w = w * np.where(w[np.abs(w).argmax(axis=0), np.arange(w.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, s, e, w, float(np.trace(v)), scale, offset)


def identity_error(rows: DataFrame, size: int, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of all whitened rows minus the identity, over components with spread."""
    live = np.flatnonzero(model.values > 0)
    if not len(live):
        return None
    m = len(live)

    def moments(batches):
        sums, products = np.zeros(m), np.zeros((m, m))
        for b in batches:
            y = model.projected(model.centred(scaled(matrix(b.column(0), size), model.scale, model.offset)))[:, live]
            sums += y.sum(axis=0)
            products += y.T @ y
        both = np.concatenate([sums, products.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both), dtype=np.int32)), pa.array(both)], names=["at", "part"])

    found = dict(rows.select("v").mapInArrow(moments, "at int, part double").groupBy("at").agg(F.sum("part")).collect())
    both = np.array([found[k] for k in range(m + m * m)]) / model.n
    mean, products = both[:m], both[m:].reshape(m, m)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(m)).max())


def whitened(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each row and component.
    ``deviation`` is a decimal, null beyond 38 digits."""
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows, size = usable(vectors, id_col, vector_col)
    model = fit(rows, size, components, scale, offset) if size else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, size, model)
    count = len(model.values)
    shares = [e / model.trace if model.trace > 0 else None for e in model.values.tolist()]

    def project(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                some = batch.slice(k, BLOCK)
                centred = model.centred(scaled(matrix(some.column(1), size), scale, offset))
                exact = pa.array([Decimal(d) if d < 10 ** 38 else None for d in deviations(centred)], pa.decimal128(38, 0))
                y = model.projected(centred).reshape(-1)
                each = pa.array(np.repeat(np.arange(some.num_rows), count))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), some.num_rows)),
                     pa.array(np.full(len(y), model.n, np.int64)), exact.take(each), pa.array(y, mask=np.isnan(y)),
                     pa.array(shares * some.num_rows, pa.float64()), pa.array([error] * len(y), pa.float64())], names=names)

    return rows.mapInArrow(project, schema)
