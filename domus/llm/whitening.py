"""Embedding whitening.

Entries become integers (``floor(scale * c)``); the covariance of the distinct integer vectors is
summed in tasks over exactly centred rows and added up in a tree. Its leading eigenpairs come from
a Householder tridiagonalisation, Sturm counts and bisection, and inverse iteration that keeps the
vectors of close eigenvalues orthogonal. Every row is then projected with the small model in hand.

Vectors of different lengths lie in different spaces: each length has its own fit list and model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import shuffle_width, stored

SCALE, COMPONENTS = 256, 4
#: Eigenvalues closer than this, as a part of the matrix's norm, have their vectors kept orthogonal.
CLUSTER = 1e-3
INVERSE_ROUNDS = 6
#: An eigenvalue is zero up to rounding below this times the dimension (64 at least) times the greatest.
ZERO = 8 * np.finfo(float).eps
LONG_MAX = 2**63 - 1


# ---- eigenpairs of a symmetric matrix ----

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the reflectors (first row, unit vector) of Householder's reduction."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        scale = np.abs(x[1:]).max(initial=0.0)
        if scale == 0.0:
            continue
        x /= max(scale, abs(x[0]))
        x[0] += math.copysign(math.sqrt(x @ x), x[0])
        v = x / math.sqrt(x @ x)
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = 2.0 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        column = a[k + 1:, k]
        column -= 2.0 * (v @ column) * v
        a[k, k + 1:] = column
        reflectors.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    floor = max(tiny, np.finfo(float).eps ** 2 * float((off * off).max(initial=0.0)))
    count = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for i, d in enumerate(diag):
        q = d - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < floor, -floor, q)
        count += q < 0
    return count


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, by bisection down to neighbouring doubles."""
    n = len(diag)
    radius = np.r_[np.abs(off), 0.0] + np.r_[0.0, np.abs(off)]
    span = max(float((np.abs(diag) + radius).max()), np.finfo(float).tiny)
    lo, hi = np.full(k, -span * (1 + 1e-10)), np.full(k, span * (1 + 1e-10))
    wanted = n - np.arange(k)  # the i-th greatest has n - i eigenvalues at or below it
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if ((mid <= lo) | (mid >= hi) | (hi - lo < np.finfo(float).eps * 0.25 * np.abs(mid))).all():
            break
        above = count_below(diag, off, mid) >= wanted
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
    return 0.5 * (lo + hi)


def solver(diag: np.ndarray, off: np.ndarray, shift: float, norm: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves (T - shift I) y = b by Gaussian elimination with row swaps; zero pivots become tiny ones."""
    n, least = len(diag), np.finfo(float).eps * norm
    d, u, u2 = (diag - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n
    low, swapped = [0.0] * n, [False] * n
    for i in range(n - 1):
        below = float(off[i])
        if abs(below) > abs(d[i]):  # swap rows i and i + 1
            swapped[i] = True
            factor = d[i] / below
            d[i], u[i], u2[i], d[i + 1], u[i + 1] = below, d[i + 1], u[i + 1], u[i] - factor * d[i + 1], -factor * u[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) > least else math.copysign(least, d[i])
            factor = below / d[i]
            d[i + 1] -= factor * u[i]
        low[i] = factor
    d[-1] = d[-1] if abs(d[-1]) > least else math.copysign(least, d[-1])

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for i in range(n - 1):
            if swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i] - low[i] * y[i + 1]
            else:
                y[i + 1] -= low[i] * y[i]
        for i in range(n - 1, -1, -1):
            rest = (u[i] * y[i + 1] if i + 1 < n else 0.0) + (u2[i] * y[i + 2] if i + 2 < n else 0.0)
            y[i] = (y[i] - rest) / d[i]
            if abs(y[i]) > 1e200:  # the direction is all that counts
                y = [v * 1e-200 for v in y]
        return np.array(y)

    return solve


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and their unit eigenvectors as rows; of each vector the
    entry of greatest size (the first of equals) is positive."""
    diag, off, reflectors = tridiagonal(matrix)
    n = len(diag)
    k = min(k, n)
    values = leading_values(diag, off, k)
    norm = max(float((np.abs(diag) + np.r_[np.abs(off), 0.0] + np.r_[0.0, np.abs(off)]).max()), np.finfo(float).tiny)
    vectors = np.zeros((k, n))
    rng = np.random.default_rng(n)
    first = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            first = i  # a new cluster begins
        shift = value - (i - first) * 4 * np.finfo(float).eps * norm  # equal values get shifts of their own
        solve = solver(diag, off, shift, norm)
        y = rng.standard_normal(n)
        for _ in range(INVERSE_ROUNDS):
            y = solve(y / np.abs(y).max())
            y /= np.abs(y).max()
            for _ in range(2):
                y -= (vectors[first:i] @ y) @ vectors[first:i]
            y /= math.sqrt(y @ y)
        vectors[i] = y
    for begin, v in reversed(reflectors):
        part = vectors[:, begin:]
        part -= 2.0 * np.outer(part @ v, v)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    lead = vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)[:, None]


# ---- sums over the fit list ----

def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, int64 matrix) for the packed vectors of a batch."""
    blobs = batch.column("x")
    sizes = np.diff(np.frombuffer(blobs.buffers()[1], np.int32, len(blobs) + 1, blobs.offset * 4)) // 8
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, np.frombuffer(b"".join(blobs.take(pa.array(rows)).to_pylist()), np.int64).reshape(-1, dim)


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id, x (packed int64) of the rows whose vector has at least one entry and only entries that
    are present, finite and, scaled and rounded down, fit a long."""
    entry = lambda c: F.floor(c.cast("double") * scale)
    limit = F.lit(float(2**63))
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(F.expr("size(v) > 0"))
    usable = F.forall("v", lambda c: F.coalesce((c.cast("double") * scale >= -limit) & (c.cast("double") * scale < limit), F.lit(False)))
    rows = rows.where(usable).select("id", F.transform("v", entry).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            begin = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            packed = flat[begin[0]:begin[-1]].tobytes()
            ends = (begin - begin[0]) * 8
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([packed[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())], names=["id", "x"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("x", T.BinaryType())])
    return rows.mapInArrow(pack, schema)


def _tree_sum(parts: DataFrame, merge: Callable[[pa.Table], pa.Table], schema: str, keys: tuple[str, ...]) -> DataFrame:
    """Adds partial sums (one for each task) in two levels, so no task adds more than about the root of their number."""
    ways = max(1, math.isqrt(shuffle_width(parts.sparkSession)))
    salted = parts.withColumn("salt", F.spark_partition_id() % ways)
    return salted.groupBy("salt", *keys).applyInArrow(merge, schema).groupBy(*keys).applyInArrow(merge, schema)


def exact_sums(fit: DataFrame) -> DataFrame:
    """dim, n, total: for each length the number of vectors and their exact sums (decimal texts, comma-joined)."""
    schema = "dim int, n long, total string"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for dim, _, x in _matrices(b):
                wide = len(x) * max(int(x.max()), -int(x.min())) > LONG_MAX
                part = (x.astype(object) if wide else x).sum(axis=0).astype(object)
                had = sums.setdefault(dim, [0, 0])
                had[0] += len(x)
                had[1] = had[1] + part
        yield _sum_rows(sums)

    def merge(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        total = sum(np.array([int(v) for v in t.split(",")], object) for t in table.column("total").to_pylist())
        return pa.Table.from_batches([_sum_rows({dim: [sum(table.column("n").to_pylist()), total]})])

    return _tree_sum(fit.mapInArrow(add, schema), merge, schema, ("dim",))


def _sum_rows(sums: dict[int, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
                                       pa.array([",".join(map(str, t)) for _, t in sums.values()], pa.string())], names=["dim", "n", "total"])


class Model(NamedTuple):
    """What is known of one length: list size, exact sums, then the eigenpairs."""
    n: int
    total: np.ndarray  # Python integers
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, with the whole part of the mean taken off before rounding to doubles."""
        whole = np.array([t // self.n for t in self.total], object)
        rest = np.array([float(t % self.n) / self.n for t in self.total])
        near = all(abs(int(w)) < 2**61 for w in whole) and len(x) and max(int(x.max()), -int(x.min())) < 2**61
        off = x - whole.astype(np.int64) if near else x.astype(object) - whole
        return off.astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 in exact arithmetic; null where it does not fit a long."""
        s_max = max(abs(int(t)) for t in self.total)
        x_max = max(int(x.max()), -int(x.min()))
        if len(self.total) * (self.n * x_max + s_max) ** 2 <= LONG_MAX:
            d = self.n * x - self.total.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - self.total
        return [v if v <= LONG_MAX else None for v in (d * d).sum(axis=1).tolist()]


def centred_products(fit: DataFrame, rows_of: Callable[[int, np.ndarray, dict], np.ndarray], models: dict) -> DataFrame:
    """dim, i, row (packed doubles): row i of the sum of v vᵀ, and as row -1 the sum of v, over the
    vectors that ``rows_of`` makes of each length's integer vectors."""
    schema = "dim int, i int, row binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = models.value if hasattr(models, "value") else models
        sums: dict[int, list] = {}
        for b in batches:
            for dim, _, x in _matrices(b):
                v = rows_of(dim, x, known)
                had = sums.setdefault(dim, [0.0, 0.0])
                had[0], had[1] = had[0] + v.sum(axis=0), had[1] + v.T @ v
        for dim, (first, second) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * (len(first) + 1), pa.int32()), pa.array(range(-1, len(first)), pa.int32()),
                                              pa.array([first.tobytes(), *[r.tobytes() for r in second]], pa.binary())], names=["dim", "i", "row"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(r, np.float64) for r in table.column("row").to_pylist()], axis=0)
        return pa.table({"dim": table.column("dim")[:1], "i": table.column("i")[:1], "row": pa.array([total.tobytes()], pa.binary())})

    return _tree_sum(fit.mapInArrow(add, schema), merge, schema, ("dim", "i"))


def _covariance(rows: list, n: int) -> np.ndarray:
    """Of the collected rows of ``centred_products``: the second moments less those of what is left of the mean."""
    by_place = {r["i"]: np.frombuffer(r["row"], np.float64) for r in rows}
    mean = by_place.pop(-1) / n
    second = np.stack([by_place[i] for i in sorted(by_place)]) / n
    return 0.5 * (second + second.T) - np.outer(mean, mean)


def _fit_of(dim: int, x: np.ndarray, models: dict) -> np.ndarray:
    return models[dim].centred(x)


def _whitened_of(dim: int, x: np.ndarray, models: dict) -> np.ndarray:
    return models[dim].whitened(x)


def fit_models(fit: DataFrame, components: int) -> tuple[dict[int, Model], float | None]:
    """The model of every length in the fit list (stored, distinct vectors) and the identity error.

    What comes to the driver is a model: d + d² numbers for each length d, whatever the number of rows."""
    context = fit.sparkSession.sparkContext
    models: dict[int, Model] = {}
    for r in exact_sums(fit).collect():
        models[r["dim"]] = Model(r["n"], np.array([int(v) for v in r["total"].split(",")], object), np.zeros(0), np.zeros((0, r["dim"])), 0.0)
    shared = context.broadcast(models)
    moments: dict[int, list] = {}
    for r in centred_products(fit, _fit_of, shared).collect():
        moments.setdefault(r["dim"], []).append(r)
    for dim, rows in moments.items():
        v = _covariance(rows, models[dim].n)
        values, vectors = leading_pairs(v, components)
        keep = (values > ZERO * max(dim, 64) * values[0]) & (np.trace(v) > 0)
        models[dim] = models[dim]._replace(values=values[keep], vectors=vectors[keep], trace=float(np.trace(v)))
    whitened: dict[int, list] = {}
    shared = context.broadcast(models)
    for r in centred_products(fit.where(F.expr("octet_length(x)").isin([8 * d for d, m in models.items() if len(m.values)])), _whitened_of, shared).collect():
        whitened.setdefault(r["dim"], []).append(r)
    errors = [float(np.abs(_covariance(rows, models[dim].n) - np.eye(len(models[dim].values))).max()) for dim, rows in whitened.items()]
    return models, max(errors, default=None)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """For each row and component: ``key``, ``component`` (from 1, falling eigenvalue), ``n`` (distinct
    vectors of the row's length), ``deviation``, ``whitened``, ``explained`` (part of the trace) and
    ``identity_error`` (the greatest of all lengths).

    Null and empty vectors, and those with null, NaN or infinite entries or entries whose scaled
    value passes a long, have no rows. Components whose eigenvalue is zero up to rounding are left
    out, so a single distinct vector, like an empty table, gives an empty result. Repeated rows
    count once in the fit and each have their rows; of equal eigenvalues any orthonormal vectors
    serve, the same for all rows. A deviation that passes a long is null. Long vectors cost d²
    numbers a task and d² on the driver. Other columns are ignored, whatever their names."""
    rows = whole_vectors(df, key, vector, scale)
    fit = stored(rows.select("x").distinct(), "fit-list")
    models, error = fit_models(fit, components)
    models = {d: m for d, m in models.items() if len(m.values)}
    shared = df.sparkSession.sparkContext.broadcast(models)
    fields = [T.StructField(key, rows.schema["id"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
              T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
              T.StructField("identity_error", T.DoubleType())]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, at, x in _matrices(b):
                m = shared.value.get(dim)
                if m is None:
                    continue
                k, rows = len(m.values), len(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array([m.n] * (rows * k), pa.int64()),
                     pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(m.whitened(x).ravel()),
                     pa.array(np.tile(m.values / m.trace, rows)), pa.array([error] * (rows * k), pa.float64())],
                    names=[f.name for f in fields])

    return rows.mapInArrow(project, T.StructType(fields))
