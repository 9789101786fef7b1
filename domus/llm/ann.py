"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to unit length, rotated by a seeded random orthogonal matrix and kept as the
signs of its components, 64 to a word, with two correction scalars: its length and the inner
product of the rotated unit vector with its code. The rotated query, rounded to ``LEVEL_BITS`` bits
a component, meets the codes bit plane by bit plane (and + popcount), which estimates the inner
product with a known error bound. Vectors whose upper bound reaches the k-th best exact product
found so far are reranked on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domus.llm.common import bucket_count, stored

SEED, LEVEL_BITS = 20240607, 8
#: Standard deviations that the error bound of an estimate covers.
EPSILON = 3.0
#: Rows of a slice and queries of a block that meet in one task; no result depends on them.
SLICE_ROWS, BLOCK_QUERIES = 16_384, 4_096
ENCODED = "vec_id long, dim int, code binary, norm double, align double, vector array<double>"


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits (uint8 rows, whole 64-bit words), norms, alignments of float64 rows."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / norm[:, None]) @ turn.T
    dim = vectors.shape[1]
    bits = np.zeros((len(vectors), -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned > 0
    align = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    return np.packbits(bits, axis=1, bitorder="little"), norm, align


def _rows(column: pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at, at[1:])]


def encode_vectors(df: DataFrame, key: str, vector: str, seed: int = SEED) -> DataFrame:
    """The index: a row (``ENCODED``) for each row of ``df`` whose vector is not null, not zero and
    has no null or non-finite component; the others are left out."""
    clean = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    unfit = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    clean = clean.where(F.col("vector").isNotNull() & F.exists("vector", lambda x: x != 0) & ~F.exists("vector", unfit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            ids, dims = b.column(0), pa.compute.list_value_length(b.column(1)).to_numpy()
            for dim in np.unique(dims):
                some = pa.array(np.flatnonzero(dims == dim))
                part = b.column(1).take(some)
                matrix = np.stack(_rows(part)).astype(np.float64)
                code, norm, align = encode(matrix, turns.setdefault(int(dim), rotation(int(dim), seed)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(some), pa.array(np.full(len(part), dim), pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(norm), pa.array(align), part.cast(pa.list_(pa.float64()))],
                    names=["vec_id", "dim", "code", "norm", "align", "vector"])

    return clean.mapInArrow(run, ENCODED)


class CodeSlice:
    """Codes of one slice, ready for queries."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("vec_id").combine_chunks()
        self.null_id = self.ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = self.ids.fill_null(0).to_numpy()
        self.code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(self.ids), -1)
        self.ones = np.bitwise_count(self.code).sum(axis=1).astype(np.float64)
        self.norm, self.align = (table.column(c).to_numpy() for c in ("norm", "align"))
        self.vectors = np.stack(_rows(table.column("vector"))).astype(np.float64)
        self.dim = self.vectors.shape[1]
        spread = np.sqrt(np.maximum(0, 1 - self.align**2)) / self.align
        self.slack = spread * EPSILON / np.sqrt(max(1, self.dim - 1))

    def bounds(self, query: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with the query and their upper bounds."""
        turned = turn @ query
        low, high = turned.min(), turned.max()
        step = (high - low) / (2**LEVEL_BITS - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.int64)
        left_over = np.linalg.norm(turned - (low + step * level))
        dot = np.zeros(len(self.ids))
        padded = np.zeros(self.code.shape[1] * 64, np.uint8)
        for j in range(LEVEL_BITS):
            padded[:self.dim] = level >> j & 1
            plane = np.packbits(padded, bitorder="little").view(np.uint64)
            dot += float(1 << j) * np.bitwise_count(self.code & plane).sum(axis=1)
        # sum over set bits, then over signs: 2 * set - all
        signed = 2 * (low * self.ones + step * dot) - (low * self.dim + step * level.sum())
        signed /= np.sqrt(self.dim)
        length = np.linalg.norm(query)
        estimate = self.norm * signed / self.align
        return estimate, estimate + self.norm * (length * self.slack + left_over / self.align) + 1e-9 * length

    def nearest(self, query_id: int | None, query: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact inner products of the k best rows, the query's own id left out."""
        estimate, upper = self.bounds(query, turn)
        if query_id is not None:
            own = (self.ids == query_id) & ~self.null_id
            estimate, upper = np.where(own, -np.inf, estimate), np.where(own, -np.inf, upper)
            free = len(estimate) - int(own.sum())
        else:
            free = len(estimate)
        k = min(k, free)
        if k == 0:
            return np.empty(0, np.int64), np.empty(0)
        first = np.argpartition(-estimate, k - 1)[:k]
        reach = (self.vectors[first] * query).sum(axis=1).min()
        upper[first] = np.inf  # they are scored already, and k of them always remain
        some = np.flatnonzero(upper >= reach)
        score = (self.vectors[some] * query).sum(axis=1)
        best = np.lexsort((self.ids[some], self.null_id[some], -score))[:k]
        return some[best], score[best]


def nearest_neighbours(df: DataFrame, key: str = "vec_id", vector: str = "embedding", *, every: int = 20, k: int = 20,
                       seed: int = SEED, slice_rows: int = SLICE_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by ``every`` the
    ``k`` nearest of all other rows by inner product in double precision, ties to the smaller id.

    Queries in blocks meet all rows in slices; every slice hands on its k best by exact score. Rows
    with the query's id count as its own; a query row that repeats exactly is answered once; other
    repeated rows are candidates each. Rows with a null id are candidates (last among ties), never
    queries. Unfit vectors (see ``encode_vectors``) take no part; vectors of another length are not
    compared. Fewer candidates than k: all of them. Empty table: empty result."""
    index = stored(encode_vectors(df, key, vector, seed), "ann-index")
    queries = index.where(F.col("vec_id") % every == 0).select("vec_id", "dim", "vector").distinct()
    n_rows, n_queries = index.count(), queries.count()
    slices, blocks = bucket_count(n_rows, slice_rows), bucket_count(n_queries, block_queries)
    # the row's place spreads repeated rows; which slice a row falls into changes no result
    dealt = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(slices))
    rows = (index.withColumn("slice", dealt).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))))

    def meet(keys, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = [(), (), ()]
        q, i, s = [], [], []
        if len(left) and len(right):
            table = CodeSlice(right)
            turn = rotation(table.dim, seed)
            for query_id, query in zip(left.column("vec_id").to_pylist(), _rows(left.column("vector"))):
                at, score = table.nearest(query_id, query.astype(np.float64), turn, k)
                q.append(np.full(len(at), query_id)), i.append(at), s.append(score)
            at = np.concatenate(i)
            out = [np.concatenate(q), pa.array(table.ids[at], mask=table.null_id[at]), np.concatenate(s)]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    by = ("dim", "block", "slice")
    found = asked.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
