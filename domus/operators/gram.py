"""Sums of products of many columns in one scan.

Rows travel to the tasks' numpy as Arrow batches; a batch is one matrix, so p columns cost a few
p × p products a batch instead of p² expressions a row. Each task sends its sums as p rows of
numbers, which Spark adds natively (``Summarizer``): the result is p² numbers for each group and
kind of product, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known(c: Column) -> Column:
    """As a double; NaN counts as missing."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def matrix_sums(df: DataFrame, columns: Sequence[Column], products: Callable[[np.ndarray], dict[str, np.ndarray]],
                group: Column | None = None) -> dict:
    """{group: {kind: matrix}}: the sum over batches of ``products(X)``, a mapping of names to matrices
    of one width. X holds the columns as doubles, NaN where missing. The groups' matrices
    are held by every task, so groups are folds or the like, not keys."""
    width = len(columns)
    names = [f"x{i}" for i in range(width)]
    kind_of = (group if group is not None else F.lit(0)).cast("long")
    rows = df.select(kind_of.alias("g"), *[known(c).alias(n) for c, n in zip(columns, names)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            x = np.empty((b.num_rows, width))
            for i in range(width):
                x[:, i] = b.column(i + 1).to_numpy(zero_copy_only=False)
            groups = b.column(0).to_numpy(zero_copy_only=False)
            for g in np.unique(groups[~np.isnan(groups.astype(float))]).tolist():
                for kind, m in products(x[groups == g]).items():
                    sums[int(g), kind] = sums.get((int(g), kind), 0.0) + m
        flat = [(g, kind, i, row.tolist()) for (g, kind), m in sums.items() for i, row in enumerate(m)]
        g, kind, i, row = zip(*flat) if flat else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(kind, pa.string()), pa.array(i, pa.int32()), pa.array(row, pa.list_(pa.float64()))],
                                         names=["g", "kind", "i", "row"])

    parts = rows.mapInArrow(add, "g long, kind string, i int, row array<double>")
    total = parts.groupBy("g", "kind", "i").agg(Summarizer.metrics("sum").summary(array_to_vector("row")).alias("s"))
    out: dict = {}
    for r in total.collect():
        out.setdefault(r["g"], {}).setdefault(r["kind"], {})[r["i"]] = r["s"]["sum"].toArray()
    return {g: {kind: np.stack([m[i] for i in sorted(m)]) for kind, m in kinds.items()} for g, kinds in out.items()}


def complete_products(shift: np.ndarray) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
    """Σ zzᵀ of z = [1, x − shift] over the complete rows."""
    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        x = x[~np.isnan(x).any(axis=1)] - shift
        z = np.hstack([np.ones((len(x), 1)), x])
        return {"zz": z.T @ z}
    return products


def masked_products(shift: np.ndarray) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
    """Pairwise-complete sums: how often both are known, Σ x_i, Σ x_i² and Σ x_i x_j over the rows that know both."""
    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        k = (~np.isnan(x)).astype(float)
        x = np.where(k > 0, x - shift, 0.0)
        return {"n": k.T @ k, "x": x.T @ k, "xx": (x * x).T @ k, "xy": x.T @ x}
    return products


def weighted_products(weigh: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
    """Σ w vvᵀ of v = [1, x, z] and the sum of a loss, over the complete rows; ``weigh`` makes weights
    w, responses z and losses from a matrix [x, y]."""
    def products(x: np.ndarray) -> dict[str, np.ndarray]:
        x = x[~np.isnan(x).any(axis=1)]
        w, z, loss = weigh(x)
        v = np.hstack([np.ones((len(x), 1)), x[:, :-1], z[:, None]])
        return {"vv": (v * w[:, None]).T @ v, "loss": np.full((1, v.shape[1]), loss.sum())}
    return products


def column_means(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Means of the known values (0 for a column without any), in one scan."""
    row = df.agg(*[F.avg(known(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([m if m is not None else 0.0 for m in row])
