"""Boosted regression trees with shared passes.

Features are cut to byte bins once, and rows that agree in all bins (and the fold) become one cell
with the number of rows and the sums of the response; a tree sees no more of a row than that. Few
cells are handed to every task, and the models are dealt out. Where there are many, all models of a
grid grow side by side: ONE pass over the cells brings the gradient sums of every open
node of every model, by feature and bin, so a grid costs (trees × depth) passes whatever the number
of its models. The passes add matrices inside tasks and return sums, never rows. The cells carry every
model's prediction: the pass that opens a tree adds the last one's, in the cache, and every
``STORE_TREES`` trees the cells are written to the shared folder, so a lost executor costs a few trees.

Splits minimise the squared error with every bin edge tried; ties go to the first feature, then the
first edge. A node that no split improves is a leaf for good."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.operators.gram import known
from domus.session import scratch_path

MAX_BINS, STORE_TREES = 255, 25
#: A pass over at most so many partitions returns its sums directly; beyond, Spark adds them first.
DIRECT_PARTS = 32
#: Cells of a partition of the stored table, at a guess.
PART_CELLS = 200_000
#: So many cells (a few MB) are handed to every task, and the models dealt out instead of the cells.
HELD_CELLS = 100_000
_GAIN = 1e-12


# ---- bins ----

def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """For each feature the rising cut values: bin ``i`` holds values above ``i`` of them. All midpoints
    between neighbouring values where there are at most ``max_bins`` values, else midpoints at approximate quantiles."""
    few = df.agg(*[F.approx_count_distinct(known(F.col(f"`{c}`")), 0.02).alias(f"n{i}") for i, c in enumerate(features)]).first()
    out = []
    for i, c in enumerate(features):
        x = df.select(known(F.col(f"`{c}`")).alias("x")).where("x is not null")
        values = sorted(r["x"] for r in x.distinct().limit(max_bins + 1).collect()) if few[i] <= 1.2 * max_bins else [0.0] * (max_bins + 1)
        if len(values) > max_bins:
            probs = [(j + 0.5) / max_bins for j in range(max_bins)]
            values = sorted(set(x.approxQuantile("x", probs, 0.2 / max_bins)))
        out.append([a + (b - a) / 2 for a, b in zip(values, values[1:])])
    return out


def _binned(matrix: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(np.asarray(e, float), matrix[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


# ---- trees ----

@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2): feature (-1: leaf), last bin that goes
    left, the mean residual and the gain."""
    feature: np.ndarray
    edge: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))


class Forest:
    """The trees in hand, one for each model, side by side: arrays (model, node)."""

    def __init__(self, trees: Sequence[Tree]):
        width = max(len(t.feature) for t in trees)
        pad = lambda a, fill: np.r_[a, np.full(width - len(a), fill, a.dtype)]
        self.feature = np.stack([pad(t.feature, -1) for t in trees])
        self.edge = np.stack([pad(t.edge, 0) for t in trees])
        self.value = np.stack([pad(t.value, 0.0) for t in trees])

    def node_of(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """(model, row): where each row stands after ``levels`` splits (or the leaf it met before)."""
        models = np.arange(len(self.feature))[:, None]
        rows = np.arange(len(bins))
        at = np.zeros((len(models), len(bins)), np.int64)
        for _ in range(levels):
            f = self.feature[models, at]
            right = bins[rows, np.maximum(f, 0)] > self.edge[models, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at

    def leaf_values(self, bins: np.ndarray) -> np.ndarray:
        return np.take_along_axis(self.value, self.node_of(bins, int(math.log2(self.feature.shape[1] + 1)) - 1), axis=1)


@dataclass
class Ensemble:
    """A model: a mean, a rate and trees over binned features. ``train_fold`` is the fold that is left
    out (-1: none)."""
    depth: int
    rate: float
    n_trees: int
    train_fold: int = -1
    base: float = 0.0
    trees: list = field(default_factory=list)
    features: tuple = ()
    edges: list = field(default_factory=list)

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += self.rate * Forest([tree]).leaf_values(bins)[0]
        return out


def _cells(df: DataFrame, label: str, features: Sequence[str], fold, edges) -> DataFrame:
    """fold, bins (a byte for each feature), n, s, ss: the complete rows, by fold and bins."""
    width = len(features)
    rows = df.select(fold.cast("int").alias("fold"), known(F.col(f"`{label}`")).alias("y"), *[known(F.col(f"`{c}`")).alias(f"x{i}") for i, c in enumerate(features)])
    rows = rows.na.drop(subset=["y", *[f"x{i}" for i in range(width)]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(i + 2).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
            packed = _binned(x, edges).tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([packed[i * width:(i + 1) * width] for i in range(len(x))], pa.binary()), b.column(1)], names=["fold", "bins", "y"])

    binned = rows.mapInArrow(cut, "fold int, bins binary, y double")
    return binned.groupBy("fold", "bins").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss"))


def _columns(b: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    return b.column("fold").to_numpy(zero_copy_only=False), bins, b.column("n").to_numpy().astype(float), b.column("s").to_numpy()


CELLS = "fold int, bins binary, n long, s double, ss double, known binary"


def _known(b: pa.RecordBatch, n_models: int) -> np.ndarray:
    """(model, cell): the predictions that the cells carry."""
    return np.frombuffer(b"".join(b.column("known").to_pylist()), np.float64).reshape(-1, n_models).T


def _with_known(b: pa.RecordBatch, now: np.ndarray) -> pa.RecordBatch:
    size = 8 * len(now)
    packed = np.ascontiguousarray(now.T).tobytes()
    return pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([packed[i * size:(i + 1) * size] for i in range(b.num_rows)], pa.binary())], names=["fold", "bins", "n", "s", "ss", "known"])


def _start(cells: DataFrame, bases: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _with_known(b, np.repeat(bases[:, None], b.num_rows, axis=1))
    return cells.mapInArrow(run, CELLS)


def _moved(cells: DataFrame, forest: Forest, rates: np.ndarray, width: int) -> DataFrame:
    """The cells after one more tree of each model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, bins, _, _ = _columns(b, width)
            yield _with_known(b, _known(b, len(rates)) + rates[:, None] * forest.leaf_values(bins))
    return cells.mapInArrow(run, CELLS)


def _add_level(sums: np.ndarray, forest: Forest, level: int, open_: np.ndarray, left_out: np.ndarray, slots: np.ndarray, cells: tuple, known_: np.ndarray) -> None:
    """Adds to ``sums`` (open model, n or gradient, node of the level, slot) what the cells hold."""
    fold, bins, n, s = cells
    total, first, nodes = int(slots[-1]), 2 ** level - 1, 2 ** level
    place = (bins.astype(np.int64) + slots[:-1]).T  # by feature
    node = forest.node_of(bins, level)
    for j, i in enumerate(open_.tolist()):
        use = np.flatnonzero((fold != left_out[i]) & (node[i] >= first))
        at = (node[i, use] - first) * total
        count, grad = n[use], s[use] - n[use] * known_[i, use]
        for f in range(len(place)):
            slot = at + place[f, use]
            sums[j, 0] += np.bincount(slot, count, nodes * total).reshape(nodes, total)
            sums[j, 1] += np.bincount(slot, grad, nodes * total).reshape(nodes, total)


def _squared_errors(cells: tuple, ss: np.ndarray, known_: np.ndarray, left_out: np.ndarray) -> np.ndarray:
    """(model, rows and squared error) over each model's left-out fold."""
    fold, _, n, s = cells
    own = (fold == left_out[:, None]) * 1.0
    return np.stack([own @ n, (own * (ss - 2 * known_ * s + n * known_ * known_)).sum(axis=1)], axis=1)


def _level_sums(cells: DataFrame, forest: Forest, level: int, open_: np.ndarray, left_out: np.ndarray, width: int, slots: np.ndarray, direct: bool) -> tuple[np.ndarray, np.ndarray]:
    """((model, node) pairs, [pair, n or gradient, slot]): the sums of the rows in the level's nodes of
    the ``open_`` models, by feature and bin; the left-out fold has no say."""
    total, first = int(slots[-1]), 2 ** level - 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(open_), 2, 2 ** level, total))
        for b in batches:
            _add_level(sums, forest, level, open_, left_out, slots, _columns(b, width), _known(b, len(left_out)))
        j, k = np.nonzero(sums[:, 0].any(axis=2))
        flat = np.ascontiguousarray(sums[j, :, k]).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(j) + 1, dtype=np.int32) * 2 * total), pa.array(flat))
        yield pa.RecordBatch.from_arrays([pa.array(open_[j], pa.int32()), pa.array(k + first, pa.int32()), lists], names=["model", "node", "sums"])

    parts = cells.mapInArrow(add, "model int, node int, sums array<double>")
    if not direct:
        parts = parts.groupBy("model", "node").agg(vector_to_array(Summarizer.metrics("sum").summary(array_to_vector("sums"))["sum"]).alias("sums"))
    got = parts.toArrow()
    pairs = np.stack([got.column("model").to_numpy(), got.column("node").to_numpy()], axis=1) if got.num_rows else np.zeros((0, 2), np.int64)
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in got.column("sums").chunks] or [np.zeros(0)]).reshape(-1, 2, total)
    unique, back = np.unique(pairs, axis=0, return_inverse=True)
    added = np.zeros((len(unique), 2, total))
    np.add.at(added, back.ravel(), values)
    return unique, added


def _best_splits(sums: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each node: gain (0: no split helps), feature, edge, and [left n, left gradient, right n, right gradient]."""
    total = sums[:, :, slots[0]:slots[1]].sum(axis=2)
    n, g = total[:, 0], total[:, 1]
    gain, feature, edge, sides = np.zeros(len(n)), np.full(len(n), -1), np.zeros(len(n), np.int64), np.zeros((len(n), 4))
    rows = np.arange(len(n))
    for f in range(len(slots) - 1):
        left = np.cumsum(sums[:, :, slots[f]:slots[f + 1]], axis=2)[:, :, :-1]
        if not left.shape[2]:
            continue
        ln, lg = left[:, 0], left[:, 1]
        rn, rg = n[:, None] - ln, g[:, None] - lg
        ok = (ln > 0) & (rn > 0)
        here = np.where(ok, lg * lg / np.where(ok, ln, 1.0) + rg * rg / np.where(ok, rn, 1.0) - (g * g / n)[:, None], 0.0)
        at = here.argmax(axis=1)
        better = here[rows, at] > gain * (1 + _GAIN) + _GAIN
        gain, feature, edge = np.where(better, here[rows, at], gain), np.where(better, f, feature), np.where(better, at, edge)
        sides[better] = np.stack([ln[rows, at], lg[rows, at], rn[rows, at], rg[rows, at]], axis=1)[better]
    return gain, feature, edge, sides


def _rounds(models: list[Ensemble], slots: np.ndarray, level_sums, move, score, score_at: Sequence[int]) -> dict:
    """Grows the models tree by tree. ``level_sums(trees, level, open models)`` brings the sums of a
    level, ``move(trees, number)`` adds the finished trees to the predictions, ``score()`` gives each
    model's (rows, squared error). Returns {(model, trees): (rows, squared error)}."""
    held: dict = {}
    for done in range(1, max(m.n_trees for m in models) + 1):
        trees = [Tree.empty(m.depth) for m in models]
        going = np.array([i for i, m in enumerate(models) if done <= m.n_trees])
        level = 0
        while len(going):
            pairs, sums = level_sums(trees, level, going)
            gain, feature, edge, sides = _best_splits(sums, slots)
            if level == 0:
                for (i, _), x in zip(pairs.tolist(), sums[:, :, slots[0]:slots[1]].sum(axis=2)):
                    trees[i].value[0] = x[1] / x[0]
            for (i, node), w, f, e, (ln, lg, rn, rg) in zip(pairs.tolist(), gain.tolist(), feature.tolist(), edge.tolist(), sides.tolist()):
                if f >= 0:
                    t = trees[i]
                    t.feature[node], t.edge[node], t.gain[node], t.value[2 * node + 1], t.value[2 * node + 2] = f, e, w, lg / ln, rg / rn
            level += 1
            going = np.array(sorted({i for (i, _), f in zip(pairs.tolist(), feature.tolist()) if f >= 0 and models[i].depth > level}), np.int64)
        for i, m in enumerate(models):
            if done <= m.n_trees:
                m.trees.append(trees[i])  # a finished model's empty tree adds nothing
        move(trees, done)
        if done in score_at:
            held.update({(i, done): e for i, e in score().items()})
    return held


def _rounds_in_memory(cells: tuple, ss: np.ndarray, models: list[Ensemble], slots: np.ndarray, score_at: Sequence[int]) -> dict:
    """:func:`_rounds` over cells that one task holds."""
    rates, left_out = np.array([m.rate for m in models]), np.array([m.train_fold for m in models])
    now = [np.repeat(np.array([m.base for m in models])[:, None], len(ss), axis=1)]

    def level_sums(trees, level, going):
        sums = np.zeros((len(going), 2, 2 ** level, int(slots[-1])))
        _add_level(sums, Forest(trees), level, going, left_out, slots, cells, now[0])
        j, k = np.nonzero(sums[:, 0].any(axis=2))
        return np.stack([going[j], k + 2 ** level - 1], axis=1), np.ascontiguousarray(sums[j, :, k])

    def move(trees, done):
        now[0] = now[0] + rates[:, None] * Forest(trees).leaf_values(cells[1])

    def score():
        return {i: tuple(e) for i, e in enumerate(_squared_errors(cells, ss, now[0], left_out).tolist()) if e[0]}

    return _rounds(models, slots, level_sums, move, score, score_at)


def grow(df: DataFrame, label: str, features: Sequence[str], models: list[Ensemble], fold=None, score_at: Sequence[int] = (), held_cells: int = HELD_CELLS) -> dict:
    """Fits the models (settings with their left-out fold) on the complete rows. Returns {(model,
    trees): (rows, squared error)} of the left-out fold's rows for each tree count in ``score_at``.
    Without rows the models stay empty with a base of NaN.

    Up to ``held_cells`` counted cells go to every task and the models are dealt out over the tasks;
    beyond that the cells are dealt out and all models share each pass. The trees are the same, up
    to the rounding of sums."""
    spark = df.sparkSession
    edges = bin_edges(df.where(known(F.col(f"`{label}`")).isNotNull()), features)
    slots = np.r_[0, np.cumsum([len(e) + 1 for e in edges])].astype(np.int64)
    width = len(features)
    path = scratch_path(spark, "boosting-cells")
    _cells(df, label, features, fold if fold is not None else F.lit(0), edges).withColumn("known", F.lit(b"")).write.parquet(path)
    raw = spark.read.schema(CELLS).parquet(path)
    totals = raw.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("cells")).collect()
    for m in models:
        used = [r for r in totals if r["fold"] != m.train_fold]
        m.base = sum(r["s"] for r in used) / sum(r["n"] for r in used) if used else math.nan
        m.features, m.edges, m.trees = tuple(features), edges, []
    if any(math.isnan(m.base) for m in models) or not models:
        return {}
    n_cells = sum(r["cells"] for r in totals)
    if n_cells <= held_cells:
        return _grow_by_model(raw, models, slots, score_at, width)
    parts = max(math.ceil(n_cells / PART_CELLS), min(spark.sparkContext.defaultParallelism, math.ceil(n_cells / 2000)))
    rates, left_out = np.array([m.rate for m in models]), np.array([m.train_fold for m in models])
    kept = [_start(raw.repartition(parts), np.array([m.base for m in models])).persist()]

    def level_sums(trees, level, going):
        return _level_sums(kept[-1], Forest(trees), level, going, left_out, width, slots, parts <= DIRECT_PARTS)

    def move(trees, done):
        cells = _moved(kept[-1], Forest(trees), rates, width)
        if done % STORE_TREES == 0:
            place = scratch_path(spark, "boosting")
            cells.write.parquet(place)
            cells = spark.read.schema(CELLS).parquet(place).coalesce(parts)
        kept.append(cells.persist())
        if len(kept) > 2:
            kept.pop(0).unpersist()

    held = _rounds(models, slots, level_sums, move, lambda: _errors(kept[-1], left_out, width), score_at)
    for c in kept:
        c.unpersist()
    return held


def _grow_by_model(raw: DataFrame, models: list[Ensemble], slots: np.ndarray, score_at: Sequence[int], width: int) -> dict:
    """The models dealt out over tasks; each task holds all cells (counted before)."""
    spark = raw.sparkSession
    table = raw.toArrow().combine_chunks().to_batches()
    shared = spark.sparkContext.broadcast((_columns(table[0], width), table[0].column("ss").to_numpy()))
    tasks = min(len(models), spark.sparkContext.defaultParallelism)
    # deep models take longest: deal them out one by one
    turn = {i: k % tasks for k, i in enumerate(sorted(range(len(models)), key=lambda i: -models[i].depth * models[i].n_trees))}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for task in b.column(0).to_pylist():
                mine = [i for i in range(len(models)) if turn[i] == task]
                own = [replace(models[i], trees=[]) for i in mine]
                cells, ss = shared.value
                held = _rounds_in_memory(cells, ss, own, slots, score_at)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((mine, [m.trees for m in own], held))], pa.binary())], names=["done"])

    held: dict = {}
    for r in spark.range(0, tasks, 1, tasks).mapInArrow(fit, "done binary").collect():
        mine, trees, errors = pickle.loads(r["done"])
        for i, t in zip(mine, trees):
            models[i].trees = t
        held.update({(mine[i], t): e for (i, t), e in errors.items()})
    shared.unpersist()
    return held


def _errors(cells: DataFrame, left_out: np.ndarray, width: int) -> dict:
    """{model: (rows, squared error)} over each model's left-out fold."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(left_out), 2))
        for b in batches:
            sums += _squared_errors(_columns(b, width), b.column("ss").to_numpy(), _known(b, len(left_out)), left_out)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(left_out), dtype=np.int32)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["model", "n", "sse"])

    rows = cells.mapInArrow(add, "model int, n double, sse double").groupBy("model").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse")).collect()
    return {r["model"]: (r["n"], r["sse"]) for r in rows if r["n"]}


# ---- grid, refit, scoring ----

# The grid of tree depths, learning rates and tree counts.
DEPTHS, RATES, TREES = (2, 4, 6), (0.025, 0.05, 0.075, 0.1), (25, 50, 75, 100)


def gbt_grid(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str], depths: Sequence[int] = DEPTHS, rates: Sequence[float] = RATES,
             trees: Sequence[int] = TREES, folds: int = 3, seed: int = 666, fold=None) -> DataFrame:
    """max_depth, learning_rate, n_trees, rmse: the grid search (J9) over folds by a hash of the row
    key (or ``fold``). A model of fewer trees is the beginning of one with more, so each (depth, rate,
    fold) is grown once and scored at every tree count."""
    from domus.operators.models import hash_bucket
    own = fold if fold is not None else hash_bucket(keys, seed, folds)
    models = [Ensemble(d, r, max(trees), f) for d in depths for r in rates for f in range(folds)]
    errors = grow(df, label, features, models, own, trees)
    found: dict = {}
    for (i, t), (n, sse) in errors.items():
        m = models[i]
        found.setdefault((m.depth, m.rate, t), []).append(math.sqrt(max(sse, 0.0) / n))
    rows = [(d, float(r), t, float(np.mean(v))) for (d, r, t), v in sorted(found.items())]
    return df.sparkSession.createDataFrame(rows, "max_depth int, learning_rate double, n_trees int, rmse double")


def fit_gbt(df: DataFrame, label: str, features: Sequence[str], depth: int, rate: float, n_trees: int, seed: int = 666) -> Ensemble:
    """One model of all complete rows. Nothing is drawn at random; ``seed`` is there for the other models' sake."""
    model = Ensemble(depth, rate, n_trees)
    grow(df, label, features, [model])
    return model


def predict_trees(model: Ensemble, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Score every row (J6); null where a feature is missing. ``out`` replaces a column of that name."""
    width = len(model.features)
    shared = df.sparkSession.sparkContext.broadcast(model)
    x = F.array(*[known(F.col(f"`{c}`")) for c in model.features])

    def run(values):
        import pandas as pd
        m = shared.value
        matrix = np.array([[math.nan if v is None else v for v in row] for row in values], float).reshape(-1, width)
        y = m.predict_bins(_binned(np.nan_to_num(matrix), m.edges))
        return pd.Series(np.where(np.isnan(matrix).any(axis=1), np.nan, y))

    scored = F.pandas_udf(run, "double")(x)
    return df.withColumn(out, F.nanvl(scored, F.lit(None).cast("double")))


def refit_best(df: DataFrame, label: str, features: Sequence[str], grid: DataFrame, keys: Sequence[str], seed: int = 666, test_fraction: float = 0.3) -> DataFrame:
    """Refit with the best setting of a grid result on the train split (J9): the setting, and the RMSE
    on train and test rows."""
    from domus.operators.models import split_train_test
    best = grid.orderBy("rmse", "max_depth", "learning_rate", "n_trees").first()
    shape = "max_depth int, learning_rate double, n_trees int, train_rmse double, test_rmse double"
    if best is None:
        return df.sparkSession.createDataFrame([], shape)
    d = split_train_test(df, keys, seed, test_fraction)
    model = fit_gbt(d.where(F.col("split") == "train"), label, features, best["max_depth"], best["learning_rate"], best["n_trees"], seed)
    err = F.col("prediction") - known(F.col(f"`{label}`"))
    rm = {r["split"]: r["rmse"] for r in predict_trees(model, d).groupBy("split").agg(F.sqrt(F.avg(err * err)).alias("rmse")).collect()}
    return df.sparkSession.createDataFrame([(best["max_depth"], best["learning_rate"], best["n_trees"], rm.get("train"), rm.get("test"))], shape)


def importances(spark, model: Ensemble, features: Sequence[str]) -> DataFrame:
    """Each feature's part of the gain of all splits (J10), the greatest first."""
    gain = np.zeros(len(model.features))
    for tree in model.trees:
        inner = tree.feature >= 0
        np.add.at(gain, tree.feature[inner], tree.gain[inner])
    part = gain / gain.sum() if gain.sum() > 0 else gain
    rows = sorted(((f, float(v)) for f, v in zip(features, part)), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_table(spark, model: Ensemble, tree: int = 0) -> DataFrame:
    """node, feature, cut, value of one tree: nodes in heap order; a leaf has no feature; value: the mean
    residual of the node's rows (of the root: what the mean leaves, about zero)."""
    t = model.trees[tree]
    rows, alive = [], {0}
    for i in range(len(t.feature)):
        if i not in alive:
            continue
        f = int(t.feature[i])
        if f >= 0:
            alive |= {2 * i + 1, 2 * i + 2}
        rows.append((i, model.features[f] if f >= 0 else None, float(model.edges[f][t.edge[i]]) if f >= 0 else None, float(t.value[i])))
    return spark.createDataFrame(rows, "node int, feature string, cut double, value double")
