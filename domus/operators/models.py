"""Price (hedonic) models (J3–J14) on Spark ML and one-pass Gram aggregates.

* Linear models with a closed form (OLS, ridge, their cross-validation and
  comparisons of formulas) share one *Gram pass*: a single aggregate of
  Σxxᵀ, Σxy, Σy², n — per fold when folds are needed. The result is
  (p+1)² numbers per fold, solved on the driver; 60 ridge fits or 13 nested
  OLS fits cost one scan instead of 60 or 13.
* A Poisson fit is a few such passes with weights; boosted trees are in
  :mod:`domus.operators.boosting`.
* Splits and folds come from a hash of the row key, so they are stable under
  any repartitioning (``randomSplit`` is not)."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.functions.distributions import f_tail, normal_two_sided, t_two_sided
from domus.operators import gram as G
from domus.operators.boosting import DEPTHS, fit_gbt, gbt_grid, importances, predict_trees, refit_best, tree_table  # noqa: F401
from domus.operators.formula import Formula, column_of, design_column, learn_levels, value_of


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def hash_bucket(keys: Sequence[str], seed: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(_q(k)) for k in keys]), F.lit(buckets)).cast("int")


def split_train_test(df: DataFrame, keys: Sequence[str], seed: int = 666, test_fraction: float = 0.3,
                     col: str = "split", number: Column | None = None) -> DataFrame:
    """Deterministic 70/30 split by hash of the row key (J3): adds ``split``
    = 'train' | 'test'. The fraction is taken in 1/1000 steps. ``number``: a whole number of the row to
    take in place of the hash."""
    b = hash_bucket(keys, seed, 1000) if number is None else F.pmod(number, F.lit(1000))
    return df.withColumn(col, F.when(b < int(round(test_fraction * 1000)), F.lit("test")).otherwise(F.lit("train")))


def add_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 666, col: str = "fold", number: Column | None = None) -> DataFrame:
    """Fold number 0..k-1 by hash of the row key, or by ``number`` (stable folds for CV)."""
    return df.withColumn(col, hash_bucket(keys, seed, k) if number is None else F.pmod(number, F.lit(k)).cast("int"))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


# ---------------------------------------------------------------- Gram pass

def gram(df: DataFrame, label: str, features: Sequence[str], group: str | None = None) -> dict:
    """Moments of z = [1, x1..xp, y] over the complete cases (no null or NaN in any used column),
    optionally per ``group`` (a fold number). Returns {group: :class:`Moments`}.

    Two scans: the means, then every Σ (z_i − m_i)(z_j − m_j) with the same shift m in all groups
    (so groups can be added), as matrix products of batches (see :mod:`domus.operators.gram`)."""
    return gram_of(df, [F.col(_q(c)) for c in [*features, label]], F.col(_q(group)) if group else None)


def gram_of(df: DataFrame, columns: Sequence[Column], group: Column | None = None) -> dict:
    """:func:`gram` of expressions; the last one is the response."""
    whole = df.select(*[G.known(c).alias(f"c{i}") for i, c in enumerate(columns)]).na.drop()
    shift = G.column_means(whole, [F.col(f"c{i}") for i in range(len(columns))])
    sums = G.matrix_sums(df, columns, G.complete_products(shift), group)
    m = len(columns) + 1
    if group is None:
        return {None: Moments(sums[0]["zz"] if sums else np.zeros((m, m)), shift)}
    return {g: Moments(kinds["zz"], shift) for g, kinds in sums.items()}


class Moments:
    """Shifted second moments of [1, x, y]; adding two joins their rows, subtracting takes rows out."""

    def __init__(self, sums: np.ndarray, shift: np.ndarray):
        self.sums, self.shift = sums, shift

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.sums + other.sums, self.shift)

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.sums - other.sums, self.shift)

    @property
    def n(self) -> float:
        return self.sums[0, 0]

    def centred(self) -> np.ndarray:
        """Σ (z − mean)(z − mean)ᵀ of the rows themselves."""
        s = self.sums[0, 1:]
        return self.sums[1:, 1:] - np.outer(s, s) / max(self.n, 1.0)

    def fit(self, idx: Sequence[int], alpha: float = 0.0) -> np.ndarray:
        """[intercept, b...] for predictors ``idx`` (1-based), intercept not
        penalised; collinear or constant predictors share the smallest
        solution (pseudo-inverse of the scaled moments)."""
        c, sel = self.centred(), [i - 1 for i in idx]
        xx, xy = c[np.ix_(sel, sel)], c[sel, -1]
        scale = np.sqrt(np.diag(xx))
        scale[scale == 0] = 1.0
        b = np.linalg.pinv((xx + alpha * np.eye(len(sel))) / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (xy / scale) / scale
        mean = self.shift + (self.sums[0, 1:] / max(self.n, 1.0))
        return np.r_[mean[-1] - b @ mean[sel], b]

    def sse(self, idx: Sequence[int], b: np.ndarray) -> float:
        """Σ (y − ŷ)² of these rows under coefficients ``b`` (fitted on any rows)."""
        sel = [0, *idx, self.sums.shape[0] - 1]
        # ŷ in shifted terms: y − ŷ = (y − m_y) − Σ b (x − m_x) − (b0 + Σ b m_x − m_y)
        w = np.r_[-(b[0] + b[1:] @ self.shift[[i - 1 for i in idx]] - self.shift[-1]), -b[1:], 1.0]
        return max(0.0, float(w @ self.sums[np.ix_(sel, sel)] @ w))

    def raw(self) -> np.ndarray:
        """Σ vvᵀ of v = [x, y] itself, for models without an intercept."""
        s = self.sums[0, 1:]
        return self.sums[1:, 1:] + np.outer(s, self.shift) + np.outer(self.shift, s) + self.n * np.outer(self.shift, self.shift)

    def independent(self, idx: Sequence[int], intercept: bool = True) -> list[int]:
        """Those of ``idx`` that do not depend linearly on earlier ones (or the intercept): Cholesky
        factors of the scaled moments, column by column."""
        c = self.centred() if intercept else self.raw()
        size = np.sqrt(np.maximum(np.diag(self.raw()), 0.0))
        kept: list[int] = []
        rows: list[np.ndarray] = []
        for i in idx:
            scale = math.sqrt(max(c[i - 1, i - 1], 0.0))
            if scale <= 1e-9 * size[i - 1] or scale == 0.0:
                continue
            own = np.array([c[i - 1, j - 1] for j in kept])
            w = np.zeros(len(kept))
            for r, row in enumerate(rows):
                w[r] = (own[r] - row[:r] @ w[:r]) / row[r]
            rest = c[i - 1, i - 1] - w @ w
            if rest > 1e-10 * c[i - 1, i - 1]:
                kept.append(i)
                rows.append(np.r_[w, math.sqrt(rest)])
        return kept

    def rank(self, idx: Sequence[int]) -> int:
        c, sel = self.centred(), [i - 1 for i in idx]
        xx = c[np.ix_(sel, sel)]
        scale = np.sqrt(np.diag(xx))
        scale[scale == 0] = 1.0
        return int(np.linalg.matrix_rank(xx / np.outer(scale, scale), tol=1e-12, hermitian=True)) if sel else 0


@dataclass
class Fit:
    """A least-squares fit by formula. ``coef`` has None for columns that depend on earlier ones (their
    cells never occur, or repeat); statistics that are not defined are None."""
    formula: Formula
    levels: dict
    names: list
    coef: list
    std_err: list
    t: list
    p: list
    n: int
    k: int
    r2: float | None
    adj_r2: float | None
    f: float | None
    f_p: float | None
    llf: float | None
    aic: float | None
    bic: float | None


def _defined(x) -> float | None:
    return None if x is None or not math.isfinite(x) else float(x)


def solve(g: Moments, idx: Sequence[int], names: Sequence[str], formula: Formula, levels: dict) -> Fit:
    """The least-squares fit of the columns ``idx`` of ``g`` (statsmodels' definitions of the
    statistics: AIC = −2·llf + 2·parameters; without an intercept R² is about zero, not the mean)."""
    one = formula.intercept
    kept = g.independent(idx, one)
    sel = [i - 1 for i in kept]
    c = g.centred() if one else g.raw()
    scale = np.sqrt(np.diag(c)[sel])
    inv = np.linalg.inv(c[np.ix_(sel, sel)] / np.outer(scale, scale)) / np.outer(scale, scale) if sel else np.zeros((0, 0))
    slope = inv @ c[sel, -1] if sel else np.zeros(0)
    n, k = int(g.n), len(sel)
    mean = g.shift + g.sums[0, 1:] / max(g.n, 1.0)
    b = np.r_[mean[-1] - slope @ mean[sel] if one else 0.0, slope]
    sse, sst = g.sse(kept, b), float(c[-1, -1])
    sse = sse if sse > 1e-14 * sst else 0.0
    params, free = k + one, n - k - one
    s2 = sse / free if free > 0 else math.nan
    var = np.r_[s2 * (1 / max(n, 1) + mean[sel] @ inv @ mean[sel]), s2 * np.diag(inv)]
    se = np.sqrt(np.maximum(var, 0.0)) if free > 0 else np.full(len(b), math.nan)
    of = dict(zip(kept, range(1, k + 1)))
    rows = [("(intercept)", 0)] * one + [(name, of.get(i)) for i, name in zip(idx, names)]
    usable = n > 0
    coef = [_defined(b[j]) if j is not None and usable else None for _, j in rows]
    err = [_defined(se[j]) if j is not None and usable else None for _, j in rows]
    t = [_defined(x / e) if x is not None and e else None for x, e in zip(coef, err)]
    r2 = 1 - sse / sst if sst > 0 else math.nan
    adj = 1 - (1 - r2) * (n - one) / free if free > 0 else math.nan
    f = (sst - sse) / k / s2 if k and free > 0 and s2 > 0 else math.nan
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(sse / n) + 1) if n and sse > 0 else math.nan
    return Fit(formula, levels, [name for name, _ in rows], coef, err, t, [_defined(t_two_sided(x, free)) if x is not None else None for x in t], n, k,
               _defined(r2), _defined(adj), _defined(f), _defined(f_tail(f, k, free)), _defined(llf),
               _defined(-2 * llf + 2 * params), _defined(-2 * llf + math.log(max(n, 1)) * params))


#: More combinations of levels, or more different values, go through :func:`gram_of`.
MAX_CELLS, MAX_VALUES = 10_000, 8


def _moments_by_cells(df: DataFrame, design: Sequence[tuple], response: str, levels: dict) -> Moments | None:
    """:func:`gram_of` of a design's columns (their parts) and the response, from one native aggregate: in
    a cell (a combination of levels) a column is 0 or a product of plain values, so counts, means and
    covariances of these few products in each cell give all sums. None if the design has no categories
    or too many cells or values."""
    products = [tuple(f for f, level in parts if level is None) for parts in design] + [(response,)]
    values = [v for v in dict.fromkeys(products) if v]
    groups = sorted({column_of(f) for parts in design for f, level in parts if level is not None})
    if not groups or math.prod(len(levels[c]) for c in groups) > MAX_CELLS or len(values) > MAX_VALUES:
        return None
    marked = {v for v, parts in zip(products, design) if v and len(parts) > len(v)}

    def value(v: tuple) -> Column:
        x = G.known(functools.reduce(operator.mul, [value_of(f) for f in v]))
        # an infinite value times a mark of 0 is not known
        return F.when(F.abs(x) < math.inf, x) if v in marked else x

    q, names = len(values), [f"u{i}" for i in range(len(values))]
    rows = df.select(*[F.col(_q(c)).cast("string").alias(f"g{i}") for i, c in enumerate(groups)], *[value(v).alias(u) for v, u in zip(values, names)]).na.drop()
    for i, c in enumerate(groups):
        rows = rows.where(F.col(f"g{i}").isin(levels[c]))
    both = [(i, j) for i in range(q) for j in range(i, q)]
    cells = rows.groupBy(*[f"g{i}" for i in range(len(groups))]).agg(
        F.count("*").alias("n"), *[F.avg(u).alias(f"m{i}") for i, u in enumerate(names)],
        *[(F.var_pop(names[i]) if i == j else F.covar_pop(names[i], names[j])).alias(f"c{i}_{j}") for i, j in both]).collect()
    width, total = len(products), sum(r["n"] for r in cells)
    at = np.array([values.index(v) if v else q for v in products])  # q: the constant 1
    found = []
    for r in cells:
        level = {c: r[f"g{i}"] for i, c in enumerate(groups)}
        mark = np.array([float(all(x is None or level[column_of(f)] == x for f, x in parts)) for parts in design] + [1.0])
        mean = np.array([*[r[f"m{i}"] for i in range(q)], 1.0])
        c = np.zeros((q + 1, q + 1))
        for i, j in both:
            c[i, j] = c[j, i] = r[f"c{i}_{j}"]
        found.append((r["n"], mark, np.where(mark > 0, mean[at], 0.0), c))
    shift = sum((n * mean for n, _, mean, _ in found), np.zeros(width)) / max(total, 1)
    sums = np.zeros((width + 1, width + 1))
    for n, mark, mean, c in found:
        k, on = np.r_[1.0, mean - shift], np.flatnonzero(mark)
        sums += n * np.outer(k, k)
        sums[np.ix_(on + 1, on + 1)] += n * c[np.ix_(at[on], at[on])]
    return Moments(sums, shift)


def fit_formulas(df: DataFrame, formulas: Sequence[str | Formula], train: DataFrame | None = None) -> list[Fit]:
    """Least-squares fits of formulas with one response (J4, J11, J13): the levels of categories in one
    aggregate (of ``train``, if given), and ONE matrix of products over the complete cases of all
    formulas' columns; every model is solved from its part of that matrix. With categories of few
    combinations the matrix comes from one aggregate by these."""
    parsed = [f if isinstance(f, Formula) else Formula.parse(f) for f in formulas]
    if len({f.response for f in parsed}) > 1:
        raise ValueError("the formulas have different responses")
    levels = learn_levels(df if train is None else train, parsed)
    place: dict[str, int] = {}
    design: list[tuple] = []
    own = []
    for f in parsed:
        named = f.columns(levels)
        for name, parts in named:
            if name not in place:
                place[name] = len(design) + 1
                design.append(parts)
        own.append([name for name, _ in named])
    if not parsed:
        return []
    g = _moments_by_cells(df, design, parsed[0].response, levels)
    if g is None:
        g = gram_of(df, [*[design_column(parts, levels) for parts in design], value_of(parsed[0].response)])[None]
    return [solve(g, [place[n] for n in names], names, f, levels) for f, names in zip(parsed, own)]


def predict_formula(df: DataFrame, fit: Fit, out: str = "prediction") -> DataFrame:
    """Score every row with a fit (J6): null where a column is missing or a level was not learnt. The
    prediction is that of the response as the formula writes it (``log(y)`` stays a logarithm)."""
    parts = dict(fit.formula.columns(fit.levels))
    y = F.lit(0.0)
    for name, b in zip(fit.names, fit.coef):
        x = G.known(design_column(parts[name], fit.levels)) if name in parts else F.lit(1.0)
        y = y + x * F.lit(0.0 if b is None else b)
    return df.withColumn(out, y if fit.n else F.lit(None).cast("double"))


def formula_ladder(df: DataFrame, formulas: Sequence[str | Formula], texts: Sequence[str] | None = None) -> DataFrame:
    """formula, k, n, r2, adj_r2, llf, aic: one row a model (J13), in one pass for all of them; models
    are compared on the rows complete for all."""
    rows = [(t, f.k, f.n, f.r2, f.adj_r2, f.llf, f.aic) for t, f in zip(texts or formulas, fit_formulas(df, formulas))]
    return df.sparkSession.createDataFrame(rows, "formula string, k int, n long, r2 double, adj_r2 double, llf double, aic double")


def nested_models(df: DataFrame, label: str, formulas: Sequence[Sequence[str]]) -> DataFrame:
    """:func:`formula_ladder` of plain columns: each formula is a list of them."""
    models = [Formula(label, tuple((c,) for c in f)) for f in formulas]
    return formula_ladder(df, models, [label + " ~ " + (" + ".join(f) if f else "1") for f in formulas])


def fit_gram(df: DataFrame, label: str, features: Sequence[str], alpha: float = 0.0) -> np.ndarray:
    """[intercept, b...] of OLS or ridge (J4, J7) from one Gram pass."""
    return gram(df, label, features)[None].fit(range(1, len(features) + 1), alpha)


def coefficients(spark, features: Sequence[str], b: np.ndarray) -> DataFrame:
    """term, coef: the intercept, then the features by name."""
    return spark.createDataFrame([("(intercept)", float(b[0])), *sorted(zip(features, map(float, b[1:])))], "term string, coef double")


def predict_linear(df: DataFrame, features: Sequence[str], b: np.ndarray, out: str = "prediction") -> DataFrame:
    """Score every row (J6): a plain expression; null where a feature is missing."""
    y = F.lit(float(b[0]))
    for c, w in zip(features, b[1:]):
        x = F.col(_q(c)).cast("double")
        y = y + F.lit(float(w)) * F.when(~F.isnan(x), x)
    return df.withColumn(out, y)


def ols_summary(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """:func:`formula_summary` of plain columns."""
    return formula_summary(df, Formula(label, tuple((c,) for c in features)))


def formula_summary(df: DataFrame, formula: str | Formula) -> DataFrame:
    """term, coef, std_err, t, p_value of a formula (J11), and for each row the model's n, k, r2, adj_r2,
    f, f_p_value, llf, aic, bic. A term that depends on earlier ones has nulls."""
    fit = fit_formulas(df, [formula])[0]
    whole = (fit.n, fit.k, fit.r2, fit.adj_r2, fit.f, fit.f_p, fit.llf, fit.aic, fit.bic)
    rows = [(*row, *whole) for row in zip(fit.names, fit.coef, fit.std_err, fit.t, fit.p)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, std_err double, t double, p_value double, n long, k int, r2 double, adj_r2 double, "
                                                 "f double, f_p_value double, llf double, aic double, bic double")


def ridge_cv(df: DataFrame, label: str, features: Sequence[str], alphas: Sequence[float],
             keys: Sequence[str], folds: int = 5, seed: int = 666, fold: Column | None = None, number: Column | None = None) -> DataFrame:
    """Mean RMSE over ``folds`` for every ridge ``alpha`` (J8): one Gram
    aggregate per fold (one scan); train Gram = total − fold Gram; the
    held-out SSE comes from the fold's Gram. Mean of per-fold RMSE, as
    ``sqrt(-cross_val_score(...)).mean()`` computes it. ``fold`` overrides
    the hash of the row keys by a column of one's own."""
    d = df.withColumn("__fold", fold) if fold is not None else add_folds(df, keys, folds, seed, "__fold", number)
    per = gram(d, label, features, "__fold")
    if not per:
        return df.sparkSession.createDataFrame([(float(a), None, 0) for a in alphas], "alpha double, rmse double, folds int")
    total = functools.reduce(operator.add, per.values())
    idx = list(range(1, len(features) + 1))
    rows = []
    for a in alphas:
        rm = [math.sqrt(gf.sse(idx, (total - gf).fit(idx, a)) / gf.n) for _, gf in sorted(per.items()) if gf.n and (total - gf).n]
        rows.append((float(a), float(np.mean(rm)) if rm else None, len(rm)))
    return df.sparkSession.createDataFrame(rows, "alpha double, rmse double, folds int")


# ---------------------------------------------------------------- Spark ML fits

def fit_linear(df: DataFrame, label: str, features: Sequence[str], alpha: float = 0.0):
    """OLS (alpha=0, J4) or ridge (J7) with an unpenalised intercept via
    Spark ML's normal-equation solver. sklearn's ridge penalty α maps to
    Spark's ``regParam`` = α·σ_pop(y)/n with ``standardization=False``."""
    d = assemble(df.na.drop(subset=[label, *features]), features)
    reg = 0.0
    if alpha:
        st = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(_q(label))).alias("s")).first()
        reg = alpha * st["s"] / st["n"]
    lr = LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=reg,
                          elasticNetParam=0.0, standardization=False, fitIntercept=True)
    return lr.fit(d)


def coefficient_table(spark, model, features: Sequence[str], with_summary: bool = False) -> DataFrame:
    """Coefficients by name (sorted) + intercept; with ``with_summary`` the
    standard errors, t and p values of the normal solver's summary (J11)."""
    coefs = [float(x) for x in model.coefficients]
    rows = [("(intercept)", float(model.intercept))] + sorted(zip(features, coefs))
    if not with_summary:
        return spark.createDataFrame(rows, "term string, coef double")
    s = model.summary
    se, t, p = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    # Spark lists the intercept last
    names = list(features) + ["(intercept)"]
    allc = coefs + [float(model.intercept)]
    rows = [(n, c, float(a), float(b), float(q)) for n, c, a, b, q in zip(names, allc, se, t, p)]
    return spark.createDataFrame(rows, "term string, coef double, std_err double, t double, p_value double")


def fit_poisson(df: DataFrame, label: str, features: Sequence[str]):
    """Poisson GLM with log link by Spark ML (J12); :func:`poisson_irls` takes a formula."""
    d = assemble(df.na.drop(subset=[label, *features]), features)
    glm = GeneralizedLinearRegression(featuresCol="features", labelCol=label, family="poisson",
                                      link="log", maxIter=50, tol=1e-10)
    return glm.fit(d), d


@dataclass
class PoissonFit:
    """Log-linear Poisson regression: coefficients by column, the intercept first."""
    names: list
    coef: np.ndarray
    std_err: np.ndarray
    z: np.ndarray
    p: np.ndarray
    n: int
    deviance: float
    rounds: int
    converged: bool


def poisson_irls(df: DataFrame, formula: str, rounds: int = 50, tol: float = 1e-12) -> PoissonFit:
    """Poisson regression with log link by reweighted least squares.

    Each round is one pass that sums Σ w vvᵀ of v = [1, x, z] with weights w = μ and the working
    response z = η + (y − μ)/μ, and the deviance; a step that raises the deviance is halved. It ends
    when a whole step changes the deviance by less than ``tol`` of it. A column that depends on
    earlier ones has a coefficient of 0 and no standard error; a negative response raises an error,
    and without complete rows, or where all responses are 0, everything is NaN."""
    f = Formula.parse(formula)
    levels = learn_levels(df, [f])
    named = f.columns(levels)
    columns = [*[design_column(parts, levels) for _, parts in named], value_of(f.response)]
    rows = df.select(*[G.known(c).alias(f"c{i}") for i, c in enumerate(columns)])
    used = [F.col(f"c{i}") for i in range(len(columns))]
    g = gram_of(rows, used)[None]
    mean = g.shift + g.sums[0, 1:] / max(g.n, 1.0)
    least = rows.agg(F.min(f"c{len(columns) - 1}")).first()[0]
    if least is not None and least < 0:
        raise ValueError("a Poisson response is not negative")
    kept = g.independent(range(1, len(columns)), True)
    names = ["(intercept)", *[name for name, _ in named]]
    nothing = np.full(len(names), math.nan)
    if not g.n or mean[-1] <= 0:
        return PoissonFit(names, nothing, nothing, nothing, nothing, int(g.n), math.nan, 0, False)
    centre = mean[[i - 1 for i in kept]]
    used = [*[F.col(f"c{i - 1}") - F.lit(float(m)) for i, m in zip(kept, centre)], used[-1]]

    def sums(b: np.ndarray) -> tuple[np.ndarray, float]:
        def weigh(x: np.ndarray):
            y = x[:, -1]
            eta = np.clip(b[0] + x[:, :-1] @ b[1:], -700.0, 700.0)
            mu = np.exp(eta)
            ratio = np.where(y > 0, y / mu, 1.0)
            return mu, eta + (y - mu) / mu, 2.0 * (y * np.log(ratio) - (y - mu))
        done = G.matrix_sums(rows.where(F.forall(F.array(*rows.columns), lambda c: c.isNotNull())), used, G.weighted_products(weigh))[0]
        return done["vv"], float(done["loss"][0, 0])

    b = np.r_[math.log(mean[-1]), np.zeros(len(kept))]
    vv, loss = sums(b)
    done, n_rounds = False, 0
    while not done and n_rounds < rounds:
        step = np.linalg.solve(vv[:-1, :-1], vv[:-1, -1]) - b
        size = 1.0
        while True:
            n_rounds += 1
            after, new = sums(b + size * step)
            if new <= loss * (1 + 1e-14) or size < 1e-3 or n_rounds >= rounds:
                break
            size /= 2
        done = size == 1.0 and abs(loss - new) <= tol * (abs(new) + 1e-30)
        b, vv, loss = b + size * step, after, new
    inv = np.linalg.inv(vv[:-1, :-1])
    turn = np.eye(len(b))
    turn[0, 1:] = -centre  # back to columns that are not centred
    b, inv = turn @ b, turn @ inv @ turn.T
    coef, se = np.zeros(len(names)), np.full(len(names), math.nan)
    at = [0, *kept]
    coef[at], se[at] = b, np.sqrt(np.diag(inv))
    z = coef / se
    return PoissonFit(names, coef, se, z, np.array([normal_two_sided(x) for x in z]), int(g.n), loss, n_rounds, done)


def poisson_summary(df: DataFrame, formula: str) -> DataFrame:
    """term, coef, std_err, z, p_value, n, deviance of a Poisson fit (J12); null where not defined."""
    m = poisson_irls(df, formula)
    rows = [(t, *map(_defined, row), m.n, _defined(m.deviance)) for t, *row in zip(m.names, m.coef, m.std_err, m.z, m.p)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, std_err double, z double, p_value double, n long, deviance double")


def poisson_scores(df: DataFrame, formula: str) -> DataFrame:
    """term, score of a Poisson fit: Σ x(y − μ) over Σ |x| y of its column, about 0 at the maximum."""
    m = poisson_irls(df, formula)
    f = Formula.parse(formula)
    levels = learn_levels(df, [f])
    columns = [F.lit(1.0), *[G.known(design_column(parts, levels)) for _, parts in f.columns(levels)]]
    rows = df.select(G.known(value_of(f.response)).alias("y"), *[c.alias(f"x{i}") for i, c in enumerate(columns)]).na.drop()
    eta = functools.reduce(operator.add, [F.lit(float(b)) * F.col(f"x{i}") for i, b in enumerate(m.coef)])
    rest = F.col("y") - F.exp(eta)
    sums = rows.agg(*[F.try_divide(F.sum(F.col(f"x{i}") * rest), F.sum(F.abs(f"x{i}") * F.col("y"))).alias(f"s{i}") for i in range(len(columns))])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"s{i}").alias("score")) for i, t in enumerate(m.names)])).alias("r")).select("r.*")


def predict(model, df: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Score every row with a Spark ML model (J6, J14). A row with a missing
    feature is kept and has a null prediction."""
    known = F.lit(True)
    for c in features:
        x = F.col(_q(c)).cast("double")
        known = known & x.isNotNull() & ~F.coalesce(F.isnan(x), F.lit(False))
    filled = df.select("*", known.alias("__known"), *[F.when(known, F.col(_q(c)).cast("double")).otherwise(0.0).alias(f"__f{i}")
                                                     for i, c in enumerate(features)])
    used = [f"__f{i}" for i in range(len(features))]
    scored = model.transform(VectorAssembler(inputCols=used, outputCol="features").transform(filled))
    return scored.withColumn("prediction", F.when(F.col("__known"), F.col("prediction"))).drop("features", "__known", *used).withColumnRenamed("prediction", out)
