"""Formulas, their fits, Poisson regression, tail probabilities, boosted trees and exact selection against plain numpy."""

import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus.functions import distributions as D
from domus.operators import boosting as B
from domus.operators import models as M
from domus.operators import profile as P
from domus.operators.formula import Formula
from domus.operators.ranks import code_value, distinct_value_ranks, exact_quantiles, order_code
from domus.plans.q_models import LADDER


# ---- tails ----

@pytest.mark.parametrize("t,df,p", [(2.571, 5, 0.05), (12.706, 1, 0.05), (1.96, 1e7, 0.05), (3.169, 10, 0.01), (0.0, 7, 1.0), (-2.086, 20, 0.05)])
def test_t_table(t, df, p):
    assert D.t_two_sided(t, df) == pytest.approx(p, abs=5e-5)


@pytest.mark.parametrize("f,a,b,p", [(4.96, 1, 10, 0.05), (3.33, 5, 10, 0.05), (7.56, 3, 8, 0.01), (161.45, 1, 1, 0.05), (0.0, 3, 3, 1.0)])
def test_f_table(f, a, b, p):
    assert D.f_tail(f, a, b) == pytest.approx(p, abs=3e-4)


@given(st.floats(0.3, 60), st.floats(0.3, 60), st.floats(0.01, 0.99))
def test_beta_ratio_is_an_integral(a, b, x):
    # Simpson's rule on t = sin² u, whose integrand is smooth where a, b >= 1/2; symmetry everywhere
    assert D.beta_ratio(a, b, x) + D.beta_ratio(b, a, 1 - x) == pytest.approx(1, abs=1e-9)
    if a >= 1 and b >= 1:
        u = np.linspace(0, math.asin(math.sqrt(x)), 4001)
        y = 2 * np.sin(u) ** (2 * a - 1) * np.cos(u) ** (2 * b - 1)
        area = (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (u[1] - u[0]) / 3
        beta = math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
        assert D.beta_ratio(a, b, x) == pytest.approx(area / beta, rel=1e-6, abs=1e-9)


# ---- formulas ----

def test_parse():
    f = Formula.parse("log(y) ~ a * C(g) + b:a - b:a + a - 1")
    assert f.response == "log(y)" and f.terms == (("a",), ("C(g)",), ("a", "C(g)")) and not f.intercept
    assert Formula.parse("y ~ 1").terms == () and Formula.parse("y~a*b*c").terms[-1] == ("a", "b", "c")
    for bad in ("y", "y ~ ", "y ~ f(a)", "y ~ a +"):
        if bad == "y ~ a +":
            assert Formula.parse(bad).terms == (("a",),)
        else:
            with pytest.raises(ValueError):
                Formula.parse(bad)


def _orders(spark, n=500, seed=2):
    rng = np.random.default_rng(seed)
    status, prio, flag = rng.choice(list("FOP"), n, p=[.5, .45, .05]), rng.choice(["1", "2", "3", "4", "5"], n), rng.choice(list("ANR"), n)
    qty, disc = rng.integers(1, 51, n).astype(float), rng.integers(0, 11, n) / 100
    y = 900 * qty + 100 * (flag == "R") * qty + rng.normal(0, 2000, n) + 500 * (prio == "3")
    keep = ~((status == "P") & (prio == "5") & (flag == "A"))  # a cell that never occurs
    cols = [list(map(str, status[keep])), list(map(str, prio[keep])), list(map(str, flag[keep])), qty[keep].tolist(), disc[keep].tolist(), y[keep].tolist()]
    df = spark.createDataFrame(list(zip(*cols)), "o_orderstatus string, o_orderpriority string, l_returnflag string, l_quantity double, l_discount double, l_extendedprice double")
    return df, cols


def _design(formula, cols):
    """A full dummy design, by hand; least squares finds the rank."""
    names = dict(zip(["o_orderstatus", "o_orderpriority", "l_returnflag", "l_quantity", "l_discount"], cols))
    f = Formula.parse(formula)
    out = [np.ones(len(cols[0]))] if f.intercept else []
    for term in f.terms:
        parts = [np.ones((len(cols[0]), 1))]
        for x in term:
            if x.startswith("C("):
                v = np.array(names[x[2:-1]])
                parts.append(np.stack([(v == k).astype(float) for k in sorted(set(v))], axis=1))
            elif x.startswith("log("):
                parts.append(np.log(np.array(names[x[4:-1]]))[:, None])
            else:
                parts.append(np.array(names[x])[:, None])
        block = parts[0]
        for p in parts[1:]:
            block = (block[:, :, None] * p[:, None, :]).reshape(len(block), -1)
        out += list(block.T)
    return np.stack(out, axis=1), f.intercept


def test_all_thirteen_formulas(spark):
    df, cols = _orders(spark)
    y = np.array(cols[-1])
    got = {r["formula"]: r for r in M.formula_ladder(df, LADDER).collect()}
    assert len(got) == 13
    for formula in LADDER:
        x, one = _design(formula, cols)
        b, _, rank, _ = np.linalg.lstsq(x, y, rcond=1e-10)
        n, sse = len(y), ((y - x @ b) ** 2).sum()
        total = ((y - y.mean()) ** 2).sum() if one else (y ** 2).sum()
        llf = -n / 2 * (math.log(2 * math.pi) + math.log(sse / n) + 1)
        r = got[formula]
        assert (r["n"], r["k"]) == (n, rank - one), formula
        assert r["r2"] == pytest.approx(1 - sse / total, abs=1e-9) and r["llf"] == pytest.approx(llf, rel=1e-9)
        assert r["aic"] == pytest.approx(-2 * llf + 2 * rank, rel=1e-9) and r["adj_r2"] == pytest.approx(1 - sse / total * (n - one) / (n - rank), abs=1e-9)


def test_summary_and_prediction(spark):
    df, cols = _orders(spark, 300, 5)
    formula = "l_extendedprice ~ C(l_returnflag) * l_quantity + log(l_quantity)"
    fit = M.fit_formulas(df, [formula])[0]
    names = fit.names
    q, flag, y = np.array(cols[3]), np.array(cols[2]), np.array(cols[-1])
    x = np.stack([np.ones(len(q)), flag == "N", flag == "R", q, np.log(q), (flag == "N") * q, (flag == "R") * q], axis=1)
    order = ["(intercept)", "l_returnflag[N]", "l_returnflag[R]", "l_quantity", "log(l_quantity)", "l_returnflag[N]:l_quantity", "l_returnflag[R]:l_quantity"]
    assert sorted(names) == sorted(order)
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    s2 = ((y - x @ b) ** 2).sum() / (len(y) - 7)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2)
    for i, name in enumerate(order):
        j = names.index(name)
        assert fit.coef[j] == pytest.approx(b[i], rel=1e-6) and fit.std_err[j] == pytest.approx(se[i], rel=1e-6)
        assert fit.p[j] == pytest.approx(D.t_two_sided(b[i] / se[i], len(y) - 7), rel=1e-5, abs=1e-12)
    new = spark.createDataFrame([("R", 7.0), ("A", 7.0), ("X", 7.0), (None, 7.0), ("N", None)], "l_returnflag string, l_quantity double")
    got = [r["prediction"] for r in M.predict_formula(new, fit).collect()]
    want = [x_ @ b for x_ in ([1, 0, 1, 7, math.log(7), 0, 7], [1, 0, 0, 7, math.log(7), 0, 0])]
    assert got[:2] == pytest.approx(want, rel=1e-7) and got[2:] == [None] * 3


def test_fits_of_too_little(spark):
    schema = "y double, x double, g string"
    for rows in ([], [(1.0, 2.0, "a")], [(1.0, float("nan"), "a"), (None, 1.0, "b")]):
        df = spark.createDataFrame(rows, schema)
        row = M.formula_summary(df, "y ~ x + C(g)").collect()[0]
        assert row["adj_r2"] is None and row["aic"] is None and row["f"] is None
        assert M.formula_ladder(df, ["y ~ x", "y ~ 1"]).count() == 2
        assert M.ridge_cv(df, "y", ["x"], [1.0], ["g"]).count() == 1


# ---- Poisson ----

def test_poisson_against_newton(spark):
    rng = np.random.default_rng(4)
    n = 600
    x1, g = rng.uniform(-1, 2, n), rng.choice(list("abc"), n)
    y = rng.poisson(np.exp(0.5 + 0.8 * x1 + 0.4 * (g == "b") - 0.9 * (g == "c")))
    df = spark.createDataFrame([(float(a), str(b), float(c)) for a, b, c in zip(x1, g, y)] + [(None, "a", 1.0)], "x1 double, g string, y double")
    fit = M.poisson_irls(df, "y ~ x1 + C(g)")
    x = np.stack([np.ones(n), x1, g == "b", g == "c"], axis=1).astype(float)
    b = np.zeros(4)
    for _ in range(50):
        mu = np.exp(x @ b)
        b += np.linalg.solve(x.T @ (x * mu[:, None]), x.T @ (y - mu))
    assert fit.converged and fit.names == ["(intercept)", "x1", "g[b]", "g[c]"] and fit.n == n
    assert list(fit.coef) == pytest.approx(list(b), rel=1e-8)
    assert list(fit.std_err) == pytest.approx(list(np.sqrt(np.diag(np.linalg.inv(x.T @ (x * np.exp(x @ b)[:, None]))))), rel=1e-6)
    assert max(abs(r["score"]) for r in M.poisson_scores(df, "y ~ x1 + C(g)").collect()) < 1e-9
    ml, _ = M.fit_poisson(df.where("g <> 'c'").select("x1", "y"), "y", ["x1"])
    mine = M.poisson_irls(df.where("g <> 'c'"), "y ~ x1")
    assert mine.coef[1] == pytest.approx(ml.coefficients[0], rel=1e-6)


def test_poisson_of_little(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "x double, y double")
    assert math.isnan(M.poisson_irls(df, "y ~ x").coef[0]) and math.isnan(M.poisson_irls(df.limit(0), "y ~ x").coef[0])
    assert [r["coef"] for r in M.poisson_summary(df, "y ~ x").collect()] == [None, None]
    with pytest.raises(ValueError):
        M.poisson_irls(spark.createDataFrame([(1.0, -1.0)], "x double, y double"), "y ~ x")


# ---- trees ----

def _plain_tree(x, g, depth):
    """A leaf's value for every row: greedy splits on all cuts, first feature and cut on ties."""
    out = np.zeros(len(g))

    def split(rows, left):
        best = None
        if left:
            for f in range(x.shape[1]):
                values = np.unique(x[rows, f])
                for a, b in zip(values, values[1:]):
                    l, r = rows[x[rows, f] <= a], rows[x[rows, f] > a]
                    gain = g[l].sum() ** 2 / len(l) + g[r].sum() ** 2 / len(r) - g[rows].sum() ** 2 / len(rows)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, l, r)
        if best is None:
            out[rows] = g[rows].mean()
            return
        split(best[1], left - 1)
        split(best[2], left - 1)

    split(np.arange(len(g)), depth)
    return out


@pytest.mark.parametrize("held", [100_000, 0])
def test_boosting_equals_plain_boosting(spark, monkeypatch, held):
    """Both ways of dealing out the work; the written predictions too."""
    monkeypatch.setattr(B, "STORE_TREES", 2)
    monkeypatch.setattr(B, "DIRECT_PARTS", 0 if held == 0 else 32)
    rng = np.random.default_rng(6)
    n = 160
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.normal(0, 1, n).round(2)], axis=1).astype(float)
    y = 3 * (x[:, 0] > 6) + x[:, 1] * x[:, 2] + rng.normal(0, .2, n)
    fold = np.arange(n) % 3
    rows = [(int(f), float(v), *map(float, r)) for f, v, r in zip(fold, y, x)] + [(0, 1.0, None, 1.0, 1.0), (1, float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "fold int, y double, a double, b double, c double").repartition(3)
    models = [B.Ensemble(2, .3, 5, 0), B.Ensemble(3, .1, 3, 2), B.Ensemble(1, 1.0, 5, -1)]
    errors = B.grow(df, "y", ["a", "b", "c"], models, F.col("fold"), (3, 5), held_cells=held)
    for i, m in enumerate(models):
        train = fold != m.train_fold
        base = y[train].mean()
        now, used = np.full(n, base), np.flatnonzero(train)
        for t in range(m.n_trees):
            tree_x, tree_g = x[used], (y - now)[used]
            leaf = _plain_tree(tree_x, tree_g, m.depth)
            # the held-out rows follow the cuts: read them off the model, check the train rows exactly
            bins = B._binned(x, m.edges)
            step = B.Forest([m.trees[t]]).leaf_values(bins)[0]
            assert step[used] == pytest.approx(leaf, abs=1e-9)
            now = now + m.rate * step
            if (i, t + 1) in errors:
                held_rows = fold == m.train_fold
                assert errors[i, t + 1][0] == held_rows.sum() and errors[i, t + 1][1] == pytest.approx(((y - now)[held_rows] ** 2).sum(), rel=1e-9)
        scored = [r["prediction"] for r in M.predict_trees(m, spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").coalesce(1)).collect()]
        assert scored == pytest.approx(list(now), rel=1e-9)
    assert (0, 5) in errors and (1, 5) not in errors or errors[1, 5] == errors[1, 3]


def test_trees_of_little(spark):
    schema = "y double, x double, k long"
    empty = spark.createDataFrame([], schema)
    assert M.gbt_grid(empty, "y", ["x"], ["k"], depths=(2,), rates=(.1,), trees=(2,)).collect() == []
    flat = spark.createDataFrame([(1.0, 2.0, i) for i in range(6)], schema)
    model = M.fit_gbt(flat, "y", ["x"], 3, .1, 2)
    assert [r["importance"] for r in M.importances(spark, model, ["x"]).collect()] == [0.0]
    got = M.predict_trees(model, spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")).collect()
    assert [r["prediction"] for r in got] == [1.0, None, None]


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("x"), (F.col("id") > 2500).cast("double").alias("y"))
    edges = B.bin_edges(df, ["x"])
    assert 100 < len(edges[0]) <= B.MAX_BINS
    model = M.fit_gbt(df, "y", ["x"], 1, 1.0, 1)
    wrong = M.predict_trees(model, df).where(F.abs(F.col("prediction") - F.col("y")) > 0.5).count()
    assert wrong < 5000 / 100


# ---- selection and ranks ----

HARD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1 - 2**-53, 1 + 2**-52, -1.0, 2.0**1023, 1.7976931348623157e308, -1.7976931348623157e308,
        math.inf, -math.inf, 3.0, 1e-10, -1e-10, 4503599627370496.0, 1e17, 0.1, -0.1, 7.999999999999999, 8.0, 8.000000000000002]


def test_codes_order_and_come_back(spark):
    values = HARD + [float(v) for v in np.random.default_rng(0).standard_normal(300) * 10.0 ** np.random.default_rng(1).integers(-300, 300, 300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_code(F.col("v")).alias("c")).withColumn("back", code_value(F.col("c"))).collect()
    assert all(r["back"] == r["v"] for r in rows)
    by_value = sorted(rows, key=lambda r: r["v"])
    assert [r["c"] for r in by_value] == sorted(r["c"] for r in rows) and len({r["c"] for r in rows}) == len({r["v"] for r in rows})
    for r in rows:  # the bits themselves
        bits = int(np.float64(abs(r["v"])).view(np.int64))
        assert r["c"] == (bits if r["v"] > 0 else -bits)


def test_24_columns_of_different_scales(spark):
    rng = np.random.default_rng(8)
    columns = {f"c{i}": rng.standard_normal(400) * 10.0 ** (12 * (i % 5) - 24) + (1e9 if i % 7 == 0 else 0) for i in range(20)}
    columns |= {"flat": np.full(400, 7.5), "hot": np.where(np.arange(400) < 200, 3.25, rng.standard_normal(400)), "ints": rng.integers(-5, 5, 400).astype(float), "far": rng.choice([1e-300, 1e300, -1e300, 0.0], 400)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], ", ".join(f"{c} double" for c in columns)).repartition(5)
    for r in P.describe_numeric(df).collect():
        want = np.percentile(columns[r["column_name"]], [25, 50, 75])
        assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(list(want), rel=1e-12, abs=0)


def test_no_rows_are_exchanged(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), (F.col("id") * 1.5).alias("v"))
    got = {(r["g"], r["prob"]): r["q"] for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got[3, 0.5] == 1.5 * (3 + 10 * 49.5)
    null_group = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None), ("b", float("nan"))], "g string, v double")
    assert {(r["g"], r["q"]) for r in exact_quantiles(null_group, "v", [0.5], ["g"]).collect()} == {(None, 2.0), ("a", 5.0)}
    assert exact_quantiles(null_group.limit(0), "v", [0.5], ["g"]).collect() == []


def test_ranks_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    values = np.r_[rng.integers(0, 40, 500) / 4, np.full(300, 2.5)]
    groups = [None if i % 5 == 0 else f"g{i % 3}" for i in range(800)]
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, values)] + [("g0", None), ("g9", float("nan"))], "g string, v double").repartition(6)
    got = {(r["g"], r["v"]): (r["cnt"], r["start"], r["n"]) for r in distinct_value_ranks(df, "v", ["g"], part_values=7).collect()}
    want = {}
    for g in set(groups):
        own = [v for k, v in zip(groups, values) if k == g]
        for v in set(own):
            want[g, v] = (own.count(v), sum(x < v for x in own), len(own))
    assert got == want


def test_qq_fit_of_a_constant(spark):
    row = P.qq_fit(spark.createDataFrame([(2.0,)] * 9, "v double"), "v").first()
    assert (row["slope"], row["intercept"], row["r"], row["n"]) == (0.0, 2.0, None, 9)
    assert P.qq_fit(spark.createDataFrame([(None,)], "v double"), "v").first()["n"] == 0


# ---- correlations, bins ----

def test_correlations_of_many_columns_with_nulls(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((300, 30)) + 1e7 * (np.arange(30) % 4 == 0)
    x[rng.random(x.shape) < .2] = np.nan
    x[0, 5], x[:, 7] = 1e12, 3.0  # a far value in some pairs, a constant column
    cols = [f"c{i}" for i in range(30)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)], ", ".join(f"{c} double" for c in cols)).repartition(4)
    got = {(r["var1"], r["var2"]): r["r"] for r in P.corr_long(df, cols).collect()}
    assert len(got) == 900
    for i in range(30):
        for j in range(30):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if i == j:
                continue
            if 7 in (i, j):
                assert got[cols[i], cols[j]] is None
            else:
                assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)


def test_bins_without_nan_and_without_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 10.0, nan), (nan, 1.0, 2.0), (1.0, nan, 3.0), (None, 1.0, 2.0)], "x double, y double, v double")
    assert {tuple(r) for r in P.scatter_bins(df, "x", "y", 2).collect()} == {(0, 0, 1), (1, 1, 1)}
    assert {(r["cell_x"], r["cell_y"], r["count"], r["mean_value"]) for r in P.grid_heatmap(df, "x", "y", 5.0, "v").collect()} == {(0, 0, 1, 1.0), (2, 2, 1, None)}
    bins = {r["bin"]: r for r in P.residual_bins(df, "v", "x", 2).collect()}
    assert bins[0]["n"] == 2 and bins[0]["mean_residual"] == pytest.approx(-1.5) and bins[1]["mean_residual"] is None
    empty = df.limit(0)
    for out in (P.scatter_bins(empty, "x", "y"), P.grid_heatmap(empty, "x", "y", 1.0), P.residual_bins(empty, "v", "x"), P.histogram(empty, "x"), P.density_by_category(empty, "x", "v"),
                P.box_by_category(empty, "x", "v"), P.zscore_tails(empty, "v", "x"), P.qq_points(empty, "v")):
        assert out.collect() == []
    assert {r["var1"] for r in P.corr_long(empty, ["x", "y"]).collect()} == {"x", "y"} and P.describe_numeric(empty).count() == 3
    assert all(r["slope"] is None for r in P.ols_screen(empty, "v", ["x", "y"]).collect())


def test_amounts_beyond_a_bigint(spark):
    from domus.functions.scalar import fingerprint, price_after_currency
    row = spark.createDataFrame([("CHF 12345678901234567890", "k", 1e30)], "t string, k string, p double").select(price_after_currency("t").alias("a"), fingerprint("k", "p").alias("f")).first()
    assert row["a"] is None and row["f"] is None


def test_a_ladder_by_cells_equals_the_matrix_of_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["k", "l", None]), float(rng.integers(0, 9)), float(rng.choice([1.5, 2.5, float("nan"), 40.0])), float(rng.normal(100, 3))) for _ in range(400)]
    rows = [(*r[:3], None if i % 17 == 0 else r[3], None if i % 23 == 0 else r[4]) for i, r in enumerate(rows)]
    df = spark.createDataFrame([tuple(None if x is None else x if isinstance(x, float) else str(x) for x in r) for r in rows], "g string, h string, q double, d double, y double")
    formulas = ["y ~ C(g) * C(h) * q", "y ~ C(g) * log(q)", "y ~ C(h) + d", "y ~ q * d", "y ~ C(g) - 1"]
    by_cells = M.fit_formulas(df, formulas)
    scans = []
    monkeypatch.setattr(M, "_moments_by_cells", lambda *a: scans.append(a))
    by_rows = M.fit_formulas(df, formulas)
    assert len(scans) == 1
    for a, b in zip(by_cells, by_rows):
        assert (a.names, a.n, a.k) == (b.names, b.n, b.k)
        assert a.coef == pytest.approx(b.coef, rel=1e-6, abs=1e-6) and (a.r2, a.llf) == pytest.approx((b.r2, b.llf), rel=1e-7, abs=1e-9)


def test_a_ladder_sends_no_rows_to_python(spark, monkeypatch):
    from domus.operators import gram as G
    df, _ = _orders(spark, 300, 5)
    monkeypatch.setattr(G, "matrix_sums", lambda *a, **k: pytest.fail("rows were sent"))
    assert M.formula_ladder(df, LADDER).count() == 13
