"""Models against closed forms computed with numpy (no sklearn here)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.operators import models as M


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 600
    x1 = rng.normal(10, 2, n)
    x2 = rng.uniform(0, 1, n)
    y = 3 + 2 * x1 - 5 * x2 + rng.normal(0, 1, n)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    df = spark.createDataFrame(rows, "k long, x1 double, x2 double, y double").repartition(4)
    return df, np.column_stack([x1, x2]), y


def _ridge(X, y, a):
    Xc, yc = X - X.mean(0), y - y.mean()
    b = np.linalg.solve(Xc.T @ Xc + a * np.eye(X.shape[1]), Xc.T @ yc)
    return y.mean() - X.mean(0) @ b, b


def test_ols_and_residuals(spark, data):
    df, X, y = data
    m = M.fit_linear(df, "y", ["x1", "x2"])
    b0, b = _ridge(X, y, 0.0)
    assert m.intercept == pytest.approx(b0, rel=1e-9)
    assert list(m.coefficients) == pytest.approx(list(b), rel=1e-9)
    pred = M.predict(m, df, ["x1", "x2"])
    assert pred.agg(F.sum(F.col("y") - F.col("prediction"))).first()[0] == pytest.approx(0, abs=1e-6)
    t = {r["term"]: r for r in M.coefficient_table(spark, m, ["x1", "x2"], with_summary=True).collect()}
    assert t["x1"]["coef"] == pytest.approx(b[0], rel=1e-9) and t["x1"]["p_value"] < 1e-6


def test_ridge_gram_and_ml_mapping(spark, data):
    df, X, y = data
    g = M.gram(df, "y", ["x1", "x2"])[None]
    b = g.fit([1, 2], 5.0)
    b0, bb = _ridge(X, y, 5.0)
    assert b[0] == pytest.approx(b0, rel=1e-8) and list(b[1:]) == pytest.approx(list(bb), rel=1e-8)
    m = M.fit_linear(df, "y", ["x1", "x2"], alpha=5.0)
    assert list(m.coefficients) == pytest.approx(list(bb), rel=1e-4)
    # alpha = 0 gives OLS
    assert list(g.fit([1, 2], 0.0)[1:]) == pytest.approx(list(_ridge(X, y, 0)[1]), rel=1e-9)


def test_ridge_cv_brute_force(spark, data):
    df, X, y = data
    alphas = [0.1, 10.0]
    got = {r["alpha"]: r["rmse"] for r in M.ridge_cv(df, "y", ["x1", "x2"], alphas, ["k"], folds=5).collect()}
    folds = {r["k"]: r["fold"] for r in M.add_folds(df, ["k"], 5, 666).collect()}
    f = np.array([folds[i] for i in range(len(y))])
    for a in alphas:
        rm = []
        for k in range(5):
            tr, te = f != k, f == k
            b0, b = _ridge(X[tr], y[tr], a)
            rm.append(np.sqrt(np.mean((y[te] - b0 - X[te] @ b) ** 2)))
        assert got[a] == pytest.approx(np.mean(rm), rel=1e-8)


def test_nested_models(spark, data):
    df, X, y = data
    out = {r["formula"]: r for r in M.nested_models(df, "y", [[], ["x1"], ["x1", "x2"]]).collect()}
    n = len(y)
    b0, b = _ridge(X, y, 0)
    sse = ((y - b0 - X @ b) ** 2).sum()
    llf = -n / 2 * (np.log(2 * np.pi) + np.log(sse / n) + 1)
    r = out["y ~ x1 + x2"]
    assert r["llf"] == pytest.approx(llf, rel=1e-9) and r["aic"] == pytest.approx(-2 * llf + 6, rel=1e-9)
    assert out["y ~ 1"]["r2"] == pytest.approx(0, abs=1e-9)
    assert r["r2"] > out["y ~ x1"]["r2"]


def test_split_is_stable(spark, data):
    df, _, _ = data
    a = sorted(r["k"] for r in M.split_train_test(df, ["k"]).where("split = 'test'").collect())
    b = sorted(r["k"] for r in M.split_train_test(df.repartition(9), ["k"]).where("split = 'test'").collect())
    assert a == b and 0.2 < len(a) / 600 < 0.4


def test_poisson_sum_identity(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, 400)
    lab = rng.poisson(np.exp(1 + x))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, lab)], "x double, n double")
    m, d = M.fit_poisson(df, "n", ["x"])
    s = m.transform(d).agg(F.sum("prediction"), F.sum("n")).first()
    assert s[0] == pytest.approx(s[1], rel=1e-8)


def test_gbt_grid_prefix_scoring(spark, data):
    df, _, _ = data
    out = M.gbt_grid(df, "y", ["x1", "x2"], ["k"], depths=(2,), rates=(0.1,), trees=(5, 10), folds=2)
    r = {row["n_trees"]: row["rmse"] for row in out.collect()}
    assert set(r) == {5, 10} and r[10] < r[5]
    imp = M.importances(spark, M.fit_gbt(df, "y", ["x1", "x2"], 2, 0.1, 10), ["x1", "x2"]).collect()
    assert imp[0]["feature"] == "x1"


def test_gram_wide_matches_numpy(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(300, 40))
    y = X @ rng.normal(size=40) + rng.normal(size=300)
    cols = [f"x{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(X, y)],
                               ", ".join(f"{c} double" for c in cols) + ", y double")
    g = M.gram(df, "y", cols)[None]
    Z = np.column_stack([X, y])
    Z -= Z.mean(axis=0)
    assert np.allclose(g.centred(), Z.T @ Z, rtol=1e-10, atol=1e-9)
    b = g.fit(list(range(1, 41)))
    assert np.allclose(b[1:], np.linalg.lstsq(np.column_stack([np.ones(300), X]), y, rcond=None)[0][1:], atol=1e-8)


def test_epoch_seconds_constant_and_collinear_columns(spark):
    rng = np.random.default_rng(5)
    t = 1.7e9 + rng.uniform(0, 1e5, 400)
    y = 2 * t + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(float(a), float(b), 3.0, float(a) + 1) for a, b in zip(t, y)] + [(float("nan"), 1.0, 3.0, 1.0), (1.0, None, 3.0, 1.0)],
                               "t double, y double, c double, d double")
    from domus.operators import profile as P
    one = P.ols_one(df.where("y is not null"), "y", "t").first()
    assert one["n"] == 400 and one["slope"] == pytest.approx(2, abs=1e-4)
    screen = {r["column_name"]: r for r in P.ols_screen(df, "y", ["t", "c", "d"]).collect()}
    assert screen["t"]["slope"] == pytest.approx(one["slope"]) and screen["c"]["slope"] is None and screen["t"]["aic"] == pytest.approx(one["aic"], rel=1e-6)
    nested = {r["formula"]: r for r in M.nested_models(df, "y", [["t"], ["t", "c"], ["t", "d"]]).collect()}
    assert nested["y ~ t"]["k"] == nested["y ~ t + c"]["k"] == nested["y ~ t + d"]["k"] == 1
    assert nested["y ~ t"]["aic"] == pytest.approx(one["aic"], rel=1e-4)
    assert M.gram(df.limit(0), "y", ["t"])[None].n == 0


def test_every_row_is_scored(spark, data):
    df, _, _ = data
    m = M.fit_linear(df, "y", ["x1", "x2"])
    rows = spark.createDataFrame([(1.0, None), (1.0, float("nan")), (1.0, 0.5)], "x1 double, x2 double")
    got = [r["prediction"] for r in M.predict(m, rows, ["x1", "x2"]).collect()]
    assert got[:2] == [None, None] and got[2] is not None
    plain = [r["prediction"] for r in M.predict_linear(rows, ["x1", "x2"], M.fit_gram(df, "y", ["x1", "x2"])).collect()]
    assert plain[:2] == [None, None] and plain[2] == pytest.approx(got[2], rel=1e-9)


def test_summary_matches_spark_ml(spark, data):
    df, _, _ = data
    mine = {r["term"]: r for r in M.ols_summary(df, "y", ["x1", "x2"]).collect()}
    ml = {r["term"]: r for r in M.coefficient_table(spark, M.fit_linear(df, "y", ["x1", "x2"]), ["x1", "x2"], with_summary=True).collect()}
    for t in ml:
        assert mine[t]["std_err"] == pytest.approx(ml[t]["std_err"], rel=1e-6) and mine[t]["t"] == pytest.approx(ml[t]["t"], rel=1e-6)
