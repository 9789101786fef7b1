"""Distributed ranks and exact quantiles against brute force (numpy)."""

import numpy as np
import pytest

from domus.operators import profile as P
from domus.operators.ranks import exact_quantiles, order_statistics


def _data(spark, parts):
    rng = np.random.default_rng(7)
    vals = list(rng.normal(100, 15, 2000).round(1))
    vals += [42.0] * 1000  # a hot value: a third of all rows
    rows = [(i, float(v), "g%d" % (i % 3)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k long, v double, g string").repartition(parts), vals, rows


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_order_statistics_ranks(spark, parts):
    df, vals, _ = _data(spark, parts)
    os = order_statistics(df, "v", chunk=97)  # small chunks: the hot value spans many
    got = sorted((r["rank"], r["v"]) for r in os.collect())
    assert [r for r, _ in got] == list(range(1, len(vals) + 1))
    assert [v for _, v in got] == sorted(vals)


def test_exact_quantiles_grouped(spark):
    df, _, rows = _data(spark, 5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["prob"]): r["q"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in ("g0", "g1", "g2"):
        xs = np.array([v for _, v, gg in rows if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-12)


def test_describe_matches_numpy(spark):
    df, vals, _ = _data(spark, 4)
    d = P.describe_numeric(df, ["v"]).first()
    xs = np.array(vals)
    assert d["count"] == len(xs)
    assert d["mean"] == pytest.approx(xs.mean())
    assert d["std"] == pytest.approx(xs.std(ddof=1))
    assert d["p25"] == pytest.approx(np.percentile(xs, 25))
    assert d["p75"] == pytest.approx(np.percentile(xs, 75))
    approx = P.describe_numeric(df, ["v"], exact=False).first()
    assert approx["p50"] == pytest.approx(np.percentile(xs, 50), rel=0.02)


def test_qq_points_brute_force(spark):
    df, vals, _ = _data(spark, 3)
    pts = sorted((r["rank"], r["osm"], r["osr"]) for r in P.qq_points(df, "v").collect())
    n = len(vals)
    from statistics import NormalDist
    nd = NormalDist()
    for i in (1, 2, n // 2, n - 1, n):
        m = 0.5 ** (1 / n)
        pos = m if i == n else (1 - m if i == 1 else (i - 0.3175) / (n + 0.365))
        assert pts[i - 1][1] == pytest.approx(nd.inv_cdf(pos), abs=1e-6)
    assert [p[2] for p in pts] == sorted(vals)
    fit = P.qq_fit(df, "v").first()
    assert fit["n"] == n and 0 < fit["r"] <= 1


def test_skew_kurt_bias_corrected(spark):
    df, vals, _ = _data(spark, 2)
    r = P.skew_kurt(df, ["v"]).first()
    x = np.array(vals)
    n = len(x)
    m2 = ((x - x.mean()) ** 2).mean()
    m3 = ((x - x.mean()) ** 3).mean()
    m4 = ((x - x.mean()) ** 4).mean()
    g1, g2 = m3 / m2 ** 1.5, m4 / m2 ** 2 - 3
    G1 = g1 * np.sqrt(n * (n - 1)) / (n - 2)
    G2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    assert r["skew"] == pytest.approx(G1, rel=1e-9) and r["kurt"] == pytest.approx(G2, rel=1e-9)


def test_box_and_tails(spark):
    df, vals, rows = _data(spark, 3)
    b = {r["g"]: r for r in P.box_by_category(df, "g", "v").collect()}
    xs = np.array([v for _, v, g in rows if g == "g0"])
    q1, q3 = np.percentile(xs, [25, 75])
    iqr = q3 - q1
    assert b["g0"]["n_outliers"] == int(((xs < q1 - 1.5 * iqr) | (xs > q3 + 1.5 * iqr)).sum())
    assert b["g0"]["whisker_hi"] == xs[xs <= q3 + 1.5 * iqr].max()
    t = P.zscore_tails(df, "v", "k", 10)
    assert t.where("tail = 'low'").count() == 10 and t.where("tail = 'high'").count() == 10
    top = max(r["z"] for r in t.collect())
    x = np.array(vals)
    assert top == pytest.approx((x.max() - x.mean()) / x.std(), rel=1e-9)


def test_density_integrates_to_one(spark):
    df, _, _ = _data(spark, 3)
    d = sorted((r["x"], r["density"]) for r in P.density_by_category(df.where("g = 'g1'"), "g", "v", 400).collect())
    xs = np.array([x for x, _ in d])
    ys = np.array([y for _, y in d])
    assert float(np.sum((ys[1:] + ys[:-1]) / 2 * np.diff(xs))) == pytest.approx(1.0, abs=0.01)


def test_binned_density_close_to_exact(spark):
    df, _, _ = _data(spark, 3)
    exact = {(r["g"], r["point"]): r["density"] for r in P.density_by_category(df, "g", "v", 40).collect()}
    binned = {(r["g"], r["point"]): r["density"] for r in P.density_by_category(df, "g", "v", 40, binned=4000).collect()}
    assert exact.keys() == binned.keys()
    peak = max(exact.values())
    assert max(abs(exact[k] - binned[k]) for k in exact) < 1e-3 * peak


def test_corr_of_many_columns(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(500, 16))
    X[:, 1] += X[:, 0]
    cols = [f"c{i}" for i in range(16)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], ", ".join(f"{c} double" for c in cols))
    r = {(a[0], a[1]): a[2] for a in P.corr_long(df, cols).collect()}
    want = np.corrcoef(X.T)
    assert len(r) == 256
    assert all(r[a, b] == pytest.approx(want[i, j], abs=1e-12) for i, a in enumerate(cols) for j, b in enumerate(cols))


def test_nan_and_constant_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(i, x, 5.0, g) for i, (x, g) in enumerate([(1.0, "a"), (2.0, "a"), (nan, "a"), (4.0, "b"), (5.0, "b"), (None, "c"), (7.0, "d")])],
                               "k long, x double, c double, g string")
    d = {r["column_name"]: r for r in P.describe_numeric(df, ["x", "c"]).collect()}
    assert (d["x"]["count"], d["x"]["mean"], d["x"]["max"], d["x"]["p50"]) == (5, pytest.approx(3.8), 7.0, 4.0)
    assert {r["column_name"]: r["skew"] is None for r in P.skew_kurt(df, ["x", "c"]).collect()} == {"x": False, "c": True}
    r = {(a["var1"], a["var2"]): a["r"] for a in P.corr_long(df, ["k", "x", "c"]).collect()}
    xs = [(0, 1.0), (1, 2.0), (3, 4.0), (4, 5.0), (6, 7.0)]
    assert r["k", "x"] == pytest.approx(np.corrcoef(*zip(*xs))[0, 1]) and r["x", "c"] is None and r["c", "c"] == 1.0
    assert [t["column_name"] for t in P.corr_topk(df, "x", ["k", "x", "c"], 3).collect()] == ["k", "x", "c"]
    assert sum(h["count"] for h in P.histogram(df, "x", 4).collect()) == 5
    z = P.zscore_tails(df, "c", "k", 2).collect()
    assert len(z) == 4 and all(t["z"] is None for t in z)
    dens = P.density_by_category(df, "g", "x", 5).collect()
    assert {x["g"] for x in dens if x["density"] is not None} == {"a", "b"}
    box = {b["g"]: b["n"] for b in P.box_by_category(df, "g", "x").collect()}
    assert box == {"a": 2, "b": 2, "d": 1}
    assert P.missing_report(df.limit(0)).where("percent is null").count() == 4
    from domus.operators.filters import nonzero
    assert nonzero(df, "x").count() == 5


def test_wide_correlations_use_the_same_rule(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 15)) + 1e6
    x[:, 3] = 7.0
    cols = [f"c{i}" for i in range(15)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    r = {(a["var1"], a["var2"]): a["r"] for a in P.corr_long(df).collect()}
    assert len(r) == 225 and r["c0", "c3"] is None and r["c3", "c3"] == 1.0
    assert r["c0", "c1"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1], rel=1e-6)
