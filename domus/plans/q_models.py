"""Feature and model queries (J)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from domus.functions.scalar import dround
from domus.operators import columns as C
from domus.operators import models as M
from domus.operators import profile as P
from domus.plans.q_columns import KEYS
from domus.plans.q_stats import _lineitem_part, _sig_cols
from domus.plans.registry import load, query, sql_sig

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


def _dummy_sql(drop: dict | None = None) -> str:
    drop = drop or {}
    cols = ["o_orderkey"]
    for c, vals in (("o_orderstatus", STATUSES), ("o_orderpriority", PRIORITIES)):
        for v in vals:
            if drop.get(c) == v:
                continue
            cols.append(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"")
    return "SELECT " + ", ".join(cols) + " FROM orders"


@query("dummies", ids="J1", sql=_dummy_sql())
def dummies_q(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return C.dummies(o)


BASELINE = {"o_orderstatus": "F", "o_orderpriority": "5-LOW"}


@query("dummies_baseline", ids="J2", bench=True, sql=_dummy_sql(BASELINE))
def dummies_baseline_q(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return C.dummies(o, ["o_orderstatus", "o_orderpriority"], drop=BASELINE)


TWO = ["l_quantity", "l_discount"]
TWO_SQL = """
WITH s AS (SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
                  var_pop(l_quantity) AS v11, var_pop(l_discount) AS v22, covar_pop(l_quantity, l_discount) AS v12,
                  covar_pop(l_quantity, l_extendedprice) AS c1y, covar_pop(l_discount, l_extendedprice) AS c2y,
                  var_pop(l_extendedprice) AS vy, count(*) AS n
           FROM lineitem),
b AS (SELECT *, ({a} * c1y - v12 * c2y) / (({a}) * ({d}) - v12 * v12) AS b1,
                ({d} * c2y - v12 * c1y) / (({a}) * ({d}) - v12 * v12) AS b2 FROM s),
c AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM b)
"""


def _two_sql(alpha: float) -> str:
    # ridge on centred data: (S + alpha I) b = s_xy with S = n * covariance
    a = f"(v22 + {alpha!r} / n)"
    d = f"(v11 + {alpha!r} / n)"
    body = TWO_SQL.replace("{a}", a).replace("{d}", d)
    return body + ("SELECT '(intercept)' AS term, " + sql_sig("b0") + " AS coef FROM c UNION ALL "
                   "SELECT 'l_discount', " + sql_sig("b2") + " FROM c UNION ALL "
                   "SELECT 'l_quantity', " + sql_sig("b1") + " FROM c")


@query("ols_two", ids="J4 J6", bench=True, sql=_two_sql(0.0))
def ols_two_q(spark, sf):
    return _sig_cols(M.coefficients(spark, TWO, M.fit_gram(load(spark, sf, "lineitem"), "l_extendedprice", TWO)), ["coef"])


@query("ols_two_ml", ids="J4", sql=_two_sql(0.0))
def ols_two_ml_q(spark, sf):
    """The same fit by Spark ML's normal solver."""
    m = M.fit_linear(load(spark, sf, "lineitem"), "l_extendedprice", TWO)
    return _sig_cols(M.coefficient_table(spark, m, TWO), ["coef"])


@query("ridge_two", ids="J7", sql=_two_sql(1.0))
def ridge_two_q(spark, sf):
    """Ridge with α = 1 (unpenalised intercept), solved from one Gram
    aggregate — the exact ridge objective."""
    return _sig_cols(M.coefficients(spark, TWO, M.fit_gram(load(spark, sf, "lineitem"), "l_extendedprice", TWO, 1.0)), ["coef"])


def _nested_sql() -> str:
    y = "l_extendedprice"
    body = TWO_SQL.replace("{a}", "v22").replace("{d}", "v11")
    n = "CAST(n AS DOUBLE)"

    def row(formula, k, sse):
        r2 = f"(1 - ({sse}) / ({n} * vy))"
        llf = f"(-{n} / 2 * ({math.log(2 * math.pi)!r} + ln(({sse}) / {n}) + 1))"
        return (f"SELECT '{formula}' AS formula, {k} AS k, n, {sql_sig(r2)} AS r2, "
                f"{sql_sig(f'1 - (1 - {r2}) * ({n} - 1) / ({n} - {k} - 1)')} AS adj_r2, {sql_sig(llf)} AS llf, "
                f"{sql_sig(f'-2 * {llf} + 2 * ({k} + 1)')} AS aic FROM c")
    rows = [row(f"{y} ~ 1", 0, f"{n} * vy"),
            row(f"{y} ~ l_quantity", 1, f"{n} * (vy - c1y * c1y / v11)"),
            row(f"{y} ~ l_discount", 1, f"{n} * (vy - c2y * c2y / v22)"),
            row(f"{y} ~ l_quantity + l_discount", 2, f"{n} * (vy - b1 * c1y - b2 * c2y)")]
    return body + "\nUNION ALL\n".join(rows)


@query("nested_models", ids="J13 J11", bench=True, sql=_nested_sql())
def nested_models_q(spark, sf):
    formulas = [[], ["l_quantity"], ["l_discount"], ["l_quantity", "l_discount"]]
    out = M.nested_models(load(spark, sf, "lineitem"), "l_extendedprice", formulas)
    return _sig_cols(out, ["r2", "adj_r2", "llf", "aic"])


@query("ols_summary", ids="J11 J4", sql=TWO_SQL.replace("{a}", "v22").replace("{d}", "v11") + """,
e AS (SELECT *, (vy - b1 * c1y - b2 * c2y) * n / (n - 3) AS s2, v11 * v22 - v12 * v12 AS det FROM c),
f AS (SELECT *, sqrt(s2 * v22 / (n * det)) AS se1, sqrt(s2 * v11 / (n * det)) AS se2,
             sqrt(s2 / n * (1 + (m1 * m1 * v22 - 2 * m1 * m2 * v12 + m2 * m2 * v11) / det)) AS se0 FROM e)
""" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS term, {sql_sig(b)} AS coef, {sql_sig(s)} AS std_err, {sql_sig(f'{b} / {s}')} AS t FROM f"
    for t, b, s in (("(intercept)", "b0", "se0"), ("l_quantity", "b1", "se1"), ("l_discount", "b2", "se2"))))
def ols_summary_q(spark, sf):
    """Coefficient table with standard errors and t values."""
    out = M.ols_summary(load(spark, sf, "lineitem"), "l_extendedprice", TWO).select("term", "coef", "std_err", "t")
    return _sig_cols(out, ["coef", "std_err", "t"])


LADDER = ["l_extendedprice ~ C(o_orderstatus) * C(o_orderpriority) * C(l_returnflag)", "l_extendedprice ~ C(o_orderstatus) * C(o_orderpriority)",
          "l_extendedprice ~ C(o_orderpriority) * C(l_returnflag)", "l_extendedprice ~ C(o_orderstatus):C(l_returnflag)", "l_extendedprice ~ C(o_orderpriority)",
          "l_extendedprice ~ C(o_orderstatus)", "l_extendedprice ~ C(l_returnflag) - 1", "l_extendedprice ~ 1", "l_extendedprice ~ l_quantity",
          "l_extendedprice ~ log(l_quantity)", "l_extendedprice ~ l_quantity + l_discount", "l_extendedprice ~ C(l_returnflag) * l_quantity",
          "l_extendedprice ~ C(o_orderpriority) + C(o_orderpriority):log(l_quantity)"]


def _ladder_sql() -> str:
    """Each model by its closed form: cell means, one or two centred predictors, or a line for each cell."""
    y = "l_extendedprice"
    n = "CAST(n AS DOUBLE)"
    cells = lambda by: f"SELECT sum(v) AS sse, count(*) - 1 AS k FROM (SELECT var_pop({y}) * count(*) AS v FROM d GROUP BY {by})"
    lines = lambda by, x: (f"SELECT sum(v) AS sse, 2 * count(*) - 1 AS k FROM (SELECT (var_pop({y}) - covar_pop({y}, {x}) * covar_pop({y}, {x}) / var_pop({x})) * count(*) AS v "  # noqa: E731
                           f"FROM d GROUP BY {by})")
    line = lambda x: f"SELECT (var_pop({y}) - covar_pop({y}, {x}) * covar_pop({y}, {x}) / var_pop({x})) * count(*) AS sse, 1 AS k FROM d"
    two = (f"SELECT count(*) * (vy - (v22 * c1 * c1 - 2 * v12 * c1 * c2 + v11 * c2 * c2) / (v11 * v22 - v12 * v12)) AS sse, 2 AS k FROM d, "
           f"(SELECT var_pop({y}) AS vy, var_pop(l_quantity) AS v11, var_pop(l_discount) AS v22, covar_pop(l_quantity, l_discount) AS v12, "
           f"covar_pop(l_quantity, {y}) AS c1, covar_pop(l_discount, {y}) AS c2 FROM d) GROUP BY vy, v11, v22, v12, c1, c2")
    parts = [cells("o_orderstatus, o_orderpriority, l_returnflag"), cells("o_orderstatus, o_orderpriority"), cells("o_orderpriority, l_returnflag"), cells("o_orderstatus, l_returnflag"),
             cells("o_orderpriority"), cells("o_orderstatus"), cells("l_returnflag").replace("count(*) - 1 AS k", "count(*) AS k"), f"SELECT var_pop({y}) * count(*) AS sse, 0 AS k FROM d",
             line("l_quantity"), line("ln(l_quantity)"), two, lines("l_returnflag", "l_quantity"), lines("o_orderpriority", "ln(l_quantity)")]
    rows = []
    for formula, part in zip(LADDER, parts):
        free = formula.endswith("- 1")  # no intercept: about zero, and k parameters
        one, total = (0, "yy") if free else (1, f"{n} * vy")
        r2 = "0.0" if formula.endswith("~ 1") else f"(1 - sse / ({total}))"
        llf = f"(-{n} / 2 * ({math.log(2 * math.pi)!r} + ln(sse / {n}) + 1))"
        rows.append(f"SELECT '{formula}' AS formula, CAST(k AS INTEGER) AS k, n, {sql_sig(r2)} AS r2, {'0.0' if r2 == '0.0' else sql_sig(f'1 - (1 - {r2}) * ({n} - {one}) / ({n} - k - {one})')} AS adj_r2, "
                    f"{sql_sig(llf)} AS llf, {sql_sig(f'-2 * {llf} + 2 * (k + {one})')} AS aic FROM ({part}), t")
    return (f"WITH d AS (SELECT l.*, o_orderstatus, o_orderpriority FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),\nt AS (SELECT count(*) AS n, var_pop({y}) AS vy, sum({y} * {y}) AS yy FROM d)\n"
            + "\nUNION ALL\n".join(rows))


def _lines_of_orders(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    return lines.join(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))


@query("formula_ladder", ids="J13 J11 J1", sql=_ladder_sql())
def formula_ladder_q(spark, sf):
    """Thirteen formulas over lines and their orders' status, compared in one pass. Some cells of the
    first never occur; its aliased columns are found when it is solved."""
    return _sig_cols(M.formula_ladder(_lines_of_orders(spark, sf), LADDER), ["r2", "adj_r2", "llf", "aic"])


#: The continued fraction of the incomplete beta function, so many steps of it.
BETA_STEPS = 400


def _beta_sql(source: str) -> str:
    """name, tail for rows (name, a, b, x, y) of ``source``, where y = 1 - x: the regularised incomplete
    beta function by Lentz's form of its continued fraction."""
    return f"""
s AS (SELECT *, x < (a + 1) / (a + b + 2) AS own FROM {source}),
q AS (SELECT name, own, CASE WHEN own THEN a ELSE b END AS a, CASE WHEN own THEN b ELSE a END AS b, CASE WHEN own THEN x ELSE y END AS x, CASE WHEN own THEN y ELSE x END AS y FROM s),
r AS (SELECT name, own, a, b, x, y, 0 AS m, CAST(1 AS DOUBLE) AS c, CAST(1 / (1 - (a + b) * x / (a + 1)) AS DOUBLE) AS d, CAST(1 / (1 - (a + b) * x / (a + 1)) AS DOUBLE) AS h FROM q
      UNION ALL
      SELECT name, own, a, b, x, y, m + 1, 1 + o / c1, 1 / (1 + o * d1), h * c1 * d1 * (1 + o / c1) / (1 + o * d1) FROM (
        SELECT *, 1 + e / c AS c1, 1 / (1 + e * d) AS d1 FROM (
          SELECT *, (m + 1) * (b - m - 1) * x / ((a + 2 * m + 1) * (a + 2 * m + 2)) AS e, -(a + m + 1) * (a + b + m + 1) * x / ((a + 2 * m + 2) * (a + 2 * m + 3)) AS o FROM r WHERE m < {BETA_STEPS}))),
tail AS (SELECT name, CASE WHEN own THEN f ELSE 1 - f END AS tail FROM (
  SELECT name, own, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(y)) * h / a AS f FROM r WHERE m = {BETA_STEPS}))"""


P_SQL = """WITH RECURSIVE m AS (SELECT avg(l_quantity) AS my, avg(l_discount) AS m1, avg(l_tax) AS m2, var_pop(l_discount) AS v11, var_pop(l_tax) AS v22,
  covar_pop(l_discount, l_tax) AS v12, covar_pop(l_discount, l_quantity) AS c1, covar_pop(l_tax, l_quantity) AS c2, var_pop(l_quantity) AS vy, CAST(count(*) AS DOUBLE) AS n FROM lineitem),
g AS (SELECT *, v11 * v22 - v12 * v12 AS det, (v22 * c1 - v12 * c2) / (v11 * v22 - v12 * v12) AS b1, (v11 * c2 - v12 * c1) / (v11 * v22 - v12 * v12) AS b2 FROM m),
e AS (SELECT *, vy - b1 * c1 - b2 * c2 AS ve, n - 3 AS df FROM g),
w AS (SELECT *, sqrt(ve * n / df * v22 / (n * det)) AS se1, sqrt(ve * n / df * v11 / (n * det)) AS se2, ((vy - ve) * n / 2) / (ve * n / df) AS f, -n / 2 * ({LOG2PI} + ln(ve) + 1) AS llf FROM e),
u AS (SELECT 'l_discount' AS name, b1 AS coef, se1 AS std_err, b1 / se1 AS t, * FROM w UNION ALL SELECT 'l_tax', b2, se2, b2 / se2, * FROM w),
z AS (SELECT name, df / 2 AS a, 0.5 AS b, df / (df + t * t) AS x, t * t / (df + t * t) AS y FROM u UNION ALL SELECT 'f', df / 2, 1.0, df / (df + 2 * f), 2 * f / (df + 2 * f) FROM w),
""".replace("{LOG2PI}", repr(math.log(2 * math.pi))) + _beta_sql("z")


@query("ols_p_values", ids="J11", sql=P_SQL + """
SELECT u.name AS term, """ + sql_sig("coef") + " AS coef, " + sql_sig("std_err") + " AS std_err, " + sql_sig("t") + " AS t, " + sql_sig("tail", 5) + """ AS p_value
FROM u JOIN tail USING (name)""")
def ols_p_values_q(spark, sf):
    """The full coefficient table, p values by Student's t; the intercept's row is in ``ols_summary``."""
    out = M.formula_summary(load(spark, sf, "lineitem"), "l_quantity ~ l_discount + l_tax").where("term <> '(intercept)'")
    return _sig_cols(_sig_cols(out.select("term", "coef", "std_err", "t", "p_value"), ["coef", "std_err", "t"]), ["p_value"], 5)


@query("ols_model", ids="J11", sql=P_SQL + """
SELECT CAST(n AS BIGINT) AS n, 2 AS k, """ + sql_sig("1 - ve / vy", 5) + " AS r2, " + sql_sig("1 - ve / vy * (n - 1) / df", 4) + " AS adj_r2, " + sql_sig("f", 5) + " AS f, " + sql_sig("tail", 5)
       + " AS f_p_value, " + sql_sig("llf") + " AS llf, " + sql_sig("-2 * llf + 6") + " AS aic, " + sql_sig("-2 * llf + 3 * ln(n)") + """ AS bic FROM w, tail WHERE name = 'f'""")
def ols_model_q(spark, sf):
    """The summary's model statistics: R², F and its p value, log-likelihood, AIC, BIC."""
    out = M.formula_summary(load(spark, sf, "lineitem"), "l_quantity ~ l_discount + l_tax").limit(1)
    out = out.select("n", "k", "r2", "adj_r2", "f", "f_p_value", "llf", "aic", "bic")
    return _sig_cols(_sig_cols(_sig_cols(out, ["r2", "f", "f_p_value"], 5), ["adj_r2"], 4), ["llf", "aic", "bic"])


@query("poisson_levels", ids="J12", sql="""
WITH g AS (SELECT o_orderpriority AS v, avg(l_quantity) AS m, sum(l_quantity) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
b AS (SELECT * FROM g ORDER BY v LIMIT 1),
c AS (SELECT '(intercept)' AS term, ln(m) AS coef, sqrt(1 / s) AS std_err FROM b
      UNION ALL SELECT 'o_orderpriority[' || g.v || ']', ln(g.m / b.m), sqrt(1 / g.s + 1 / b.s) FROM g, b WHERE g.v <> b.v)
SELECT term, """ + sql_sig("coef", 5) + " AS coef, " + sql_sig("std_err", 5) + " AS std_err, " + sql_sig("coef / std_err", 4) + " AS z FROM c")
def poisson_levels_q(spark, sf):
    """Poisson regression on a category: the coefficients are logs of ratios of the levels' means, and
    their errors follow from the levels' sums."""
    out = M.poisson_summary(_lines_of_orders(spark, sf), "l_quantity ~ C(o_orderpriority)").select("term", "coef", "std_err", "z")
    return _sig_cols(_sig_cols(out, ["coef", "std_err"], 5), ["z"], 4)


@query("poisson_score", ids="J12", sql="""
SELECT unnest(['(intercept)', 'l_discount', 'l_tax', 'l_returnflag[N]', 'l_returnflag[R]']) AS term, 0.0::DOUBLE AS score""")
def poisson_score_q(spark, sf):
    """At the maximum the residuals are orthogonal to every column: Σ x(y − μ) over Σ |x| y, which
    rounds to 0, for a fit with four predictors."""
    formula = "l_quantity ~ l_discount + l_tax + C(l_returnflag)"
    d = load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    return M.poisson_scores(d, formula).withColumn("score", F.abs(dround("score", 8)))


@query("poisson_fit", ids="J12", sql="""
WITH d AS (SELECT l_quantity AS y, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS x FROM lineitem),
s AS (SELECT avg(CASE WHEN x = 0 THEN y END) AS m0, avg(CASE WHEN x = 1 THEN y END) AS m1 FROM d)
SELECT '(intercept)' AS term, round(ln(m0) * 100000.0) / 100000.0 AS coef FROM s
UNION ALL SELECT 'returned', round(ln(m1 / m0) * 100000.0) / 100000.0 FROM s""")
def poisson_fit_q(spark, sf):
    """Poisson GLM (log link) of quantity on a 0/1 predictor: its
    coefficients are the logs of the group means."""
    d = load(spark, sf, "lineitem").select("l_quantity", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("returned"))
    model, _ = M.fit_poisson(d, "l_quantity", ["returned"])
    rows = [("(intercept)", float(model.intercept)), ("returned", float(model.coefficients[0]))]
    return spark.createDataFrame(rows, "term string, coef double").withColumn("coef", dround("coef", 5))


FEATS = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
# Ridge penalties of the cross-validation curve.
ALPHAS = [0.05, 0.075, 0.1, 0.3, 1, 3, 5, 10, 15, 30, 50, 75]


#: A number that Spark and SQL compute alike, in place of a hash of the row key.
NUMBER_SQL = "l_orderkey * 7 + l_linenumber"


def _two_fit_sql(where: str, alpha: float) -> str:
    """b0, b1, b2 of a ridge fit on quantity and discount over some rows of d."""
    return f"""SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM (
  SELECT *, (g * c1 - v12 * c2) / (f * g - v12 * v12) AS b1, (f * c2 - v12 * c1) / (f * g - v12 * v12) AS b2 FROM (
    SELECT *, v11 + {alpha!r} / n AS f, v22 + {alpha!r} / n AS g FROM (
      SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2, var_pop(l_quantity) AS v11, var_pop(l_discount) AS v22, covar_pop(l_quantity, l_discount) AS v12,
             covar_pop(l_quantity, l_extendedprice) AS c1, covar_pop(l_discount, l_extendedprice) AS c2, CAST(count(*) AS DOUBLE) AS n FROM d WHERE {where})))"""


def _fold_sql() -> str:
    """Ridge on two centred predictors in closed form, over folds."""
    parts = [f"SELECT CAST({a!r} AS DOUBLE) AS alpha, sqrt(avg(pow(l_extendedprice - (b0 + b1 * l_quantity + b2 * l_discount), 2))) AS rm\nFROM d, ({_two_fit_sql(f'fold <> {k}', a)}) WHERE fold = {k}"
             for a in ALPHAS for k in range(5)]
    return (f"WITH d AS (SELECT l_extendedprice, l_quantity, l_discount, ({NUMBER_SQL}) % 5 AS fold FROM lineitem), r AS (\n"
            + "\nUNION ALL\n".join(parts) + ")\nSELECT alpha, " + sql_sig("avg(rm)") + " AS rmse, CAST(count(*) AS INTEGER) AS folds FROM r GROUP BY alpha")


@query("ridge_cv", ids="J8 J3", bench=True, sql=_fold_sql())
def ridge_cv_q(spark, sf):
    out = M.ridge_cv(load(spark, sf, "lineitem"), "l_extendedprice", TWO, ALPHAS, KEYS, folds=5, number=F.expr(NUMBER_SQL))
    return _sig_cols(out, ["rmse"])


@query("ridge_cv_five", ids="J8 J3")
def ridge_cv_five_q(spark, sf):
    """The curve on five features of lines and their parts, folds by the hash of the row key."""
    return M.ridge_cv(_lineitem_part(spark, sf), "l_extendedprice", FEATS, ALPHAS, KEYS, folds=5)


PART_FEATS = ["p_size", "brand_no", "type_no", "name_len"]


def _part_features(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"),
                    F.regexp_extract("p_brand", r"(\d+)", 1).cast("double").alias("brand_no"),
                    F.hash("p_type").cast("double").alias("type_hash"),
                    F.length("p_name").cast("double").alias("name_len")).withColumn(
        "type_no", F.pmod(F.col("type_hash").cast("long"), F.lit(17)).cast("double")).drop("type_hash")


def _grid(spark, sf, depths=M.DEPTHS):
    return M.gbt_grid(_part_features(spark, sf), "p_retailprice", PART_FEATS, ["p_partkey"], depths=depths, folds=3)


@query("gbt_grid", ids="J9")
def gbt_grid_q(spark, sf):
    """Boosted-tree grid on the ``part`` table (price from size, brand, type, name length): all 48
    settings over three folds, grown side by side."""
    return _grid(spark, sf)


@query("gbt_grid_2", ids="J9")
def gbt_grid_2_q(spark, sf):
    """The grid's settings of depth 2."""
    return _grid(spark, sf, (2,))


@query("gbt_grid_4", ids="J9")
def gbt_grid_4_q(spark, sf):
    """The grid's settings of depth 4."""
    return _grid(spark, sf, (4,))


@query("gbt_grid_6", ids="J9")
def gbt_grid_6_q(spark, sf):
    """The grid's settings of depth 6."""
    return _grid(spark, sf, (6,))


@query("gbt_refit", ids="J9 J6")
def gbt_refit_q(spark, sf):
    """Refit with the best of the grid's 48 settings: RMSE on train and test rows."""
    return M.refit_best(_part_features(spark, sf), "p_retailprice", PART_FEATS, _grid(spark, sf), ["p_partkey"])


@query("gbt_stump", ids="J9 J10", sql="""
WITH p AS (SELECT p_retailprice AS y, CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS DOUBLE) AS x FROM part)
SELECT x, """ + sql_sig("avg(y)") + """ AS prediction, count(*) AS n FROM p GROUP BY x""")
def gbt_stump_q(spark, sf):
    """A model of one tree of depth one and rate one predicts the mean of
    either side of its only split."""
    d = load(spark, sf, "part").select("p_retailprice", F.when(F.col("p_size") > 25, 1.0).otherwise(0.0).alias("x"))
    pred = M.predict_trees(M.fit_gbt(d, "p_retailprice", ["x"], 1, 1.0, 1), d)
    return _sig_cols(pred.groupBy("x").agg(F.avg("prediction").alias("prediction"), F.count(F.lit(1)).alias("n")), ["prediction"])


TREE_FEATS = ["p_size", "brand_no", "name_len"]


def _tree_sql() -> str:
    """Every cut of every feature at the root, then at its two sides; the first best of each."""
    long = "SELECT id, g, node, unnest([1, 2, 3]) AS f, unnest([x1, x2, x3]) AS x"
    best = """SELECT node, b.f, b.x + (v.nx - b.x) / 2 AS cut, ls / ln AS lv, (s - ls) / (n - ln) AS rv FROM (
  SELECT *, sum(hn) OVER w AS ln, sum(hs) OVER w AS ls, sum(hn) OVER (PARTITION BY node, f) AS n, sum(hs) OVER (PARTITION BY node, f) AS s, lead(x) OVER (PARTITION BY node, f ORDER BY x) AS nx
  FROM (SELECT node, f, x, CAST(count(*) AS DOUBLE) AS hn, sum(g) AS hs FROM {long} GROUP BY node, f, x) WINDOW w AS (PARTITION BY node, f ORDER BY x)) b JOIN v ON v.f = b.f AND v.x = b.x
WHERE b.nx IS NOT NULL QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n, 7) DESC, b.f, b.x) = 1"""
    name = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(TREE_FEATS, 1)) + " END"
    return f"""
WITH d AS (SELECT p_partkey AS id, p_retailprice - avg(p_retailprice) OVER () AS g, CAST(p_size AS DOUBLE) AS x1, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS DOUBLE) AS x2,
             CAST(length(p_name) AS DOUBLE) AS x3, 0 AS node FROM part),
l0 AS ({long} FROM d), v AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS nx FROM (SELECT DISTINCT f, x FROM l0)), b0 AS ({best.format(long='l0')}),
d1 AS (SELECT d.* REPLACE (CASE WHEN (CASE f WHEN 1 THEN x1 WHEN 2 THEN x2 ELSE x3 END) <= cut THEN 1 ELSE 2 END AS node) FROM d, b0),
l1 AS ({long} FROM d1), b1 AS ({best.format(long='l1')})
SELECT node, {name} AS feature, {sql_sig('cut')} AS cut, CAST(NULL AS DOUBLE) AS value FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b1)
UNION ALL SELECT 2 * node + 1, NULL, NULL, {sql_sig('lv')} FROM b1
UNION ALL SELECT 2 * node + 2, NULL, NULL, {sql_sig('rv')} FROM b1"""


@query("gbt_first_tree", ids="J9", sql=_tree_sql())
def gbt_first_tree_q(spark, sf):
    """The first tree of depth two: its cuts are the best of all cuts, its leaves the mean residuals."""
    model = M.fit_gbt(_part_features(spark, sf), "p_retailprice", TREE_FEATS, 2, 1.0, 1)
    tree = M.tree_table(spark, model).withColumn("value", F.when(F.col("feature").isNull(), F.col("value")))
    return _sig_cols(tree, ["cut", "value"])


@query("gbt_importance", ids="J10")
def gbt_importance_q(spark, sf):
    m = M.fit_gbt(_part_features(spark, sf), "p_retailprice", PART_FEATS, depth=4, rate=0.1, n_trees=50)
    return M.importances(spark, m, PART_FEATS)


HOLDOUT_SQL = """
WITH d AS (SELECT *, CASE WHEN (""" + NUMBER_SQL + """) % 1000 < 300 THEN 'test' ELSE 'train' END AS split FROM lineitem),
f AS (""" + _two_fit_sql("split = 'train'", 0.0) + """),
p AS (SELECT d.*, b0 + b1 * l_quantity + b2 * l_discount AS prediction FROM d, f)
"""


def _holdout(spark, sf):
    d = M.split_train_test(load(spark, sf, "lineitem"), KEYS, number=F.expr(NUMBER_SQL))
    return M.predict_linear(d, TWO, M.fit_gram(d.where(F.col("split") == "train"), "l_extendedprice", TWO))


@query("score_holdout_five", ids="J3 J6 J14 F19")
def score_holdout_five_q(spark, sf):
    """Five features by formula, split by the hash of the row key: RMSE on train and test rows."""
    d = M.split_train_test(_lineitem_part(spark, sf), KEYS)
    fit = M.fit_formulas(d.where(F.col("split") == "train"), ["l_extendedprice ~ " + " + ".join(FEATS)])[0]
    err = F.col("prediction") - F.col("l_extendedprice")
    return M.predict_formula(d, fit).groupBy("split").agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


@query("score_holdout", ids="J3 J6 J14 F19", sql=HOLDOUT_SQL + "SELECT split, " + sql_sig("sqrt(avg(pow(prediction - l_extendedprice, 2)))")
       + " AS rmse, count(*) AS n FROM p GROUP BY split")
def score_holdout_q(spark, sf):
    pred = _holdout(spark, sf)
    out = None
    for split in ("train", "test"):
        one = P.rmse(pred.where(F.col("split") == split), "l_extendedprice", "prediction").select(F.lit(split).alias("split"), "rmse", "n")
        out = one if out is None else out.unionByName(one)
    return _sig_cols(out, ["rmse"])


@query("residual_bins", ids="F21 J6", sql=HOLDOUT_SQL + """, s AS (SELECT min(prediction) AS lo, max(prediction) AS hi FROM p),
r AS (SELECT split, prediction, prediction - l_extendedprice AS r FROM p)
SELECT split, CAST(least(floor((prediction - lo) / ((hi - lo) / 8)), 7) AS INTEGER) AS bin, count(*) AS n,
       """ + sql_sig("avg(r)", 5) + " AS mean_residual, " + sql_sig("stddev_samp(r)", 5) + " AS sd_residual FROM r, s GROUP BY 1, 2")
def residual_bins_q(spark, sf):
    """Residuals by bins of the prediction, for train and test rows."""
    out = P.residual_bins(_holdout(spark, sf), "l_extendedprice", "prediction", 8, "split")
    return _sig_cols(out, ["mean_residual", "sd_residual"], 5)


@query("score_test_csv", ids="J14 J6 B3 A2", sql=HOLDOUT_SQL + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
       + sql_sig("prediction") + " AS prediction FROM p WHERE split = 'test'")
def score_test_csv_q(spark, sf):
    """Score the held-out rows and hand them over as a CSV result file
    (row key + prediction), read back with a declared schema."""
    from domus.session import scratch_path
    from domus.sinks.writers import write_csv
    from domus.sources.readers import read_delimited
    pred = _holdout(spark, sf).where(F.col("split") == "test").select(*KEYS, "prediction")
    p = scratch_path(spark, "scores")
    write_csv(pred, p)
    back = read_delimited(spark, p, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                                    "prediction double", sep=",")
    return _sig_cols(back, ["prediction"])
