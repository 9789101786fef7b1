"""Aggregation, profile, ranking and top-k queries (F, G)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from domus.functions.scalar import dround, money_avg, sig_round
from domus.operators import profile as P
from domus.plans.q_columns import LI_NULLS_SQL, lineitem_with_nulls
from domus.plans.registry import load, query, sql_money_avg, sql_round, sql_sig

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
JOIN_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice"]
JOIN_SQL = "lp AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _lineitem_part(spark, sf):
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey, "inner")


def _sig_cols(df, cols, digits=6):
    return df.select(*[sig_round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("count_rows", ids="F1", sql="SELECT count(*) AS n_rows FROM orders")
def count_rows_q(spark, sf):
    return P.count_rows(load(spark, sf, "orders"))


@query("group_two_keys", ids="F2", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, """ + sql_round(sql_money_avg("l_extendedprice"), 4) + """ AS avg_price,
       """ + sql_round("avg(l_quantity)", 4) + """ AS avg_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_two_keys_q(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), dround(money_avg("l_extendedprice"), 4).alias("avg_price"),
        dround(F.avg("l_quantity"), 4).alias("avg_quantity"))


@query("group_city", ids="F3 L1", sql="""
SELECT n_name AS city, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def group_city_q(spark, sf):
    return spark.sql("SELECT n_name AS city, count(*) AS n FROM {c} JOIN {n} ON c_nationkey = n_nationkey "
                     "GROUP BY n_name", c=load(spark, sf, "customer"), n=load(spark, sf, "nation"))


@query("top15_values", ids="F4 G2", sql="""
SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 15""")
def top15_values_q(spark, sf):
    return P.top_values(load(spark, sf, "orders"), "o_custkey", 15)


def _describe_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS count, {sql_sig(f'avg({c})')} AS mean,
  {sql_sig(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min,
  {sql_sig(f'quantile_cont({c}, 0.25)')} AS p25, {sql_sig(f'quantile_cont({c}, 0.5)')} AS p50,
  {sql_sig(f'quantile_cont({c}, 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@query("describe_numeric", ids="F5", bench=True, sql=_describe_sql("lineitem", LI_NUM))
def describe_numeric_q(spark, sf):
    d = P.describe_numeric(load(spark, sf, "lineitem"), LI_NUM)
    return _sig_cols(d, ["mean", "std", "p25", "p50", "p75"])


@query("describe_text", ids="F6", sql="\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, CAST(sum(cnt) AS BIGINT) AS count, count(*) AS "unique",
       first(v ORDER BY cnt DESC, v) AS top, max(cnt) AS freq
FROM (SELECT {c} AS v, count(*) AS cnt FROM part WHERE {c} IS NOT NULL GROUP BY {c})""" for c in
                                                                ["p_name", "p_brand", "p_type"]))
def describe_text_q(spark, sf):
    return P.describe_text(load(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@query("skew_kurt", ids="F7", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {sql_sig(f'skewness({c})')} AS skew, {sql_sig(f'kurtosis({c})')} AS kurt "
    f"FROM lineitem" for c in LI_NUM))
def skew_kurt_q(spark, sf):
    return _sig_cols(P.skew_kurt(load(spark, sf, "lineitem"), LI_NUM), ["skew", "kurt"])


LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
          "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("missing_report", ids="F8", bench=True, sql="WITH " + LI_NULLS_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS total, "
    f"{sql_round(f'(count(*) - count({c})) / count(*)', 6)} AS percent FROM li" for c in LI_ALL))
def missing_report_q(spark, sf):
    r = P.missing_report(lineitem_with_nulls(spark, sf))
    return r.withColumn("percent", dround("percent", 6))


@query("drop_sparse", ids="F9", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_tax, l_linestatus, l_shipdate FROM li""")
def drop_sparse_q(spark, sf):
    return P.drop_sparse(lineitem_with_nulls(spark, sf), 1)


_LI_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
             "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
             "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("table_profile", ids="F18", sql="WITH " + LI_NULLS_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{_LI_TYPES[c]}' AS type, count({c}) AS non_null, count(*) AS rows, "
    f"CAST(11 AS BIGINT) AS columns FROM li" for c in LI_ALL))
def table_profile_q(spark, sf):
    return P.table_profile(lineitem_with_nulls(spark, sf))


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(JOIN_NUM):
        for b in JOIN_NUM[i + 1:]:
            parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, {sql_sig(f'corr({a}, {b})')} AS r FROM lp")
            parts.append(f"SELECT '{b}' AS var1, '{a}' AS var2, {sql_sig(f'corr({a}, {b})')} AS r FROM lp")
        parts.append(f"SELECT '{a}' AS var1, '{a}' AS var2, 1.0 AS r")
    return "WITH " + JOIN_SQL + "\n" + "\nUNION ALL\n".join(parts)


@query("corr_long", ids="F10", bench=True, sql=_corr_sql())
def corr_long_q(spark, sf):
    return _sig_cols(P.corr_long(_lineitem_part(spark, sf), JOIN_NUM), ["r"])


@query("corr_topk", ids="F11", sql="WITH " + JOIN_SQL + ", c AS (\n" + "\nUNION ALL\n".join(
    [f"SELECT 'l_extendedprice' AS column_name, 1.0 AS r"] +
    [f"SELECT '{c}' AS column_name, corr({c}, l_extendedprice) AS r FROM lp" for c in JOIN_NUM if c != "l_extendedprice"])
    + ")\nSELECT column_name, " + sql_sig("r") + " AS r FROM c ORDER BY r DESC, column_name LIMIT 4")
def corr_topk_q(spark, sf):
    return _sig_cols(P.corr_topk(_lineitem_part(spark, sf), "l_extendedprice", JOIN_NUM, 4), ["r"])


@query("box_by_category", ids="F12", sql="""
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderpriority),
q2 AS (SELECT *, q3 - q1 AS iqr FROM q)
SELECT q2.o_orderpriority, """ + sql_sig("q1") + " AS q1, " + sql_sig("median") + " AS median, " + sql_sig("q3")
    + " AS q3, " + sql_sig("iqr") + """ AS iqr, count(*) AS n,
       min(CASE WHEN o_totalprice >= q1 - 1.5 * iqr THEN o_totalprice END) AS whisker_lo,
       max(CASE WHEN o_totalprice <= q3 + 1.5 * iqr THEN o_totalprice END) AS whisker_hi,
       count(CASE WHEN o_totalprice < q1 - 1.5 * iqr OR o_totalprice > q3 + 1.5 * iqr THEN 1 END) AS n_outliers
FROM orders JOIN q2 ON orders.o_orderpriority = q2.o_orderpriority
GROUP BY q2.o_orderpriority, q1, median, q3, iqr""")
def box_by_category_q(spark, sf):
    b = P.box_by_category(load(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return _sig_cols(b, ["q1", "median", "q3", "iqr"])


@query("histogram", ids="F13", sql="""
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS m,
                  stddev_samp(o_totalprice) AS sd FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin FROM orders, s)
SELECT bin, lo + bin * ((hi - lo) / 20) AS lo, lo + (bin + 1) * ((hi - lo) / 20) AS hi,
       count(*) AS count, """ + sql_sig("m") + " AS mean, " + sql_sig("sd") + """ AS std
FROM b, s GROUP BY bin, s.lo, s.hi, s.m, s.sd""")
def histogram_q(spark, sf):
    h = P.histogram(load(spark, sf, "orders"), "o_totalprice", 20)
    return _sig_cols(h, ["mean", "std"])


@query("density_by_category", ids="F14", sql="""
WITH s AS (SELECT o_orderstatus, count(*) AS n, stddev_samp(o_totalprice) AS sd, min(o_totalprice) AS mn,
                  max(o_totalprice) AS mx FROM orders GROUP BY o_orderstatus),
s2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM s),
s3 AS (SELECT *, mn - 3 * h AS g0, (mx - mn + 6 * h) / 49 AS gstep FROM s2),
g AS (SELECT s3.*, CAST(i AS INTEGER) AS point, g0 + i * gstep AS x FROM s3, range(50) t(i))
SELECT g.o_orderstatus, g.point, """ + sql_sig("g.x") + """ AS x,
       """ + sql_sig(f"sum(exp(-0.5 * ((g.x - o.o_totalprice) / g.h) * ((g.x - o.o_totalprice) / g.h))) / (g.n * g.h * {math.sqrt(2 * math.pi)!r})") + """ AS density
FROM g JOIN orders o ON o.o_orderstatus = g.o_orderstatus
GROUP BY g.o_orderstatus, g.point, g.x, g.n, g.h""")
def density_by_category_q(spark, sf):
    d = P.density_by_category(load(spark, sf, "orders"), "o_orderstatus", "o_totalprice", 50)
    return _sig_cols(d, ["x", "density"])


@query("grid_heatmap", ids="F15", sql="""
SELECT CAST(floor(CAST(embedding[1] AS DOUBLE) / 0.05) AS BIGINT) AS cell_x,
       CAST(floor(CAST(embedding[2] AS DOUBLE) / 0.05) AS BIGINT) AS cell_y,
       count(*) AS count, """ + sql_round("avg(label)", 6) + """ AS mean_value
FROM embeddings GROUP BY 1, 2""")
def grid_heatmap_q(spark, sf):
    e = load(spark, sf, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"),
                                             F.col("embedding")[1].cast("double").alias("y"), "label")
    return P.grid_heatmap(e, "x", "y", 0.05, "label").withColumn("mean_value", dround("mean_value", 6))


@query("scatter_bins", ids="F22", sql="""
WITH s AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl,
                  max(l_extendedprice) AS yh FROM lineitem)
SELECT CAST(least(floor((l_quantity - xl) / ((xh - xl) / 10)), 9) AS INTEGER) AS bin_x,
       CAST(least(floor((l_extendedprice - yl) / ((yh - yl) / 10)), 9) AS INTEGER) AS bin_y, count(*) AS count
FROM lineitem, s GROUP BY 1, 2""")
def scatter_bins_q(spark, sf):
    return P.scatter_bins(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 10)


def _ols_one_sql(y: str, x: str, name: str | None = None, src: str = "lp") -> str:
    n = f"CAST(regr_count({y}, {x}) AS DOUBLE)"
    r2 = f"regr_r2({y}, {x})"
    ssr = f"(regr_syy({y}, {x}) * (1 - {r2}))"
    llf = f"(-{n} / 2 * ({math.log(2 * math.pi)!r} + ln({ssr} / {n}) + 1))"
    head = f"'{name}' AS column_name, " if name else ""
    return (f"SELECT {head}CAST(regr_count({y}, {x}) AS BIGINT) AS n, {sql_sig(f'regr_slope({y}, {x})')} AS slope, "
            f"{sql_sig(f'regr_intercept({y}, {x})')} AS intercept, {sql_sig(r2)} AS r2, "
            f"{sql_sig(f'1 - (1 - {r2}) * ({n} - 1) / ({n} - 2)')} AS adj_r2, "
            f"{sql_sig(f'{r2} / (1 - {r2}) * ({n} - 2)')} AS f_stat, {sql_sig(llf)} AS llf, "
            f"{sql_sig(f'-2 * {llf} + 4')} AS aic FROM {src}")


OLS_COLS = ["slope", "intercept", "r2", "adj_r2", "f_stat", "llf", "aic"]


@query("ols_one", ids="F16", sql="WITH " + JOIN_SQL + "\n" + _ols_one_sql("l_extendedprice", "p_retailprice"))
def ols_one_q(spark, sf):
    return _sig_cols(P.ols_one(_lineitem_part(spark, sf), "l_extendedprice", "p_retailprice"), OLS_COLS)


SCREEN = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]


@query("ols_screen", ids="F17", bench=True, sql="WITH " + JOIN_SQL + "\n" + "\nUNION ALL\n".join(
    _ols_one_sql("l_extendedprice", c, c) for c in SCREEN))
def ols_screen_q(spark, sf):
    return _sig_cols(P.ols_screen(_lineitem_part(spark, sf), "l_extendedprice", SCREEN), OLS_COLS)


@query("zscore_tails", ids="G3", sql="""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders),
z AS (SELECT o_orderkey, o_totalprice, (o_totalprice - m) / sd AS z FROM orders, s)
SELECT o_orderkey, o_totalprice, """ + sql_sig("z") + """ AS z, tail FROM (
  (SELECT *, 'low' AS tail FROM z ORDER BY z ASC, o_orderkey LIMIT 10)
  UNION ALL
  (SELECT *, 'high' AS tail FROM z ORDER BY z DESC, o_orderkey LIMIT 10))""")
def zscore_tails_q(spark, sf):
    return _sig_cols(P.zscore_tails(load(spark, sf, "orders"), "o_totalprice", "o_orderkey", 10), ["z"])


def _inv_norm_sql(q: str) -> str:
    """SQL twin of :func:`domus.functions.scalar.inv_norm_cdf`."""
    a = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
    b = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00)

    def poly(coefs, x):
        acc = repr(coefs[0])
        for k in coefs[1:]:
            acc = f"(({acc}) * ({x}) + {k!r})"
        return acc
    ql = f"sqrt(-2 * ln({q}))"
    qh = f"sqrt(-2 * ln(1 - {q}))"
    r = f"(({q}) - 0.5) * (({q}) - 0.5)"
    low = f"({poly(c, ql)}) / (({poly(d, ql)}) * {ql} + 1)"
    high = f"-({poly(c, qh)}) / (({poly(d, qh)}) * {qh} + 1)"
    mid = f"({poly(a, r)}) * (({q}) - 0.5) / (({poly(b, r)}) * {r} + 1)"
    return f"(CASE WHEN {q} < 0.02425 THEN {low} WHEN {q} > {1 - 0.02425!r} THEN {high} ELSE {mid} END)"


QQ_SQL_BASE = """
WITH r AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) AS i,
                  count(*) OVER () AS n FROM orders WHERE o_totalprice IS NOT NULL),
m AS (SELECT i, v, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n)
                        ELSE (i - 0.3175) / (n + 0.365) END AS m FROM r),
p AS (SELECT i AS rank, """ + _inv_norm_sql("m") + " AS osm, v AS osr FROM m)"


@query("qq_points", ids="G4", bench=True, sql=QQ_SQL_BASE + "\nSELECT rank, " + sql_sig("osm") + " AS osm, osr FROM p")
def qq_points_q(spark, sf):
    return _sig_cols(P.qq_points(load(spark, sf, "orders"), "o_totalprice"), ["osm"])


@query("qq_fit", ids="G4", sql=QQ_SQL_BASE + "\nSELECT " + sql_sig("regr_slope(osr, osm)") + " AS slope, "
       + sql_sig("regr_intercept(osr, osm)") + " AS intercept, " + sql_sig("corr(osr, osm)")
       + " AS r, count(*) AS n FROM p")
def qq_fit_q(spark, sf):
    return _sig_cols(P.qq_fit(load(spark, sf, "orders"), "o_totalprice"), ["slope", "intercept", "r"])


@query("top_n", ids="G2 G1", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_n_q(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("sorted_limit", ids="G1 G2", sql="""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20""")
def sorted_limit_q(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey").limit(20)


@query("last_wins", ids="F20 G1", sql="""
SELECT o_custkey, o_totalprice AS last_price FROM (
  SELECT o_custkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def last_wins_q(spark, sf):
    """The latest price per customer (by order date, then key): a partial
    ``max_by`` aggregate, not a per-group sort."""
    o = load(spark, sf, "orders")
    return P.last_wins(o, "o_custkey", "o_totalprice", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", F.col("o_totalprice").alias("last_price"))


SKETCHED = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]


@query("sketch_profile", ids="F5 F18", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS \"rows\", CAST(min({c}) AS DOUBLE) + 0.0 AS lo, CAST(max({c}) AS DOUBLE) + 0.0 AS hi, true AS ranks_agree, true AS distinct_agrees FROM lineitem" for c in SKETCHED))
def sketch_profile_q(spark, sf):
    """The lines in seven parts, each with its sketch rows; the merged profile against the exact one:
    counts and extremes are equal, the ranks of the quartiles and the distinct counts within the
    sketches' bounds (three times the stated error)."""
    from domus.operators import sketches as S
    li = load(spark, sf, "lineitem")
    parts = None
    for i in range(7):
        one = S.sketch_columns(li.where(F.pmod("l_orderkey", F.lit(7)) == i), SKETCHED)
        parts = one if parts is None else parts.unionByName(one)
    got = F.broadcast(S.read_sketches(S.merge_sketches(parts)))
    long = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in SKETCHED])).alias("p")).select("p.*")
    at = long.join(got, long["c"] == got["column_name"])
    below = [F.avg((F.col("v") < F.col(p)).cast("double")) for p in ("p25", "p50", "p75")]
    upto = [F.avg((F.col("v") <= F.col(p)).cast("double")) for p in ("p25", "p50", "p75")]
    off = 3 * 1.8 / S.K
    ranks = [(b - off <= p) & (u + off >= p) for b, u, p in zip(below, upto, (0.25, 0.5, 0.75))]
    exact = at.groupBy("column_name", "rows", "lo", "hi", "n_distinct").agg((ranks[0] & ranks[1] & ranks[2]).alias("ranks_agree"), F.count_distinct("v").alias("d"))
    near = F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.col("d") * (3 * 1.04 / 2 ** (S.LG / 2)), F.lit(1))
    return exact.select("column_name", "rows", (F.col("lo") + 0.0).alias("lo"), (F.col("hi") + 0.0).alias("hi"), "ranks_agree", near.alias("distinct_agrees"))
