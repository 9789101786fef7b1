"""Aggregations and statistical profiles.

Every profile is one or two aggregates over the input with many
expressions, never a loop of jobs per column. Wide inputs are chunked so a
single aggregate keeps a bounded number of expressions (codegen limits).
Results are in *long* form (one row per column or pair), which stays small
however many rows the input has.

NaN counts as missing everywhere. A statistic that is not defined (a constant
column's correlation, an empty table's share) is null, never an error."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.functions.scalar import inv_norm_cdf
from domus.operators import gram as G
from domus.operators.columns import nan_to_null
from domus.operators.ranks import exact_quantiles, order_statistics
from domus.session import ensure_checkpoint_dir

AGG_CHUNK = 96


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _num(c: str) -> Column:
    """A column as double, NaN as null."""
    x = F.col(_q(c)).cast("double")
    return F.when(~F.isnan(x), x)


def numeric_columns(df: DataFrame) -> list[str]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long_rows(df: DataFrame, names: Sequence[str], parts: dict[str, callable]) -> DataFrame:
    """One aggregate over ``df`` producing, for each column in ``names``, a
    struct of statistics; then exploded into one row per column. Chunked so
    one aggregate holds at most AGG_CHUNK columns."""
    out = None
    for i in range(0, len(names), AGG_CHUNK):
        chunk = names[i:i + AGG_CHUNK]
        aggs = [F.struct(F.lit(c).alias("column_name"), *[fn(c).alias(k) for k, fn in parts.items()]).alias(f"s{j}")
                for j, c in enumerate(chunk)]
        one = df.agg(*aggs)
        rows = one.select(F.explode(F.array(*[F.col(f"s{j}") for j in range(len(chunk))])).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def count_rows(df: DataFrame) -> DataFrame:
    """F1."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def top_values(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """Value counts, nulls dropped, top ``k`` (F4); ties by value. The final
    sort+limit is a ``TakeOrderedAndProject`` over the per-value counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(k))


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                     accuracy: int = 10000) -> DataFrame:
    """count, mean, sample std, min, 25/50/75% (interpolated), max per column
    (F5), in long form.

    ``exact=True`` computes quartiles by distributed ranking (exact, bounded
    memory per task); ``exact=False`` uses ``percentile_approx``."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    df = nan_to_null(df)
    base = _long_rows(df, cols, {
        "count": lambda c: F.count(F.col(_q(c))),
        "mean": lambda c: F.avg(F.col(_q(c))),
        "std": lambda c: F.stddev_samp(F.col(_q(c))),
        "min": lambda c: F.min(F.col(_q(c))).cast("double"),
        "max": lambda c: F.max(F.col(_q(c))).cast("double"),
    })
    probs = [0.25, 0.5, 0.75]
    if exact:
        # all columns stacked into (column, value): one ranking pipeline
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(_q(c)).cast("double").alias("value")) for c in cols]))
            .alias("p")).select("p.*")
        qs = (exact_quantiles(stacked, "value", probs, ["column_name"])
              .groupBy("column_name").pivot("prob", probs).agg(F.first("q"))
              .select("column_name", *[F.col(f"`{p}`").alias(n) for p, n in zip(probs, ["p25", "p50", "p75"])]))
    else:
        qs = _long_rows(df, cols, {
            n: (lambda c, p=p: F.percentile_approx(F.col(_q(c)).cast("double"), p, accuracy))
            for p, n in zip(probs, ["p25", "p50", "p75"])})
    return base.join(qs, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top, freq per text column (F6). Ties for the top value
    go to the smallest value. All columns are stacked into (column, value)
    pairs once, so one shuffle serves every column."""
    cols = list(cols) if cols is not None else text_columns(df)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(_q(c)).alias("value")) for c in cols])).alias("p")).select("p.*")
    per_value = pairs.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    return per_value.groupBy("column_name").agg(
        F.sum("cnt").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("top"),
        F.max("cnt").alias("freq"))


def skew_kurt(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Bias-corrected skewness G1 and excess kurtosis G2 (F7), the pandas
    estimators, from Spark's population moments:
    G1 = g1·√(n(n−1))/(n−2), G2 = (n−1)/((n−2)(n−3))·((n+1)·g2 + 6)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    df = nan_to_null(df)
    rows = _long_rows(df, cols, {
        "n": lambda c: F.count(F.col(_q(c))),
        "g1": lambda c: F.skewness(F.col(_q(c))),
        "g2": lambda c: F.kurtosis(F.col(_q(c))),
    }).withColumns({g: F.when(~F.isnan(g), F.col(g)) for g in ("g1", "g2")})
    n = F.col("n").cast("double")
    return rows.select(
        "column_name",
        F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)).alias("kurt"))


def missing_report(df: DataFrame) -> DataFrame:
    """Per column: missing count ``total`` and share ``percent`` (F8); NaN
    counts as missing for floating columns."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    def miss(c):
        x = F.col(_q(c))
        return F.count_if(x.isNull() | F.isnan(x)) if c in fl else F.count_if(x.isNull())
    rows = _long_rows(df, df.columns, {"total": miss, "rows": lambda c: F.count(F.lit(1))})
    return rows.select("column_name", "total", F.try_divide(F.col("total").cast("double"), F.col("rows").cast("double")).alias("percent"))


def drop_sparse(df: DataFrame, max_missing: int = 1) -> DataFrame:
    """Drop columns with more than ``max_missing`` missing values (F9). The
    report is one small row per column; the drop is plan-time."""
    rep = missing_report(df).where(F.col("total") > max_missing).select("column_name").collect()
    return df.drop(*[r[0] for r in rep])


def table_profile(df: DataFrame) -> DataFrame:
    """Column, type, non-null count, rows, columns (F18): one aggregate."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = _long_rows(df, df.columns, {"non_null": lambda c: F.count(F.col(_q(c))),
                                       "rows": lambda c: F.count(F.lit(1))})
    tmap = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return rows.select("column_name", tmap[F.col("column_name")].alias("type"), "non_null", "rows",
                       F.lit(len(df.columns)).cast("long").alias("columns"))


def _known(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The columns as doubles, 0 where missing (null, NaN), and 1/0 marks of
    known values (``k_`` names), computed once a row; and their names there.
    Infinities make a column's statistics NaN."""
    at = {c: f"z{i}" for i, c in enumerate(dict.fromkeys(cols))}
    known = [F.when(_num(c).isNull(), 0.0).otherwise(1.0).alias(f"k_{z}") for c, z in at.items()]
    return df.select(*[F.coalesce(_num(c), F.lit(0.0)).alias(z) for c, z in at.items()], *known), at


def _pair_means(df: DataFrame, pairs: Sequence[tuple[str, str]], at: dict[str, str]) -> list[tuple[float, float]]:
    """A cheap first pass: the means of both columns over each pair's complete
    rows (0 for a pair without rows)."""
    out: list[tuple[float, float]] = []
    for lo in range(0, len(pairs), AGG_CHUNK // 3):
        chunk = [(at[a], at[b]) for a, b in pairs[lo:lo + AGG_CHUNK // 3]]
        row = df.agg(*[F.expr(f"sum({v})") for x, y in chunk for v in (f"k_{x} * k_{y}", f"{x} * k_{y}", f"k_{x} * {y}")]).first()
        out += [(row[3 * i + 1] / row[3 * i], row[3 * i + 2] / row[3 * i]) if row[3 * i] else (0.0, 0.0) for i in range(len(chunk))]
    return out


def _pair_moments(x: str, y: str, mx: float, my: float, i: str) -> list[Column]:
    """Sums of the complete pairs, shifted by the pair's means so that a
    mean which dwarfs the spread costs no digits; marks instead of a branch a
    row. SQL text, as building hundreds of expressions piece by piece takes
    longer than summing."""
    k, a, b = f"k_{x} * k_{y}", f"({x} - double('{mx!r}'))", f"({y} - double('{my!r}'))"
    terms = {"n": k, "sx": f"{k} * {a}", "sy": f"{k} * {b}", "sxx": f"{k} * {a} * {a}", "syy": f"{k} * {b} * {b}", "sxy": f"{k} * {a} * {b}"}
    return [F.expr(f"coalesce(sum({v}), 0D) AS {name}{i}") for name, v in terms.items()]


SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """place (of the pair in the list), n, mean_x, mean_y, cxx, cyy, cxy (centred moments) over the
    rows that know both columns. cxx or cyy of a constant column is 0.

    Two scans whatever the number of columns: the means, then products of the shifted columns and
    of their masks of known values. Where a pair's own means lie so far from its columns' means that
    digits were lost, the pair is summed again with shifts of its own."""
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    columns = [F.col(_q(c)) for c in names]
    shift = G.column_means(df, columns)
    sums = G.matrix_sums(df, columns, G.masked_products(shift)).get(0)
    at = {c: i for i, c in enumerate(names)}
    rows, again = [], []
    for place, (x, y) in enumerate(pairs):
        i, j = at[x], at[y]
        n, sx, sy, sxx, syy, sxy = (0.0,) * 6 if sums is None else (float(v) for v in (
            sums["n"][i, j], sums["x"][i, j], sums["x"][j, i], sums["xx"][i, j], sums["xx"][j, i], sums["xy"][i, j]))
        if n:
            cxx, cyy, cxy = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
            lost = (cxx < LOST * sxx and sxx > 0) or (cyy < LOST * syy and syy > 0)
            if lost:
                again.append((place, x, y))
            rows.append((place, n, shift[i] + sx / n, shift[j] + sy / n, cxx if cxx > 1e-12 * sxx else 0.0, cyy if cyy > 1e-12 * syy else 0.0, cxy))
        else:
            rows.append((place, 0.0, None, None, None, None, None))
    spark = df.sparkSession
    schema = "place int, n double, mean_x double, mean_y double, cxx double, cyy double, cxy double"
    if not again:
        return spark.createDataFrame([tuple(None if v is None else float(v) if k else v for k, v in enumerate(r)) for r in rows], schema)
    kept = {p for p, _, _ in again}
    out = spark.createDataFrame([tuple(None if v is None else float(v) if k else v for k, v in enumerate(r)) for r in rows if r[0] not in kept], schema)
    return out.unionByName(_pair_rows_again(df, again))


#: A centred sum of squares below this part of the shifted one (the pair's mean lies some standard
#: deviations from the column's) has lost digits that a nearly perfect fit needs.
LOST = 0.1


def _pair_rows_again(df: DataFrame, placed: Sequence[tuple[int, str, str]]) -> DataFrame:
    """:func:`_pair_rows` of few pairs, each shifted by its own means: after the pass for the means one
    aggregate for AGG_CHUNK / 6 pairs, then a row for each pair."""
    pairs = [(x, y) for _, x, y in placed]
    df, at = _known(df, [c for pair in pairs for c in pair])
    means, out, step = _pair_means(df, pairs, at), None, AGG_CHUNK // 6
    for lo in range(0, len(pairs), step):
        chunk = list(enumerate(pairs[lo:lo + step]))
        sums = df.agg(*[x for i, (a, b) in chunk for x in _pair_moments(at[a], at[b], *means[lo + i], str(i))])
        rows = ", ".join(", ".join([str(placed[lo + i][0]), f"double('{means[lo + i][0]!r}')", f"double('{means[lo + i][1]!r}')", *[f"{c}{i}" for c in SUMS]]) for i, _ in chunk)
        part = sums.selectExpr(f"stack({len(chunk)}, {rows}) AS (place, shift_x, shift_y, {', '.join(SUMS)})")
        out = part if out is None else out.unionByName(part)
    centred = lambda s, a, b: F.col(s) - F.try_divide(F.col(a) * F.col(b), F.col("n"))
    zero = lambda v, s: F.when(v > F.lit(1e-12) * F.col(s), v).otherwise(F.lit(0.0))
    return out.select("place", "n", (F.col("shift_x") + F.try_divide("sx", "n")).alias("mean_x"), (F.col("shift_y") + F.try_divide("sy", "n")).alias("mean_y"),
                      zero(centred("sxx", "sx", "sx"), "sxx").alias("cxx"), zero(centred("syy", "sy", "sy"), "syy").alias("cyy"),
                      centred("sxy", "sx", "sy").alias("cxy"))


def _by_place(values: Sequence) -> Column:
    """The value that belongs to a row's place in the list."""
    return F.get(F.lit(list(values)), F.col("place"))


def _corr_rows(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """var1, var2, r: pairwise-complete Pearson correlations."""
    if not pairs:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, r double")
    r = F.try_divide(F.col("cxy"), F.sqrt("cxx") * F.sqrt("cyy"))
    return _pair_rows(df, pairs).select(_by_place([a for a, _ in pairs]).alias("var1"), _by_place([b for _, b in pairs]).alias("var2"), r.alias("r"))


def corr_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation for every ordered pair (F10), long form
    (var1, var2, r), pairwise-complete; the diagonal is 1; null where a
    column is constant over the pair's rows. Two scans for any number of
    columns."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    half = _corr_rows(df, pairs)
    # both orientations come from the same row: one pass for each chunk
    both = half.select(F.explode(F.array(F.struct("var1", "var2", "r"),
                                         F.struct(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "r"))).alias("x")).select("x.*")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "var1 string, var2 string, r double")
    return both.unionByName(diag)


def corr_topk(df: DataFrame, target: str, cols: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Top ``k`` columns by correlation with ``target``, the target itself
    included (F11)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    others = [c for c in cols if c != target]
    rows = _corr_rows(df, [(c, target) for c in others]).select(F.col("var1").alias("column_name"), "r")
    rows = rows.unionByName(df.sparkSession.createDataFrame([(target, 1.0)], "column_name string, r double"))
    return rows.orderBy(F.desc_nulls_last("r"), "column_name").limit(k)


def box_by_category(df: DataFrame, category: str, value: str) -> DataFrame:
    """Box-plot numbers per category (F12): quartiles (exact), IQR, whiskers
    at the most extreme values within 1.5·IQR, outlier count. The quartile
    table (one row per category) is joined back for the whisker pass."""
    probs = [0.25, 0.5, 0.75]
    q = (exact_quantiles(df, value, probs, [category])
         .groupBy(category).pivot("prob", probs).agg(F.first("q"))
         .select(category, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3")))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    v = _num(value)
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    j = df.select(category, value).where(v.isNotNull()).join(_small(q), category, "inner")
    w = j.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count_if((v < lo) | (v > hi)).alias("n_outliers"))
    return q.join(w, category, "inner")


#: Group tables of at most so many rows are broadcast instead of shuffling every row on its group.
BROADCAST_GROUPS = 100_000


def _small(groups: DataFrame) -> DataFrame:
    """A per-group table, computed once into the shared checkpoint folder;
    marked for broadcast if its counted size allows it."""
    ensure_checkpoint_dir(groups.sparkSession)
    groups = groups.checkpoint(eager=True)
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def minmax(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(_num(col)), F.max(_num(col))).first()
    return r[0], r[1]


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [lo, hi]; the maximum goes to the last bin."""
    width = (hi - lo) / bins if hi > lo else 1.0
    return F.least(F.floor((x.cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram with the normal fit's mean and std (F13). The
    range comes from one min/max aggregate (one row)."""
    x = _num(col)
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"),
                F.avg(x).alias("mean"), F.stddev_samp(x).alias("std")).first()
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count long, mean double, std double")
    width = (hi - lo) / bins if hi > lo else 1.0
    h = (df.where(x.isNotNull()).select(bin_index(x, lo, hi, bins).alias("bin"))
         .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    return h.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "count",
                    F.lit(st["mean"]).cast("double").alias("mean"), F.lit(st["std"]).cast("double").alias("std"))


def density_by_category(df: DataFrame, category: str, value: str, points: int = 50,
                        binned: int | None = None) -> DataFrame:
    """Gaussian kernel density per category (F14), Scott's bandwidth
    h = std·n^(−1/5), evaluated on ``points`` grid points from min−3h to
    max+3h. Exact (every row contributes to every grid point) in one pass:
    the per-category statistics are joined back (one row per category) and
    each row adds its kernel value to ``points`` sum aggregates; nothing is
    exploded or gathered.

    ``binned=N`` is the large-data form: rows are first reduced to N
    equal-width bins per category (one partial aggregate), and the kernel
    is summed over bin centres weighted by their counts — N·points kernel
    evaluations per category instead of rows·points. Each bin sits at the
    mean of its rows, so the error is of order (bin width / h)², negligible
    for N in the thousands."""
    x = _num(value)
    stats = df.where(x.isNotNull()).groupBy(category).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(x).alias("sd"),
        F.min(x).alias("mn"), F.max(x).alias("mx"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("g0", F.col("mn") - 3 * F.col("h")).withColumn(
        "gstep", (F.col("mx") - F.col("mn") + 6 * F.col("h")) / F.lit(points - 1))
    j = df.select(category, x.alias("__x")).where(F.col("__x").isNotNull()).join(_small(stats), category, "inner")
    weight = F.lit(1.0)
    if binned:
        width = (F.col("mx") - F.col("mn")) / F.lit(binned)
        b = F.least(F.floor(F.try_divide(F.col("__x") - F.col("mn"), width)), F.lit(binned - 1))
        b = F.when(width > 0, b).otherwise(F.lit(0))
        # each bin is placed at the mean of its rows (not its centre), so the
        # error is second order even when one value holds many rows
        j = (j.withColumn("__bin", b).groupBy(category, "n", "h", "g0", "gstep", "__bin")
             .agg(F.count(F.lit(1)).alias("__w"), F.avg("__x").alias("__x")))
        weight = F.col("__w").cast("double")
    sums = []
    for i in range(points):
        g = F.col("g0") + F.lit(i) * F.col("gstep")
        z = F.try_divide(g - F.col("__x"), F.col("h"))  # a category of one value has no density: null
        sums.append(F.sum(weight * F.exp(-0.5 * z * z)).alias(f"k{i}"))
    agg = j.groupBy(category, "n", "h", "g0", "gstep").agg(*sums)
    long = agg.select(category, "n", "h", "g0", "gstep", F.posexplode(F.array(*[F.col(f"k{i}") for i in range(points)])).alias("point", "ksum"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return long.select(category, "point", (F.col("g0") + F.col("point") * F.col("gstep")).alias("x"),
                       F.try_divide(F.col("ksum"), norm).alias("density"))


def grid_heatmap(df: DataFrame, x: str, y: str, step: float, value: str | None = None) -> DataFrame:
    """Counts (and mean value) per grid cell of size ``step``."""
    cx = F.floor(_num(x) / F.lit(step)).cast("long").alias("cell_x")
    cy = F.floor(_num(y) / F.lit(step)).cast("long").alias("cell_y")
    aggs = [F.count(F.lit(1)).alias("count")]
    if value:
        aggs.append(F.avg(_num(value)).alias("mean_value"))
    return df.where(_num(x).isNotNull() & _num(y).isNotNull()).groupBy(cx, cy).agg(*aggs)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """Two-variable point cloud as 2-D binned counts over the rows that know
    both (F22); no rows without any."""
    both = df.select(_num(x).alias("x"), _num(y).alias("y")).na.drop()
    xl, xh, yl, yh = both.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if xl is None:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, count long")
    return both.groupBy(bin_index(F.col("x"), xl, xh, bins).alias("bin_x"),
                        bin_index(F.col("y"), yl, yh, bins).alias("bin_y")).agg(F.count(F.lit(1)).alias("count"))


def _ols_one_finish(rows: DataFrame) -> DataFrame:
    n = F.col("n").cast("double")
    ssr = F.col("syy") * (1 - F.col("r2"))
    llf = -n / 2 * (F.lit(math.log(2 * math.pi)) + F.ln(F.try_divide(ssr, n)) + 1)
    return rows.select(
        *[c for c in rows.columns if c not in ("syy",)],
        (1 - F.try_divide((1 - F.col("r2")) * (n - 1), n - 2)).alias("adj_r2"),
        (F.try_divide(F.col("r2"), 1 - F.col("r2")) * (n - 2)).alias("f_stat"),
        llf.alias("llf"), (-2 * llf + 4).alias("aic"))


def _ols_rows(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """column_name and one-predictor OLS for each x over the complete (x, y)
    pairs, in one pass after the pass for the means. A constant column has
    null estimates."""
    slope, cxy = F.try_divide(F.col("cxy"), F.col("cxx")), F.col("cxy")
    rows = _pair_rows(df, [(c, y) for c in xs]).select(
        _by_place(list(xs)).alias("column_name"), F.col("n").cast("long").alias("n"), slope.alias("slope"), (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
        F.try_divide(cxy * cxy, F.col("cxx") * F.col("cyy")).alias("r2"), F.col("cyy").alias("syy"))
    return _ols_one_finish(rows)


def ols_one(df: DataFrame, y: str, x: str) -> DataFrame:
    """One-predictor OLS with intercept (F16): slope, intercept, R², n,
    adj. R², F, log-likelihood, AIC."""
    return _ols_rows(df, y, [x]).drop("column_name")


def ols_screen(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Every column screened by one-predictor OLS, sorted by adj. R² (F17):
    one aggregate for all columns, not a job per column. Columns without an
    estimate (constant ones) come last."""
    return _ols_rows(df, y, xs).orderBy(F.desc_nulls_last("adj_r2"), "column_name")


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F19."""
    d = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(d).alias("n"))


def last_wins(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Last value per key by ``order`` (F20), keeping the first position;
    ``max_by``/``min_by`` are partial aggregates."""
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(key).agg(F.max_by(F.col(value), o).alias(value), F.min(o).alias("first_at"))


def residual_bins(df: DataFrame, label: str, prediction: str, bins: int = 10,
                  split: str | None = None, by: str | None = None) -> DataFrame:
    """Residual (prediction − label) summary per prediction bin (or bin of
    column ``by``) and split (F21). Rows without a prediction have no bin;
    a missing label counts in ``n`` only."""
    by = by or prediction
    df = df.where(_num(prediction).isNotNull() & _num(by).isNotNull())
    lo, hi = minmax(df, by)
    lo, hi = (0.0, 0.0) if lo is None else (lo, hi)
    r = _num(prediction) - _num(label)
    keys = [split] if split else []
    return (df.groupBy(*keys, bin_index(_num(by), lo, hi, bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(r).alias("mean_residual"), F.stddev_samp(r).alias("sd_residual")))


def zscore_tails(df: DataFrame, value: str, key: str, k: int = 10) -> DataFrame:
    """Z-scores with the *population* std; the ``k`` lowest and ``k`` highest
    rows (G3). Mean/std are one aggregate row; each tail is a
    ``TakeOrderedAndProject`` (top-k, no full sort). The z of a constant
    column is null."""
    v = _num(value)
    st = df.agg(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")).first()
    z = F.try_divide(v - F.lit(st["m"]).cast("double"), F.lit(st["s"]).cast("double")).alias("z")
    d = df.where(v.isNotNull()).select(key, value, z)
    low = d.orderBy(F.asc("z"), F.asc(key)).limit(k).withColumn("tail", F.lit("low"))
    high = d.orderBy(F.desc("z"), F.asc(key)).limit(k).withColumn("tail", F.lit("high"))
    return low.unionByName(high)


def qq_points(df: DataFrame, value: str) -> DataFrame:
    """Normal probability-plot points (G4): the i-th order statistic against
    the standard-normal quantile at Filliben's position
    m_n = 0.5^(1/n), m_1 = 1 − m_n, m_i = (i − 0.3175)/(n + 0.365).
    Ranks come from :func:`order_statistics` (no one-task window)."""
    os = order_statistics(df, value)
    i = F.col("rank").cast("double")
    n = F.col("n").cast("double")
    mn = F.pow(F.lit(0.5), 1 / n)
    m = F.when(F.col("rank") == F.col("n"), mn).when(F.col("rank") == 1, 1 - mn).otherwise(
        (i - 0.3175) / (n + 0.365))
    return os.select("rank", inv_norm_cdf(m).alias("osm"), F.col(value).alias("osr"))


def qq_fit(df: DataFrame, value: str) -> DataFrame:
    """Least-squares line through the QQ points: slope, intercept, r (G4). A
    single point has no line and a constant column no r (null)."""
    p = qq_points(df, value)
    sums = p.agg(F.count(F.lit(1)).alias("n"), F.avg("osm").alias("mx"), F.avg("osr").alias("my"), F.min("osr").alias("lo"), F.max("osr").alias("hi"),
                 F.var_pop("osm").alias("vx"), F.var_pop("osr").alias("vy"), F.covar_pop("osm", "osr").alias("c"))
    flat = F.col("lo") == F.col("hi")
    slope = F.when(flat, F.when(F.col("vx") > 0, F.lit(0.0))).otherwise(F.try_divide("c", F.col("vx")))
    sums = sums.withColumn("slope", slope)
    return sums.select("slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"),
                       F.when(~flat, F.try_divide(F.col("c"), F.sqrt("vx") * F.sqrt("vy"))).alias("r"), "n")
