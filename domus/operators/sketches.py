"""Profiles that merge (F5, F6, F18 without a rescan).

A sketch row holds a column's counts, its extremes, a quantile sketch (KLL) and a distinct-count sketch
(HyperLogLog). Each version or drop of a table gets its sketch rows once; the profile of any union of
them is a merge of those rows, so a table that grows is never read again for its profile. Ranks of
quantiles are off by about 1.8 / ``K`` of the rows, distinct counts by about 1.04 / sqrt(2^``LG``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.operators.profile import _long_rows, _num, numeric_columns

K, LG = 400, 13


def sketch_columns(df: DataFrame, cols: Sequence[str] | None = None, k: int = K, lg: int = LG) -> DataFrame:
    """column_name, rows, known, lo, hi, quantiles, distinct (sketches): one aggregate. NaN counts as missing."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return _long_rows(df, cols, {
        "rows": lambda c: F.count(F.lit(1)), "known": lambda c: F.count(_num(c)), "lo": lambda c: F.min(_num(c)), "hi": lambda c: F.max(_num(c)),
        "quantiles": lambda c: F.kll_sketch_agg_double(_num(c), F.lit(k)), "distinct": lambda c: F.hll_sketch_agg(_num(c).cast("string"), F.lit(lg))})


def merge_sketches(rows: DataFrame) -> DataFrame:
    """Sketch rows of several tables as those of their union: a partial aggregate by column."""
    return rows.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))


def read_sketches(rows: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, rows, known, missing, lo, hi, n_distinct, and ``p25`` ... for the probabilities; a
    column without known values has nulls."""
    some = F.col("known") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(f"p{round(100 * p)}") for p in probs]
    return rows.select("column_name", "rows", "known", (F.col("rows") - F.col("known")).alias("missing"), "lo", "hi", F.hll_sketch_estimate("distinct").alias("n_distinct"), *at)
