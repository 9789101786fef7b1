"""Filters and predicates (D1–D11). Plain ``where`` clauses, so Catalyst
pushes them into the Parquet scan when they touch stored columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_keys(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """Membership in a set of keys held by another frame (D1): a
    ``left_semi`` join instead of splicing ids into SQL text."""
    kk = keys_key or key
    return df.join(keys.select(F.col(kk).alias(key)), key, "left_semi")


def at_most(df: DataFrame, col: str, bound) -> DataFrame:
    """Upper bound."""
    return df.where(F.col(col) <= F.lit(bound))


def nonzero(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose value is 0 or missing (D3: null and NaN count as 0)."""
    kept = F.coalesce(F.col(col), F.lit(0)) != 0
    return df.where(kept & ~F.isnan(col) if df.schema[col].dataType.typeName() in ("double", "float") else kept)


def one_of(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Value in a list."""
    return df.where(F.col(col).isin(list(values)))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop(how="any", subset=list(cols))


def drop_keys(df: DataFrame, col: str, keys: Sequence) -> DataFrame:
    """Drop rows by key."""
    return df.where(~F.col(col).isin(list(keys)))


def positive(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with a positive value."""
    return df.where(F.col(col) > 0)


def lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Point look-up by key (D8); pushed into the scan as ``EqualTo``."""
    return df.where(F.col(col) == F.lit(value))


def starts_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Prefix test."""
    return df.where(F.col(col).startswith(prefix))


def is_json(c: Column | str) -> Column:
    """True when the text is valid JSON (D10), null for null text."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isNotNull(), F.try_parse_json(x).isNotNull())


def valid_json(df: DataFrame, col: str) -> DataFrame:
    return df.where(is_json(col))


def quarantine(df: DataFrame, rules: Mapping[str, Column], reason_col: str = "reasons",
               ok_col: str = "ok") -> DataFrame:
    """Record conformance (D11): one boolean expression per rule; adds the
    list of broken rule names (null-safe: a rule that evaluates to null is
    broken) and an ``ok`` flag. ``where(ok)`` / ``where(~ok)`` split it."""
    names = list(rules)
    broken = F.filter(F.array(*[F.when(~F.coalesce(rules[n], F.lit(False)), F.lit(n)) for n in names]),
                      lambda x: x.isNotNull())
    return df.withColumn(reason_col, broken).withColumn(ok_col, F.size(F.col(reason_col)) == 0)
