"""Query catalogue: each entry binds an operator to the driver's tables and
carries the equivalent DuckDB SQL (the oracle), when one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    ids: str
    bench: bool = False


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, ids: str = "", bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids, bench)
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


# ---- rounding shared by both sides -------------------------------------

def sql_sig(expr: str, digits: int = 6) -> str:
    """SQL twin of :func:`domus.functions.scalar.sig_round`."""
    x = f"CAST(({expr}) AS DOUBLE)"
    k = f"({digits - 1} - floor(log10(abs({x}))))"
    up = f"pow(10.0, {k})"
    down = f"pow(10.0, -{k})"
    return (f"(CASE WHEN {x} = 0 THEN 0.0 WHEN {k} >= 0 THEN round({x} * {up}) / {up} "
            f"ELSE round({x} / {down}) * {down} END)")


def sql_round(expr: str, digits: int) -> str:
    """SQL twin of :func:`domus.functions.scalar.dround`."""
    p = float(10 ** digits)
    return f"(round(CAST(({expr}) AS DOUBLE) * {p!r}) / {p!r})"


def sql_money_avg(expr: str, decimals: int = 2) -> str:
    """SQL twin of :func:`domus.functions.scalar.money_avg`."""
    scale = float(10 ** decimals)
    return f"((CAST(sum(CAST(round(({expr}) * {scale!r}) AS BIGINT)) AS DOUBLE) / count({expr})) / {scale!r})"
