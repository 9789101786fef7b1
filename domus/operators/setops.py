"""Set operations (H1, H2) and key joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_many(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """Union all of many frames (H1). By name with missing columns as null by
    default; ``by_name=False`` is the positional union that fails on unequal
    column counts. (Reading many paths in one ``read`` is cheaper still.)"""
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return reduce(lambda a, b: a.union(b), frames)


def flatten_lists(c: Column | str) -> Column:
    """list of lists → one list (H2)."""
    return F.flatten(F.col(c) if isinstance(c, str) else c)


def left_join(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left equi join on a key column."""
    return left.join(right, key, "left")


def attach_by_key(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach columns of a one-to-one frame by row key (E3); the key is a
    column, not an index."""
    return left.join(right, key, "inner")
