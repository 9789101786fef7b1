"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.session import scratch_path

#: ASCII white space, as a Java/Python regex class body.
SPACE = r"\x20\x09-\x0D"


def words_of(text: Column) -> Column:
    """Maximal runs of non-white-space (``[^\\x20\\x09-\\x0D]+``); null text: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it (ignoring case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: a cut in the
    lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(rows: float, per_bucket: float, least: int = 1) -> int:
    """How many buckets hold ``rows`` at about ``per_bucket`` each."""
    return max(least, math.ceil(rows / per_bucket))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
