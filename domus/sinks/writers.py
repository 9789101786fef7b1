"""Sinks (B1–B7).

Upserts never overwrite the folder they read: every write of a table goes
to a new ``version=NNNNNN`` sub-folder, and a version counts only once its
``_SUCCESS`` marker exists (Spark's committer writes it last). Readers take
the newest committed version, so a failed or lost job leaves the previous
version readable and a retry simply writes the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.operators.cdc import prepare_source, upsert
from domus.session import list_dir, path_exists
from domus.sinks.buckets import VERSION_PREFIX, merge_bucketed, read_bucketed, write_bucketed  # noqa: F401


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table folder (B1)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_drops(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                     compression: str = "gzip", mode: str = "append") -> None:
    """gz JSON lines, one folder per search coordinate (B2)."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """CSV result files with a header."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None,
               properties: dict | None = None, mode: str = "overwrite") -> None:
    """Overwrite a JDBC table (B4). Credentials are the caller's business
    (``properties``); nothing is read from the environment."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if driver:
        w = w.option("driver", driver)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def replace_interval(target: DataFrame, source: DataFrame, ts_col: str, lo, hi) -> DataFrame:
    """Replace everything in ``[lo, hi)`` of the target by the source's rows
    in that interval (B5). Lazy; write with :func:`overwrite_parquet`, or
    use date partitions + ``partitionOverwriteMode=dynamic``."""
    inside: Column = (F.col(ts_col) >= F.lit(lo)) & (F.col(ts_col) < F.lit(hi))
    return target.where(~inside | F.col(ts_col).isNull()).unionByName(source.where(inside),
                                                                       allowMissingColumns=True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df`` are
    replaced (B5 on partitioned tables)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def register_table(spark: SparkSession, database: str, table: str, path: str,
                   db_location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS + external table over a folder."""
    loc = f" LOCATION '{db_location}'" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` USING PARQUET LOCATION '{path}'")


def create_table_as(spark: SparkSession, database: str, table: str, query: str, path: str) -> None:
    """CREATE TABLE … AS SELECT."""
    spark.sql(f"CREATE TABLE `{database}`.`{table}` USING PARQUET LOCATION '{path}' AS {query}")


# ------------------------------------------------------------ versioned tables

def _versions(spark: SparkSession, path: str) -> list[int]:
    out = []
    for name in list_dir(spark, path):
        if name.startswith(VERSION_PREFIX):
            try:
                out.append(int(name[len(VERSION_PREFIX):]))
            except ValueError:
                pass
    return sorted(out)


def latest_version_path(spark: SparkSession, path: str) -> str | None:
    for v in reversed(_versions(spark, path)):
        p = f"{path}/{VERSION_PREFIX}{v:06d}"
        if path_exists(spark, p + "/_SUCCESS"):
            return p
    return None


def write_version(df: DataFrame, path: str) -> str:
    """Write ``df`` as the next version of the table at ``path``."""
    spark = df.sparkSession
    vs = _versions(spark, path)
    nxt = (vs[-1] + 1) if vs else 0
    p = f"{path}/{VERSION_PREFIX}{nxt:06d}"
    df.write.mode("errorifexists").parquet(p)
    return p


def upsert_table(spark: SparkSession, source: DataFrame, path: str, key: str,
                 dedupe: str = "latest", order_by: Sequence[str] = ()) -> str:
    """Merge ``source`` into the versioned table at ``path`` (B7): read the
    newest version (or the cold start), upsert, write the next version."""
    from domus.sources.readers import read_table_or_empty
    cur = latest_version_path(spark, path)
    if cur is None:
        return write_version(prepare_source(source, key, dedupe, order_by), path)
    target = read_table_or_empty(spark, path)
    return write_version(upsert(target, source, key, dedupe, order_by, materialize=True), path)
