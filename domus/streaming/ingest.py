"""Incremental ingest of landed drops (K1): Structured Streaming over the
landing folder, each micro-batch flattened, change-detected against the
current table and merged into a new table version.

Replaying a batch after a failure is safe: a version only counts once fully
committed, and a bucketed table skips a batch that its stream has recorded. (A
table of full versions is safe for non-null keys: upsert(upsert(t, s), s) =
upsert(t, s).) A stream that starts with a fresh checkpoint is another stream:
its batches are merged after what the table holds."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from domus.operators.cdc import changed_or_new_unique, prepare_source, upsert
from domus.operators.columns import flatten_structs
from domus.session import read_text
from domus.sinks.buckets import ROWS_PER_BUCKET, merge_bucketed
from domus.sinks.writers import latest_version_path, write_version


def ingest_drops(spark: SparkSession, landing: str, schema: T.StructType | str, table: str, key: str,
                 price: str, checkpoint: str, order_by: Sequence[str],
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 files_per_batch: int | None = 1, available_now: bool = True, bucketed: bool = False,
                 rows_per_bucket: int = ROWS_PER_BUCKET):
    """Start (and, with ``available_now``, finish) the stream; returns the
    query. ``prepare`` maps a flattened batch to the table's columns. Of
    repeated keys in a batch the latest by ``order_by`` (such as the time of
    the search) is merged; rows without a key are inserted each. A table that
    does not exist yet is started by the first batch, under the same rule.

    With ``bucketed`` the table is one of :mod:`domus.sinks.buckets`: a batch
    becomes the next version, which holds the touched buckets only and says
    which batch of which stream it is. Without it every batch writes a new
    full version."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(landing)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        flat = flatten_structs(batch)
        if prepare is not None:
            flat = prepare(flat)
        if bucketed:
            # Spark gives every checkpoint an id of its own
            stream_id = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
            merge_bucketed(spark, flat, table, key, (stream_id, batch_id), "latest", order_by, price, rows_per_bucket)
            return
        flat = prepare_source(flat, key, "latest", order_by).persist()  # used by several actions below
        try:
            cur = latest_version_path(spark, table)
            if cur is None:
                write_version(flat, table)
                return
            target = spark.read.parquet(cur)
            changed = changed_or_new_unique(flat, target, key, price).drop("fingerprint")
            write_version(upsert(target, changed, key, dedupe="none"), table)
        finally:
            flat.unpersist()

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
