"""Tables split by a hash bucket of the key, so that a small drop rewrites the buckets it touches.

Layout: ``version=NNNNNN/_bucket=B/`` holds the buckets a merge wrote, ``_commits/NNNNNN.json`` its
record. A version counts once its record exists; the record says all that a reader needs: the number
of buckets, for each bucket the version that holds it, the table's columns, and the last batch of each
stream. Nothing is replaced in place, and a version folder without a record (a stopped merge) is not
read; its number is written anew.

*Waiting rows.* A batch that is small beside a bucket does not rewrite it: its rows wait in the batch's
version folder, and the record lists for each bucket the versions that wait, oldest first. Once they
reach a share of the bucket (``SHARE``) they are merged into it, and a batch takes waiting ones no
larger than itself into its own, so a row is written a few times however many batches come. Readers
merge what waits. Rows wait as they came, with the rule of change detection kept: of a key's rows the
last one counts that differs in price from the one before (see :func:`_folded`).

*Growth.* A bucket that would pass ``rows_per_bucket`` doubles the number of buckets (again and again,
if need be): bucket ``b`` becomes ``b`` and ``b + n`` by the same hash. Only touched buckets are
rewritten; the others go on living in their old folder, of which a reader takes the rows of its bucket.

*Columns.* The table's columns are kept by widening: a column that comes later is added, one that is
missing is null for new rows and keeps its value for matched ones, numbers widen, and types that do not
go together raise an error. Every read is by the table's columns.

*Replay.* A batch that its stream has recorded is skipped. A stream with a new checkpoint has a new
id, so its batches are merged after what is there.

One writer at a time; of two merges that race, the later one fails on the record and changes nothing."""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.functions.scalar import fingerprint
from domus.operators.cdc import changed_or_new_unique, prepare_source, upsert
from domus.session import create_text, list_dir, read_text

BUCKET_COL, HASH_COL = "_bucket", "_hash"
VERSION_PREFIX, COMMITS = "version=", "_commits"
ROWS_PER_BUCKET = 1_000_000
ROWS_PER_TASK = 500_000
#: Of rows that wait: they replace the key's stored row whatever its price; the version they came with.
SURE_COL, AT_COL = "_sure", "_version"
#: Waiting rows are merged into their bucket when they reach this share of its rows.
SHARE = 0.5

# Numbers from narrow to wide.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def widen(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both; an error if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    real = (T.FloatType(), T.DoubleType())
    if a in real and b in real:
        return T.DoubleType()
    if T.DoubleType() in (a, b) and (a if b == T.DoubleType() else b) in _WHOLE[:3]:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} do not go together")


def merged_schema(table: T.StructType, source: T.StructType) -> T.StructType:
    """The table's columns widened by the source's, new ones at the end; all nullable."""
    new = {f.name: f.dataType for f in source}
    fields = [T.StructField(f.name, widen(f.name, f.dataType, new.pop(f.name, f.dataType))) for f in table]
    return T.StructType([*fields, *[T.StructField(n, t) for n, t in new.items()]])


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns that ``df`` has, in the schema's types and order."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])


class _Record:
    """The newest record of a table. ``owner[b]``: version that holds bucket b (-1: no rows yet);
    ``sizes[v]``: number of buckets when version v was written; ``rows[b]``: rows of bucket b;
    ``waiting[b]``: [version, rows] of those that wait for it, oldest first, counted in ``rows`` too;
    ``folders[v]``: number of buckets with rows that version v wrote;
    ``by``: key and price by which they are to be merged."""

    def __init__(self, version=-1, buckets=1, owner=None, rows=None, sizes=None, streams=None, schema=None, waiting=None, by=None, folders=None):
        self.version, self.buckets = version, buckets
        self.owner, self.rows = owner or [-1] * buckets, rows or [0] * buckets
        self.sizes, self.streams = {int(v): n for v, n in (sizes or {}).items()}, streams or {}
        self.schema = schema
        self.waiting, self.by = waiting or [[] for _ in range(buckets)], by or [None, None]
        self.folders = {int(v): n for v, n in (folders or {}).items()}

    @staticmethod
    def newest(spark: SparkSession, path: str) -> "_Record":
        found = sorted(n for n in list_dir(spark, f"{path}/{COMMITS}") if n.endswith(".json") and not n.startswith("."))
        if not found:
            return _Record()
        d = json.loads(read_text(spark, f"{path}/{COMMITS}/{found[-1]}"))
        return _Record(d["version"], d["buckets"], d["owner"], d["rows"], d["sizes"], d["streams"], T.StructType.fromJson(d["schema"]),
                       d.get("waiting"), d.get("by"), d.get("folders"))

    def commit(self, spark: SparkSession, path: str) -> None:
        used = {*self.owner, *(v for w in self.waiting for v, _ in w)}
        record = {"version": self.version, "buckets": self.buckets, "owner": self.owner, "rows": self.rows, "streams": self.streams, "schema": self.schema.jsonValue(), "waiting": self.waiting, "by": self.by,
                  "folders": {v: n for v, n in self.folders.items() if v in used},
                  "sizes": {v: n for v, n in self.sizes.items() if v in used or v == self.version}}
        if not create_text(spark, f"{path}/{COMMITS}/{self.version:06d}.json", json.dumps(record)):
            raise RuntimeError(f"version {self.version} of {path} was written by another merge")

    def doubled(self, times: int) -> None:
        for _ in range(times):
            self.owner, self.rows, self.buckets = self.owner * 2, [(r + 1) // 2 for r in self.rows] * 2, self.buckets * 2
            self.waiting = [[[v, (r + 1) // 2] for v, r in w] for w in self.waiting * 2]


def _hashed(df: DataFrame, key: str) -> DataFrame:
    """With the hash of the key; rows without a key are spread by their content. The hash stays with
    the row, so such rows keep their bucket when columns are added."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn(HASH_COL, F.when(F.col(f"`{key}`").isNull(), whole).otherwise(F.xxhash64(F.col(f"`{key}`").cast("string"))))


def _bucket(n: int) -> Column:
    return F.pmod(F.col(HASH_COL), F.lit(n)).cast("int")


def _in(n: int, buckets: Sequence[int]) -> Column:
    """Is the row's bucket one of these?"""
    return F.expr(f"cast(pmod({HASH_COL}, {n}) as int) in ({', '.join(map(str, buckets))})")


def _folders(record: _Record, path: str, held: dict[int, list[int]]) -> dict[int, list[tuple[str, list[int] | None]]]:
    """Of each version and the buckets to take of it: (folder, buckets; None: all its rows)."""
    out: dict[int, list[tuple[str, list[int] | None]]] = {}
    for v, buckets in sorted(held.items()):
        own: dict[int, list[int]] = {}
        for b in buckets:
            own.setdefault(b % record.sizes[v], []).append(b)
        out[v] = [(f"{path}/{VERSION_PREFIX}{v:06d}/{BUCKET_COL}={old}", None if len(bs) == record.buckets // record.sizes[v] else bs)
                  for old, bs in sorted(own.items())]
    return out


def _rows_of(spark: SparkSession, path: str, record: _Record, schema: T.StructType, held: dict[int, list[int]]) -> dict[int, DataFrame]:
    """The rows of the wanted buckets in each version that has some."""
    out = {}
    for v, folders in _folders(record, path, held).items():
        root = f"{path}/{VERSION_PREFIX}{v:06d}"
        there, every = {p for p, _ in folders}, record.folders.get(v)
        if every is None:  # an older record: buckets without rows have no folder
            there &= (found := {f"{root}/{name}" for name in list_dir(spark, root)})
            every = sum(p.rsplit("/", 1)[1].startswith(f"{BUCKET_COL}=") for p in found)
        if there and len(there) == every:
            # the folder as one path: thousands of them are looked up one by one
            df = spark.read.schema(schema).parquet(root).select(*[F.col(f"`{c}`") for c in schema.names])
            out[v] = df.where(_in(record.buckets, held[v])) if any(own for _, own in folders) else df
            continue
        whole = [p for p, own in folders if own is None and p in there]
        parts = [(p, own) for p, own in folders if own is not None and p in there]
        frames = [spark.read.schema(schema).parquet(*whole)] if whole else []
        if parts:
            # every row's bucket tells whether it is one of those that still live in the old folders
            mine = sorted(b for _, own in parts for b in own)
            frames.append(spark.read.schema(schema).parquet(*[p for p, _ in parts]).where(_in(record.buckets, mine)))
        if frames:
            out[v] = functools.reduce(DataFrame.unionByName, frames)
    return out


def _stored(spark: SparkSession, path: str, record: _Record, only: set[int] | None = None) -> DataFrame | None:
    """The rows of the buckets, without those that wait."""
    if record.schema is None:
        return None
    schema = T.StructType([*record.schema.fields, T.StructField(HASH_COL, T.LongType())])
    held: dict[int, list[int]] = {}
    for b, v in enumerate(record.owner):
        if v >= 0 and (only is None or b in only):
            held.setdefault(v, []).append(b)
    frames = _rows_of(spark, path, record, schema, held).values()
    return functools.reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _waiting(spark: SparkSession, path: str, record: _Record, take: dict[int, list[int]]) -> DataFrame | None:
    """The waiting rows of these versions (by bucket), with ``SURE_COL`` and ``AT_COL``."""
    if not any(take.values()):
        return None
    schema = T.StructType([*record.schema.fields, T.StructField(HASH_COL, T.LongType()), T.StructField(SURE_COL, T.BooleanType())])
    held: dict[int, list[int]] = {}
    for b, versions in take.items():
        for v in versions:
            held.setdefault(v, []).append(b)
    frames = [df.withColumn(AT_COL, F.lit(v)) for v, df in _rows_of(spark, path, record, schema, held).items()]
    return functools.reduce(DataFrame.unionByName, frames) if frames else None


def _folded(rows: DataFrame, key: str, price: str | None) -> DataFrame:
    """One row a key of rows that came one version after the other; rows without a key stay, each. As
    if they had been merged in turn: a row counts if its price differs from that of the key's row
    before it (a null price always does), and the last one that counts is left. Whether a key's first
    row counts depends on the stored row; a later one is sure."""
    k, p = f"`{key}`", fingerprint(key, price) if price is not None else F.lit(None).cast("string")
    turn = Window.partitionBy(F.col(k)).orderBy(AT_COL)
    rest = [c for c in rows.columns if c not in (key, AT_COL)]
    known = rows.where(F.col(k).isNotNull()).withColumn("__p", p).withColumn("__turn", F.row_number().over(turn)).withColumn("__before", F.lag("__p").over(turn))
    first = F.col("__turn") == 1
    counts = known.where(first | F.col(SURE_COL) | F.col("__p").isNull() | F.col("__before").isNull() | (F.col("__p") != F.col("__before")))
    counts = counts.withColumn(SURE_COL, F.when(first, F.col(SURE_COL)).otherwise(True))
    one = counts.groupBy(F.col(k)).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), "__turn").alias("__r"))
    one = one.select(F.col(k), *[F.col("__r")[c].alias(c) for c in rest])
    return one.unionByName(rows.where(F.col(k).isNull()).drop(AT_COL))


def _merged(target: DataFrame, rows: DataFrame, key: str, price: str | None) -> DataFrame:
    """Change detection, then the upsert, of rows with ``SURE_COL``."""
    if price is not None:
        # a row without a fingerprint always counts as changed
        rows = rows.withColumn("__new", F.when(~F.col(SURE_COL), fingerprint(key, price)))
        rows = changed_or_new_unique(rows, target, key, price, fingerprint_col="__new").drop("__new")
    return upsert(target, rows.drop(SURE_COL), key, "none")


def _read(spark: SparkSession, path: str, record: _Record, only: set[int] | None = None) -> DataFrame | None:
    found = _stored(spark, path, record, only)
    if found is None:
        return None
    rows = _waiting(spark, path, record, {b: [v for v, _ in w] for b, w in enumerate(record.waiting) if only is None or b in only})
    if rows is None:
        return found
    key, price = record.by
    return _merged(found, _folded(rows, key, price), key, price).select(*[F.col(f"`{c}`") for c in found.columns])


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as of its newest version, by its own columns; None if there is none yet."""
    found = _read(spark, path, _Record.newest(spark, path))
    return None if found is None else found.drop(HASH_COL)


def _write(rows: DataFrame, path: str, record: _Record, version: int, touched: list[int], expected: int, later: dict[int, list] | None = None) -> None:
    """The rows of the touched buckets (about ``expected``) as a version folder. A task writes a bucket
    of many rows, or many small buckets one after another. The rows of the buckets ``later`` wait, after
    the waiting versions that it gives.

    Tasks put their files in place themselves: a version counts by its record only, and the job's one
    thread would move each bucket's file in turn."""
    spark = rows.sparkSession
    place = f"{path}/{VERSION_PREFIX}{version:06d}"
    tasks = max(1, min(len(touched), max(4 * spark.sparkContext.defaultParallelism, expected // ROWS_PER_TASK)))
    rows = rows.withColumn(BUCKET_COL, _bucket(record.buckets)).repartition(tasks, BUCKET_COL)
    rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(BUCKET_COL).parquet(place)
    schema = T.StructType([T.StructField(HASH_COL, T.LongType()), T.StructField(BUCKET_COL, T.IntegerType())])
    counts = {r[0]: r[1] for r in spark.read.schema(schema).parquet(place).groupBy(BUCKET_COL).count().collect() if r[0] is not None}
    for b in touched:
        n = counts.get(b, 0)
        if later and b in later:
            held = record.rows[b] - sum(r for _, r in record.waiting[b])
            record.waiting[b] = [*later[b], *([[version, n]] if n else [])]
            record.rows[b] = held + sum(r for _, r in record.waiting[b])
        else:
            record.owner[b], record.rows[b], record.waiting[b] = version if n else -1, n, []
    record.folders[version] = len(counts)
    record.sizes[version] = record.buckets
    record.version = version


def write_bucketed(df: DataFrame, path: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Start a table; its number of buckets, a power of two that follows from the row count, is returned."""
    spark = df.sparkSession
    if _Record.newest(spark, path).version >= 0:
        raise ValueError(f"{path} is a table already")
    record = _Record(schema=merged_schema(T.StructType(), df.schema))
    n = df.count()
    record.doubled(max(0, -(-n // rows_per_bucket) - 1).bit_length())
    _write(_hashed(df, key), path, record, 0, list(range(record.buckets)), n)
    record.commit(spark, path)
    return record.buckets


def merge_bucketed(spark: SparkSession, source: DataFrame, path: str, key: str, batch: tuple[str, int] | None = None,
                   dedupe: str = "latest", order_by: Sequence[str] = (), price: str | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> list[int]:
    """Upsert ``source`` into a bucketed table as its next version (a small drop into a huge table does
    not rewrite the table, and many of them rewrite a bucket now and then); a table that does not exist
    yet is started. Returns the buckets written: none if ``batch`` (stream id, number) was merged
    before, or nothing came.

    ``price`` first drops the source rows that change nothing (E1). Rows that lack columns of the table,
    or may repeat keys (``dedupe='none'``), do not wait."""
    record = _Record.newest(spark, path)
    if batch is not None and record.streams.get(batch[0], -1) >= batch[1]:
        return []
    table_schema = merged_schema(record.schema or T.StructType(), source.schema)
    if key not in table_schema.names:
        raise ValueError(f"no column {key}")
    source = _hashed(_cast(prepare_source(source, key, dedupe, order_by), table_schema), key).persist()
    try:
        # a row for each touched bucket comes back
        coming = {r[0]: r[1] for r in source.groupBy(_bucket(record.buckets).alias("b")).count().collect()}
        record.schema = table_schema
        if coming:
            fullest = max(record.rows[b] + n for b, n in coming.items())
            times = max(0, -(-fullest // rows_per_bucket) - 1).bit_length()
            before = record.buckets
            record.doubled(times)
            coming = {b + before * k: -(-n // 2 ** times) for b, n in coming.items() for k in range(2 ** times)}
            # what waits by another rule is merged by that rule first
            other = {b for b, w in enumerate(record.waiting) if w} if record.by != [key, price] else set()
            plain = dedupe != "none" and not other and set(table_schema.names) <= set(source.columns)
            touched = sorted({*coming, *other})
            now, later, taken = [], {}, {}
            for b in touched:
                waits = sum(n for _, n in record.waiting[b])
                if not plain or record.owner[b] < 0 or waits + coming[b] >= SHARE * (record.rows[b] - waits):
                    now.append(b)
                    continue
                kept, size = list(record.waiting[b]), coming[b]
                while kept and kept[-1][1] <= size:
                    size += kept.pop()[1]
                later[b], taken[b] = kept, [v for v, _ in record.waiting[b][len(kept):]]
            version = record.version + 1
            rows = _for_buckets(spark, source, path, record, key, price, version, now, plain) if now else None
            if later:
                wait = source.withColumn(SURE_COL, F.lit(price is None)).where(_in(record.buckets, sorted(later)))
                old = _waiting(spark, path, record, taken)
                if old is not None:
                    wait = _folded(old.unionByName(wait.withColumn(AT_COL, F.lit(version))), key, price)
                rows = wait if rows is None else rows.unionByName(wait, allowMissingColumns=True)
            expected = sum(coming.values()) + sum(record.rows[b] for b in now) + sum(n for b in later for _, n in record.waiting[b][len(later[b]):])
            _write(rows, path, record, version, touched, expected, later)
            record.by = [key, price]
        else:
            touched = []
            record.version += 1
        if batch is not None:
            record.streams[batch[0]] = batch[1]
        record.commit(spark, path)
        return touched
    finally:
        source.unpersist()


def _for_buckets(spark: SparkSession, source: DataFrame, path: str, record: _Record, key: str, price: str | None, version: int, buckets: list[int],
                 plain: bool) -> DataFrame:
    """All rows of the buckets to be written anew: stored, waiting and coming ones. ``plain``: the last
    two are folded before they meet the stored ones."""
    rows = source.withColumn(SURE_COL, F.lit(price is None)).where(_in(record.buckets, buckets))
    target = None
    if any(record.owner[b] >= 0 for b in buckets):
        if plain:
            old = _waiting(spark, path, record, {b: [v for v, _ in record.waiting[b]] for b in buckets})
            if old is not None:
                rows = _folded(old.unionByName(rows.withColumn(AT_COL, F.lit(version))), key, price)
            target = _stored(spark, path, record, set(buckets))
        else:
            target = _read(spark, path, record, set(buckets))
        target = _cast(target, T.StructType([*record.schema.fields, T.StructField(HASH_COL, T.LongType())]))
        rows = _merged(target, rows, key, price)
    columns = [*record.schema.names, HASH_COL]
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast(record.schema[c].dataType).alias(c) for c in columns])
