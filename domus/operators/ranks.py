"""Distributed order statistics: exact selection by digits, global ranks by a sample sort.

*Selection* (:func:`exact_quantiles`): a double becomes a whole number of the same order (its bits),
and that number is read 16 bits at a time. A pass counts the rows of each digit behind the digits
already known, in a partial aggregate (at most 65,536 counts for each wanted place), and the counts
tell which digit holds the wanted rank. Rows are never exchanged, no sample and no cut points are
needed, and columns of any scale share the passes. Four passes at most; a pass takes all digits that
are left once few rows stand behind the known ones.

*Ranks* (:func:`distinct_value_ranks`): rows are counted by distinct value, the distinct values are
range-partitioned (``repartitionByRange``) and sorted inside partitions; running counts inside a
partition plus the sums of the partitions before it give each value its global rank. The sorted
partitions are written to the shared folder first, so partition numbers stay what they were."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.session import ensure_checkpoint_dir

DIGIT_BITS = 16
#: Places with at most so many rows behind them are read to the end in one pass.
FEW_ROWS = 1 << DIGIT_BITS
#: Tables of at most so many rows are broadcast.
BROADCAST_ROWS = 100_000
#: Distinct values of a sorted partition, at a guess.
PART_VALUES = 1_000_000


def _exponent(a: Column) -> Column:
    """The binary exponent of a size, off by one at most beside a power of two."""
    return F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1023))


def _put_together(v: Column, a: Column, e: Column, m: Column) -> Column:
    """The code out of a value, its size, exponent and mantissa (size over 2 to the exponent)."""
    unit = float(2**52)
    bits = lambda e, m: e.cast("long") * F.lit(2**52) + ((m - 1.0) * F.lit(unit)).cast("long")
    code = (F.when(a == 0.0, F.lit(0)).when(a == float("inf"), F.lit(2047 << 52)).when(a < 2.0**-1022, (a / F.lit(2.0**-1074)).cast("long"))
            .when(m >= 2.0, bits(e + 1024, m / 2.0)).when(m < 1.0, bits(e + 1022, m * 2.0)).otherwise(bits(e + 1023, m)))
    return F.when(v < 0, -code).otherwise(code)


def order_code(c: Column) -> Column:
    """A whole number that orders doubles as they are (0.0 and -0.0 alike): sign, exponent and
    mantissa put together by exact arithmetic. Null stays null; NaN has no place, take it out before."""
    a = F.abs(c.cast("double"))
    return _put_together(c, a, _exponent(a), a / F.pow(F.lit(2.0), _exponent(a)))


def with_order_code(df: DataFrame, value: str, out: str) -> DataFrame:
    """:func:`order_code` of a column of doubles, step by step, so that no part is computed twice."""
    v = F.col(value)
    df = df.withColumn("__a", F.abs(v)).withColumn("__e", _exponent(F.col("__a"))).withColumn("__m", F.col("__a") / F.pow(F.lit(2.0), F.col("__e")))
    return df.withColumn(out, _put_together(v, F.col("__a"), F.col("__e"), F.col("__m"))).drop("__a", "__e", "__m")


def code_value(code: Column) -> Column:
    """The double of an :func:`order_code`."""
    a = F.abs(code)
    field = F.shiftright(a, 52)
    rest = a.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    value = (F.when(field == 2047, F.lit(float("inf"))).when(field == 0, rest * F.lit(2.0**-1074))
             .otherwise(F.pow(F.lit(2.0), (field - 1023).cast("double")) * (1.0 + rest / float(2**52))))
    return F.when(code < 0, -value).otherwise(value)


def _known_values(df: DataFrame, value: str, g: Sequence[str]) -> DataFrame:
    return (df.select(*g, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v")))


def _over(g: Sequence[str], *more: str):
    keys = [*g, *more]
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null (a null group is a group)."""
    b = b.select(*[F.col(c).alias("__r_" + c) if c in keys else F.col(c) for c in b.columns])
    on = [a[c].eqNullSafe(b["__r_" + c]) for c in keys]
    return a.join(b, on, how).drop(*["__r_" + c for c in keys])


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation between order statistics (the pandas / ``percentile_cont``
    rule), exact, one row per (groups, prob) with column ``q``. Null and NaN values are left out; a
    group without any has no row.

    Each pass is one scan with a partial aggregate. What is wanted (2 places for each prob and group)
    is counted and broadcast up to ``BROADCAST_ROWS`` places; for more groups than that Spark joins it."""
    ensure_checkpoint_dir(df.sparkSession)
    g = list(groups)
    codes = with_order_code(_known_values(df, value, g), "__v", "__code").drop("__v")
    shift = 64 - DIGIT_BITS
    first = codes.groupBy(*g, F.shiftright("__code", shift).alias("__at")).agg(F.count(F.lit(1)).alias("cnt"))
    running = _over(g).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    counted = first.withColumn("start", F.coalesce(F.sum("cnt").over(running), F.lit(0))).withColumn("n", F.sum("cnt").over(_over(g)))
    wanted = counted.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    wanted = wanted.withColumn("h", (F.col("n") - 1) * F.col("prob")).withColumn("t", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.floor("h").alias("r")), F.struct(F.lit(1).alias("side"), F.ceil("h").alias("r")))))
    wanted = wanted.where((F.col("t.r") >= F.col("start")) & (F.col("t.r") < F.col("start") + F.col("cnt")))
    wanted = wanted.select(*g, "prob", "h", F.col("t.side").alias("side"), "__at", (F.col("t.r") - F.col("start")).alias("r"), "cnt").checkpoint(eager=True)
    while shift > 0:
        size = wanted.agg(F.max("cnt"), F.count(F.lit(1))).first()
        if not size[1]:
            break
        deeper = 0 if size[0] <= FEW_ROWS else max(0, shift - DIGIT_BITS)
        places = wanted.select(*g, "__at").distinct()
        places = F.broadcast(places) if size[1] <= BROADCAST_ROWS else places
        inside = _same(codes.withColumn("__at", F.shiftright("__code", shift)), places, [*g, "__at"], "left_semi")
        counts = inside.groupBy(*g, "__at", F.shiftright("__code", deeper).alias("__next")).agg(F.count(F.lit(1)).alias("__cnt"))
        running = _over(g, "__at").orderBy("__next").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__start", F.coalesce(F.sum("__cnt").over(running), F.lit(0)))
        found = _same(counts, F.broadcast(wanted) if size[1] <= BROADCAST_ROWS else wanted, [*g, "__at"], "inner")
        found = found.where((F.col("r") >= F.col("__start")) & (F.col("r") < F.col("__start") + F.col("__cnt")))
        wanted = found.select(*g, "prob", "h", "side", F.col("__next").alias("__at"), (F.col("r") - F.col("__start")).alias("r"), F.col("__cnt").alias("cnt")).checkpoint(eager=True)
        shift = deeper
    v = code_value(F.col("__at"))
    agg = wanted.groupBy(*g, "prob", "h").agg(F.max(F.when(F.col("side") == 0, v)).alias("__xl"), F.max(F.when(F.col("side") == 1, v)).alias("__xh"))
    frac = F.col("h") - F.floor("h")
    between = F.when(F.col("__xl") == F.col("__xh"), F.col("__xl")).otherwise(F.col("__xl") + (F.col("__xh") - F.col("__xl")) * frac)
    return agg.select(*g, "prob", between.alias("q"))


def distinct_value_ranks(df: DataFrame, value: str, groups: Sequence[str] = (), part_values: int = PART_VALUES) -> DataFrame:
    """One row per (groups, distinct non-null value): ``cnt`` rows with that value, ``start`` = rows of
    the group with a smaller value, ``n`` = rows of the group (null and NaN values left out). The
    number of sorted partitions follows the number of distinct values."""
    ensure_checkpoint_dir(df.sparkSession)
    spark = df.sparkSession
    g = list(groups)
    counts = _known_values(df, value, g).groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("cnt")).checkpoint(eager=True)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts.count() // part_values))
    ordered = counts.repartitionByRange(parts, *g, "__v").sortWithinPartitions(*g, "__v").withColumn("__part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for b in batches:
            cnt = b.column("cnt").to_numpy()
            ends = done + np.cumsum(cnt)
            done = int(ends[-1]) if len(ends) else done
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends - cnt, pa.int64())], names=[*b.schema.names, "__in"])

    placed = ordered.mapInArrow(run, T.StructType([*ordered.schema.fields, T.StructField("__in", T.LongType())])).checkpoint(eager=True)
    # a row for each group in each partition that has it
    sums = placed.groupBy(*g, "__part").agg(F.min("__in").alias("__from"), F.sum("cnt").alias("__sum"))
    before = _over(g).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*g, "__part", "__from", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"), F.sum("__sum").over(_over(g)).alias("n")).checkpoint(eager=True)
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    out = _same(placed, sums, [*g, "__part"], "inner")
    return out.select(*g, F.col("__v").alias(value), "cnt", (F.col("__before") + F.col("__in") - F.col("__from")).alias("start"), "n")


def order_statistics(df: DataFrame, value: str, groups: Sequence[str] = (), part_values: int = PART_VALUES,
                     chunk: int = 100_000) -> DataFrame:
    """Every non-null value with its 1-based rank within its group (ties get
    consecutive ranks), plus ``n``. A value repeated ``cnt`` times is
    expanded in chunks of at most ``chunk`` rows; chunks are spread by a
    repartition before the final expansion, so a hot value is generated by
    many tasks."""
    g = list(groups)
    dv = distinct_value_ranks(df, value, g, part_values)
    nchunks = F.ceil(F.col("cnt") / F.lit(chunk)).cast("long")
    ch = dv.withColumn("__c", F.explode(F.sequence(F.lit(0).cast("long"), nchunks - 1)))
    ch = ch.repartition(*g, value, "__c")
    lo = F.col("start") + F.col("__c") * chunk + 1
    hi = F.least(F.col("start") + (F.col("__c") + 1) * chunk, F.col("start") + F.col("cnt"))
    return ch.select(*g, value, "n", F.explode(F.sequence(lo, hi)).alias("rank"))
