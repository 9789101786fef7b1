"""Mixing sources to target weights as a time-varying curriculum.

Each source has a weight schedule over training time ``t`` in [0, 1]: linear from ``1 - tilt`` to
``1 + tilt`` times its mean weight. Integrated, it gives the words the source has to deliver up to
time ``t``; the inverse of that cumulative demand assigns every document copy its place in
training, and a range sort by place lays the mix out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domus.llm.common import bucket_count, free_name, stored, words_of

#: The query's weights, dealt to the sources in code point order, and the most often a source repeats.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    size: int
    target: float
    tilt: float


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, repeats: int = MAX_REPEATS) -> list[float]:
    """Words to take of each source: shares by weight of all words, none above ``repeats`` times
    the source's size, the excess reshared by weight until none is above.

    Filling by rising ``repeats * size / weight`` settles it at once: the capped sources are a
    prefix of that order, the rest share what is left in proportion to their weights."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total = sum(n for _, n in sizes)
    order = sorted(range(len(sizes)), key=lambda i: (repeats * sizes[i][1] / w[i], i))
    left, share, out = total, sum(w), [0.0] * len(sizes)
    level = 0.0
    for k, i in enumerate(order):
        level = left / share
        if repeats * sizes[i][1] > level * w[i]:
            break
        out[i] = float(repeats * sizes[i][1])
        left -= repeats * sizes[i][1]
        share -= w[i]
    else:
        k = len(order)
    for i in order[k:]:
        out[i] = level * w[i]
    return out


def plan_sources(groups: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS) -> list[SourcePlan]:
    """Sizes and targets of the sources, from groups of equal rows (m_source, m_size, n). One row for each source goes to the driver: it is the mixture's configuration, as long as
    the list of sources and independent of the number of documents."""
    rows = groups.groupBy("m_source").agg(F.sum(F.col("m_size") * F.col("n")).alias("words")).collect()
    ordered = sorted(((r["m_source"], int(r["words"])) for r in rows), key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be")))
    tilts = [(-1) ** i * 0.5 for i in range(len(ordered))]  # early sources fade out as late ones come in
    return [SourcePlan(s, n, t, z) for (s, n), t, z in zip(ordered, targets(ordered, weights, repeats), tilts, strict=True)]


def place_in_training(done, target, tilt):
    """Invert the cumulative demand ``target * ((1 - tilt) t + tilt t^2)`` at ``done`` words."""
    x = F.least(F.lit(1.0), done / F.greatest(target, F.lit(1.0)))
    a = F.lit(1.0) - tilt
    return F.when(tilt == 0, x).otherwise((-a + F.sqrt(a * a + F.lit(4.0) * tilt * x)) / (F.lit(2.0) * tilt))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
        weights=WEIGHTS, repeats: int = MAX_REPEATS, keep: bool = False) -> DataFrame:
    """Words the mix takes of every document.

    Result: doc_id, size, source_size, target, taken, start (words of the source before the
    document in its order), first_place (training time of its first copy; null if none is taken)
    and tilt (of the source's schedule). With ``keep=True`` the input's columns come first and
    these follow under free names.

    The documents of a source stand in the order of md5(doc_id), doc_id, size; the mix goes through
    them again and again until ``floor(target)`` words are taken, so the last document may be taken
    in part. Rows equal in source, id and size share what their group takes evenly, the odd words
    going to some of them (with ``keep=True`` to none). Null text: size 0, taken 0. A null source is
    a source of its own, sorted last. No words at all: all targets 0. Empty table: empty result.
    Columns with clashing names are kept as they are.

    Running sums: equal rows are counted first, then groups are hashed into buckets of about
    ``ROWS_PER_BUCKET`` (a source of any size spreads over many), summed inside buckets and over
    the bucket totals."""
    spark = docs.sparkSession
    ident = [F.col(key).alias("m_id"), F.col(source).alias("m_source"), F.size(words_of(F.col(text))).cast("long").alias("m_size")]
    rows = docs.select(*ident)
    groups = stored(rows.groupBy("m_id", "m_source", "m_size").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("rank", F.md5(F.coalesce(F.col("m_id").cast("string"), F.lit("")))), "mix-sizes")
    plan = plan_sources(groups, weights, repeats)
    digits = max(1, math.ceil(math.log(max(groups.count() / ROWS_PER_BUCKET, 2), 16)))
    groups = groups.withColumn("bucket", F.substring("rank", 1, digits)).withColumn("words", F.col("m_size") * F.col("n"))
    before = Window.partitionBy("m_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (groups.groupBy("m_source", "bucket").agg(F.sum("words").alias("in_bucket"))
               .select(F.col("m_source").alias("o_source"), F.col("bucket").alias("o_bucket"),
                       F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset")))
    inner = Window.partitionBy("m_source", "bucket").orderBy("rank", "m_id", "m_size").rowsBetween(Window.unboundedPreceding, -1)
    table = spark.createDataFrame([(p.source, p.size, p.target, p.tilt) for p in plan],
                                  "p_source string, source_size long, target double, tilt double")
    goal, start, size, n = F.floor("target"), F.col("start"), F.col("m_size"), F.col("n")
    group_taken = sum((F.greatest(F.lit(0), F.least(F.col("words"), goal - start - F.lit(e) * F.col("source_size")))
                       for e in range(repeats)), F.lit(0).cast("long"))
    placed = (groups.withColumn("within", F.coalesce(F.sum("words").over(inner), F.lit(0)))
              .join(offsets, F.col("m_source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
              .join(F.broadcast(table), F.col("m_source").eqNullSafe(F.col("p_source")))  # a row for each source
              .withColumn("start", F.col("offset") + F.col("within"))
              .withColumn("group_taken", group_taken.cast("long")))
    even, odd = F.expr("group_taken div n"), F.col("group_taken") % n
    names = ("size", "source_size", "target", "taken", "start", "first_place", "tilt")
    if not keep:
        each = placed.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
        return each.select(F.col("m_id").alias(key), *_result(even + F.when(F.col("k") < odd, 1).otherwise(0),
                                                              start + F.col("k") * size, names, names))
    own = [F.col(c).alias(f"in_{i}") for i, c in enumerate(docs.columns)]
    placed = placed.select(*[F.col(c).alias(f"g_{c}") if c.startswith("m_") else F.col(c) for c in placed.columns])
    joined = docs.select(*own, *ident).join(
        placed, F.col("m_id").eqNullSafe(F.col("g_m_id")) & F.col("m_source").eqNullSafe(F.col("g_m_source"))
        & (F.col("m_size") == F.col("g_m_size")))
    free = [free_name(docs, c) for c in names]
    return joined.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)], *_result(even, start, names, free))


def _result(taken, start, names, aliases) -> list:
    place = F.when(taken > 0, place_in_training(start.cast("double"), F.col("target"), F.col("tilt")))
    values = {"size": F.col("m_size"), "source_size": F.col("source_size"), "target": F.col("target"),
              "taken": taken.cast("long"), "start": start, "first_place": place, "tilt": F.col("tilt")}
    return [values[c].alias(a) for c, a in zip(names, aliases, strict=True)]


def lay_out(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
            weights=WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The mix itself: the rows of ``docs``, one for each copy taken, range-sorted by training place.

    A document is never cut: the copy in which the source's target falls is laid out if at least
    half of it is taken. Documents without words are left out. Empty table: empty result."""
    mixed = mix(docs, key, text, source, weights=weights, repeats=repeats, keep=True)
    size, whole, target, taken, start, _, tilt = (F.col(f"`{c}`") for c in mixed.columns[len(docs.columns):])
    copies = F.when(size > 0, F.floor((taken * 2 + size) / (size * 2))).otherwise(F.lit(0)).cast("int")
    copy, place = free_name(mixed, "copy"), free_name(mixed, "place")
    each = mixed.where(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), copies - 1)))
    placed = each.withColumn(place, place_in_training((start + F.col(copy) * whole).cast("double"), target, tilt))
    return placed.orderBy(place, key).select(*docs.columns)
