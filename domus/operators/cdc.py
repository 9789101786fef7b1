"""Change detection and upsert.

* :func:`changed_or_new` — E1 with the E6 semi-join reduction.
* :func:`skip_landed` — E5.
* :func:`dedupe_latest` — one row per key, the latest by an ordering.
* :func:`upsert` — B7, MERGE semantics (update all / insert all) without a
  MERGE-capable table format: anti join + union, or a full outer join when the
  source lacks some target columns.

All of it is declarative; Spark/AQE picks broadcast vs sort-merge joins from
runtime sizes, so nothing is broadcast on a guess."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.functions.scalar import fingerprint
from domus.session import ensure_checkpoint_dir


def with_fingerprint(df: DataFrame, key: str, price: str, out: str = "fingerprint",
                     sep: str = "-") -> DataFrame:
    return df.withColumn(out, fingerprint(key, price, sep))


def changed_or_new(incoming: DataFrame, existing: DataFrame, key: str, price: str,
                   existing_key: str | None = None, existing_price: str | None = None,
                   sep: str = "-", fingerprint_col: str = "fingerprint", latest_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``incoming`` whose key is new or whose fingerprint differs.

    The stored table may repeat keys. With ``latest_by`` (columns of ``existing``) only the latest
    stored row of a key counts, so a price that returns to an older value is a change. Without an
    order an incoming row is unchanged only if *all* stored rows of its key have its fingerprint.
    A null price, stored or incoming, always counts as changed.

    ``existing`` is reduced to the incoming keys (E6, ``left_semi``) and to one row a key by a
    partial aggregate (a key holding a third of the table is combined map-side); the result is one
    anti join on (key, fingerprint)."""
    ek = existing_key or key
    ep = existing_price or price
    inc = incoming if fingerprint_col in incoming.columns else with_fingerprint(
        incoming, key, price, fingerprint_col, sep)
    keys = inc.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull())
    efp = fingerprint(ek, ep, sep)
    ex = existing.select(F.col(ek).alias("__k"), efp.alias("__efp"), F.struct(*latest_by, efp).alias("__at"))
    ex = ex.join(keys, "__k", "left_semi")
    if latest_by:
        one = F.max_by(F.struct("__efp"), "__at")["__efp"]
    else:
        one = F.when((F.min("__efp") == F.max("__efp")) & (F.count_if(F.col("__efp").isNull()) == 0), F.min("__efp"))
    same = ex.groupBy("__k").agg(one.alias("__efp"))
    return inc.join(same, (inc[key] == same["__k"]) & (inc[fingerprint_col] == same["__efp"]), "left_anti")


def changed_or_new_unique(incoming: DataFrame, existing: DataFrame, key: str, price: str,
                          sep: str = "-", fingerprint_col: str = "fingerprint") -> DataFrame:
    """Same as :func:`changed_or_new` when ``existing`` is unique by key (a
    table that is only ever written through :func:`upsert`): a single left
    join (which also reduces the stored side to the incoming keys, E6), no
    aggregation."""
    inc = incoming if fingerprint_col in incoming.columns else with_fingerprint(
        incoming, key, price, fingerprint_col, sep)
    ex = existing.select(F.col(key).alias("__k"), fingerprint(key, price, sep).alias("__efp"))
    j = inc.join(ex, inc[key] == ex["__k"], "left")
    keep = (F.col("__k").isNull() | F.col("__efp").isNull()
            | (F.col("__efp") != F.col(fingerprint_col)) | F.col(fingerprint_col).isNull())
    return j.where(keep).drop("__k", "__efp")


def skip_landed(incoming: DataFrame, landed: DataFrame, key: str,
                landed_key: str | None = None) -> DataFrame:
    """Incoming rows whose key was not landed before (E5)."""
    lk = landed_key or key
    return incoming.join(landed.select(F.col(lk).alias(key)), key, "left_anti")


def dedupe_latest(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple, ties
    broken by the remaining columns (deterministic). Rows with a null key
    match nothing, so each of them stays.

    ``max_by`` over a struct is a partial aggregate, so a key holding a third
    of all rows is combined map-side and never gathered into one task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    order_struct = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest])
    agg = df.where(~null_key).groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order_struct).alias("__r"))
    one = agg.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])
    return one.unionByName(df.where(null_key))


def _present(df: DataFrame, name: str) -> bool:
    return name in df.columns


def prepare_source(source: DataFrame, key: str, dedupe: str = "error", order_by: Sequence[str] = ()) -> DataFrame:
    """Apply the repeated-key rule of :func:`upsert` to a source frame."""
    if dedupe == "latest":
        return dedupe_latest(source, key, order_by)
    if dedupe == "error":
        dup = source.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).collect()
        if dup:
            raise ValueError(f"upsert: repeated key in source: {dup[0][0]!r}")
        return source
    if dedupe != "none":
        raise ValueError(f"dedupe must be error|latest|none, not {dedupe!r}")
    return source


def upsert(target: DataFrame, source: DataFrame, key: str, dedupe: str = "error",
           order_by: Sequence[str] = (), materialize: bool = False) -> DataFrame:
    """MERGE on ``key``: matched → update all, not matched → insert all.

    * null keys never match (equality join), so they are inserted;
    * columns only in the source are added (schema evolution); rows that
      were not matched get null for them;
    * columns only in the target keep the target's value for matched rows;
    * repeated source keys: ``dedupe='error'`` checks with one partial
      aggregate (an action, at most one row comes back) and raises;
      ``'latest'`` keeps the greatest ``order_by`` row; ``'none'`` trusts the
      caller;
    * ``materialize=True`` checkpoints the prepared source once (for eager
      writers), instead of evaluating it for the keys and again for the rows.

    When the source has every target column the plan is one anti join and a
    union (the source is never joined to its own payload). Otherwise it is one
    full outer join, with every column taken by *presence*, not by null."""
    source = prepare_source(source, key, dedupe, order_by)
    if materialize:
        # the source feeds both the anti join (keys) and the union (rows):
        # compute it once, into the shared checkpoint folder (eager)
        ensure_checkpoint_dir(source.sparkSession)
        source = source.checkpoint(eager=True)
    missing_in_source = [c for c in target.columns if not _present(source, c)]
    if not missing_in_source:
        kept = target.join(source.select(key).where(F.col(key).isNotNull()), key, "left_anti")
        return kept.unionByName(source, allowMissingColumns=True)

    t = target.select(*[F.col(c).alias("__t_" + c) for c in target.columns])
    s = source.select(*[F.col(c).alias("__s_" + c) for c in source.columns]).withColumn("__s_hit", F.lit(True))
    j = t.join(s, t["__t_" + key] == s["__s_" + key], "full_outer")
    hit = F.col("__s_hit").isNotNull()
    out: list[Column] = []
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    for c in cols:
        if _present(source, c) and _present(target, c):
            out.append(F.when(hit, F.col("__s_" + c)).otherwise(F.col("__t_" + c)).alias(c))
        elif _present(source, c):
            out.append(F.col("__s_" + c).alias(c))
        else:
            out.append(F.col("__t_" + c).alias(c))
    return j.select(*out)
