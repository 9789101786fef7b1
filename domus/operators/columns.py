"""Projection, column and schema operators (C1–C17, J1/J2 dummies).

Each is a plan-time rewrite of the projection list: the driver only looks at
the schema, the data never leaves the executors. Operators that need the
data to choose columns (fill with mean, parse-if-all-parse, dummies) run one
aggregate whose result is one row of bounded width."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that Parquet column names may not hold.
PARQUET_SPECIAL_CHARACTERS = r"[ ,;{}()\n\t=]"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _check_unique(names: Sequence[str]) -> None:
    seen: dict[str, int] = {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
    dup = sorted(n for n, k in seen.items() if k > 1)
    if dup:
        raise ValueError(f"column name collision: {dup}")


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out: list[tuple[tuple[str, ...], T.DataType]] = []
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType):
            out.extend(leaf_paths(f.dataType, path))
        else:
            out.append((path, f.dataType))
    return out


def flatten_structs(df: DataFrame, sep: str = "_", drop: Iterable[str] = ()) -> DataFrame:
    """Every struct leaf becomes a column ``a_b_c``; arrays stay one cell and
    rows are never multiplied (C1, C4, C5).

    Built as a *single* projection, so Catalyst prunes the leaves a later
    step does not use (down to the Parquet scan for nested columns). An empty
    struct gives no column, a null struct gives null leaves. Two paths that
    map to one name raise. ``drop`` names (after naming) are removed."""
    drop_set = set(drop)
    cols, names = [], []
    for path, _ in leaf_paths(df.schema):
        name = sep.join(path)
        if name in drop_set:
            continue
        cols.append(F.col(".".join(_q(p) for p in path)).alias(name))
        names.append(name)
    _check_unique(names)
    return df.select(*cols)


def flatten_explode(df: DataFrame, explode: Sequence[str] | None = None, sep: str = "_",
                    prefix: str | None = None) -> DataFrame:
    """Flatten structs and turn array columns into rows, repeating until no
    struct (and no chosen array) is left (C2).

    ``explode=None`` explodes every array (the cross product of all arrays
    of a row, as the notebook form does); otherwise only arrays whose
    flattened name is listed (or starts with a listed name) are exploded and
    the others stay as one cell. ``explode_outer`` keeps a row for an empty
    or null array. One ``Generate`` per array; structs are one projection.
    ``prefix`` keeps only the top-level columns whose name starts with it
    (the notebook form flattens the ``propertyDetails`` sub-document)."""
    if prefix is not None:
        df = df.select(*[_q(c) for c in df.columns if c.startswith(prefix)])
    def wanted(name: str) -> bool:
        if explode is None:
            return True
        return any(name == e or name.startswith(e + sep) for e in explode)

    while True:  # a schema is finite, so each round removes a level
        df = flatten_structs(df, sep=sep)
        arrays = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, T.ArrayType) and wanted(f.name)]
        if not arrays:
            return df
        for a in arrays:
            df = df.withColumn(a, F.explode_outer(F.col(_q(a))))
        if not any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
            more = [f.name for f in df.schema.fields
                    if isinstance(f.dataType, T.ArrayType) and wanted(f.name)]
            if not more:
                return df


def clean_names(df: DataFrame, pattern: str = PARQUET_SPECIAL_CHARACTERS) -> DataFrame:
    """Remove characters Parquet rejects from every name (C3); raise on a
    collision instead of silently overwriting."""
    names = [re.sub(pattern, "", c) for c in df.columns]
    _check_unique(names)
    return df.toDF(*names)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case all names."""
    names = [c.lower() for c in df.columns]
    _check_unique(names)
    return df.toDF(*names)


def prefix_names(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix all names."""
    return df.toDF(*[prefix + c for c in df.columns])


def rename(df: DataFrame, how: Callable[[str], str] | Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rename by function, by map or by position."""
    if callable(how):
        names = [how(c) for c in df.columns]
    elif isinstance(how, Mapping):
        names = [how.get(c, c) for c in df.columns]
    else:
        names = list(how)
        if len(names) != len(df.columns):
            raise ValueError("rename by position needs one name per column")
    _check_unique(names)
    return df.toDF(*names)


_TYPE_GROUPS = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "number": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "bool": (T.BooleanType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def select_by_type(df: DataFrame, kinds: str | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep columns whose type is in the named groups (C10), plus ``keep``
    (C9 is a plain ``select``)."""
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    types = tuple(t for k in kinds for t in _TYPE_GROUPS[k])
    cols = [f.name for f in df.schema.fields if f.name in keep or isinstance(f.dataType, types)]
    return df.select(*[_q(c) for c in cols])


def enrich(df: DataFrame, struct_name: str, fields: Mapping[str, Column]) -> DataFrame:
    """Set fields of a nested struct, creating the struct when it is absent
    or null (C11)."""
    if struct_name in df.columns:
        cur = F.col(_q(struct_name))
        st = df.schema[struct_name].dataType
        empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
        base = F.when(cur.isNull(), empty).otherwise(cur)
    else:
        base = F.struct()
    for name, value in fields.items():
        base = base.withField(name, value)
    return df.withColumn(struct_name, base)


def replace_values(df: DataFrame, old, new, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace values."""
    return df.na.replace(old, new, subset=list(subset) if subset else None)


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas counts NaN as missing; Spark keeps it apart from null."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(_q(f.name)), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(_q(f.name)))
    return df.select(*out)


def fill_constant(df: DataFrame, number=0, text: str | None = "None",
                  subset: Sequence[str] | None = None) -> DataFrame:
    """Fill missing numbers with ``number`` and missing text with ``text``
    (C13); NaN counts as missing."""
    df = nan_to_null(df)
    if number is not None:
        df = df.na.fill(number, subset=list(subset) if subset else None)
    if text is not None:
        df = df.na.fill(text, subset=list(subset) if subset else None)
    return df


def _numeric_fields(df: DataFrame, subset: Sequence[str] | None = None) -> list[T.StructField]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f for f in df.schema.fields
            if isinstance(f.dataType, num) and (subset is None or f.name in subset)]


def fill_mean(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill missing numbers with the column mean (C14).

    One aggregate computes every mean (partial aggregation, one row comes
    back — its width is the column count, not the row count); the means are
    then literals in a single projection. Like pandas, an integer column
    filled with a fractional mean becomes double."""
    fields = _numeric_fields(df, subset)
    if not fields:
        return df
    clean = nan_to_null(df)
    means = clean.agg(*[F.avg(F.col(_q(f.name))).alias(f.name) for f in fields]).first().asDict()
    out = []
    for f in clean.schema.fields:
        if f.name in means and means[f.name] is not None:
            out.append(F.coalesce(F.col(_q(f.name)).cast("double"), F.lit(float(means[f.name]))).alias(f.name))
        else:
            out.append(F.col(_q(f.name)))
    return clean.select(*out)


#: What counts as a number in text: no suffixes (``12d``), no words.
NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
WHOLE = r"^[+-]?[0-9]+$"


def numeric_if_all_parse(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Turn a text column into numbers only if every non-null value parses
    (C15): bigint when every value is a whole number, double otherwise; a
    column with any unparsable value is left as it is.

    One aggregate of two ``count_if`` per text column decides; the answer is
    one row."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
             and (subset is None or f.name in subset)]
    if not texts:
        return df
    aggs = []
    for c in texts:
        s = F.trim(F.col(_q(c)))
        number, whole = s.rlike(NUMBER), s.rlike(WHOLE) & s.try_cast("bigint").isNotNull()
        aggs.append(F.count_if(s.isNotNull() & ~number).alias(c + "\u0001bad"))
        aggs.append(F.count_if(s.isNotNull() & ~whole).alias(c + "\u0001frac"))
    r = df.agg(*aggs).first().asDict()
    out = []
    for f in df.schema.fields:
        c = f.name
        if c in texts and r[c + "\u0001bad"] == 0:
            t = "bigint" if r[c + "\u0001frac"] == 0 else "double"
            out.append(F.trim(F.col(_q(c))).try_cast(t).alias(c))
        else:
            out.append(F.col(_q(c)))
    return df.select(*out)


def dummy_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Dummies of any cardinality as long rows (key, column_name, value), one
    for each non-null cell: what :func:`dummies` would mark with a 1."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(_q(c)).alias("value")) for c in columns]))
    return df.select(key, cells.alias("__c")).select(key, "__c.*").where(F.col("value").isNotNull())


def dummy_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Distinct values of each text column, sorted (one distinct over the
    stacked columns). They become column names, so they have to fit a schema;
    for columns of unbounded cardinality use :func:`dummy_long`."""
    if not columns:
        return {}
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(_q(c)).alias("v")) for c in columns])).alias("p"))
    out: dict[str, list[str]] = {c: [] for c in columns}
    for c, v in pairs.select("p.*").where(F.col("v").isNotNull()).distinct().orderBy("c", "v").collect():
        out[c].append(v)
    return out


def dummies(df: DataFrame, columns: Sequence[str] | None = None,
            values: Mapping[str, Sequence[str]] | None = None,
            drop: Mapping[str, str] | None = None, sep: str = "_") -> DataFrame:
    """Indicator columns ``col_value`` for text columns.

    ``columns=None`` takes every text column (``get_dummies``). A null value
    gives all zeros. ``values`` reuses a value list learnt elsewhere (learn
    on train, apply to test); ``drop`` names a baseline value per column that
    gets no column. The source text columns are replaced, others kept."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    columns = list(columns)
    vals = dict(values) if values is not None else dummy_values(df, columns)
    drop = dict(drop or {})
    out: list[Column] = []
    for f in df.schema.fields:
        if f.name not in columns:
            out.append(F.col(_q(f.name)))
            continue
        for v in vals[f.name]:
            if drop.get(f.name) == v:
                continue
            out.append(F.when(F.col(_q(f.name)) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
                       .cast("int").alias(f"{f.name}{sep}{v}"))
    return df.select(*out)
