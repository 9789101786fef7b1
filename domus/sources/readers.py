"""Sources (A1–A7). Schemas are declared; inference is an explicit option
because it costs a full extra pass over the input."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cold-start schema of the property table.
COLD_START_SCHEMA = "propertyDetails_propertyId string, propertyDetails_normalizedPrice bigint"


def read_json_drops(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
                    partitions: int | None = None, corrupt_col: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read gz (or plain) JSON drops: a top-level array becomes one row per
    element, JSON lines one row per line (A1). ``multi_line`` reads each file
    as one document (or array of documents), as pretty-printed drops need.

    gz is not splittable, so a big drop is one task: pass ``partitions`` to
    spread the rows after the read. ``PERMISSIVE`` keeps malformed records in
    ``corrupt_col`` when given (it must be in the schema)."""
    r = spark.read.option("mode", "PERMISSIVE").option("multiLine", multi_line)
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path if isinstance(path, str) else list(path))
    return df.repartition(partitions) if partitions else df


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
                   header: bool = True, malformed: str = "drop") -> DataFrame:
    """Delimited text with a header (A2). Every row is parsed against the
    whole schema, so which rows are malformed does not depend on the columns
    a query selects: ``malformed="drop"`` leaves them out, ``"only"`` returns
    their text (column ``malformed``), ``"keep"`` has both."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*st.fields, T.StructField("malformed", T.StringType())])
    df = (spark.read.schema(full).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "malformed").option("enableColumnPruning", False)
          .csv(path))
    # a query that asks for the record column alone is refused, so each condition also reads the
    # fields (their hash is never below the least integer)
    read = F.hash(*[F.col(f"`{f.name}`") for f in st.fields]) >= F.lit(-2147483648)
    if malformed == "only":
        return df.where(read & F.col("malformed").isNotNull()).select("malformed")
    if malformed == "keep":
        return df.where(read)
    return df.where(read & F.col("malformed").isNull()).drop("malformed")


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files or a folder of them (A3)."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def read_table_or_empty(spark: SparkSession, path: str,
                        cold_start_schema: str = COLD_START_SCHEMA) -> DataFrame:
    """Current snapshot of a table folder, or an empty frame with the
    cold-start schema when nothing was written yet (A4). Versioned tables
    written by :func:`domus.sinks.writers.write_version` resolve to their
    latest committed version. Stays lazy."""
    from domus.sinks.writers import latest_version_path
    p = latest_version_path(spark, path) or path
    try:
        return spark.read.parquet(p)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], cold_start_schema)
        raise


def sub_document(df: DataFrame, field: str) -> DataFrame:
    """Take one sub-document out of each row (``item.propertyDetails``) as
    the row (A5); flatten with :func:`domus.operators.columns.flatten_structs`."""
    return df.select(F.col(field + ".*"))


def object_of_records(df: DataFrame, text_col: str, record_schema: str, key_name: str = "id") -> DataFrame:
    """A JSON object of objects (id → record) in a text column → one row per
    key with the record's fields as columns (A6)."""
    m = F.from_json(F.col(text_col), f"map<string, {record_schema}>")
    return df.select(F.explode(m).alias(key_name, "__r")).select(key_name, "__r.*")


def read_object_of_records(spark: SparkSession, path: str, record_schema: str,
                           key_name: str = "id") -> DataFrame:
    """Files each holding one JSON object of objects (A6); each file is read
    whole (``wholetext``), so one file is one task."""
    raw = spark.read.text(path, wholetext=True)
    return object_of_records(raw, "value", record_schema, key_name)


def _ddl(variant_schema: str) -> str:
    """The schema of a variant as a column type: numbers with a point are doubles, what has no one
    type (or only nulls) is text."""
    text = re.sub(r"\bOBJECT<", "STRUCT<", variant_schema)
    text = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", text)
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", text).replace("STRUCT<>", "STRING")


def typed_json(df: DataFrame, text_col: str) -> DataFrame:
    """JSON documents without a declared schema (A1): one aggregate finds the schema of all documents
    (fields of any document, types that hold all values), then each is read by it. Texts that are no
    JSON object are left out; a document without a field has null there. No documents: no columns."""
    docs = df.select(F.try_parse_json(F.col(text_col)).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = docs.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found.startswith("OBJECT<"):
        return df.sparkSession.createDataFrame([], T.StructType([]))
    return docs.select(F.try_variant_get("v", "$", _ddl(found)).alias("r")).select("r.*")


def typed_object_of_records(df: DataFrame, text_col: str, key_name: str = "id") -> DataFrame:
    """JSON objects of records (A6) with any number of keys and no declared schema: one row a key, the
    records' fields as columns by the schema that one aggregate finds."""
    docs = df.select(F.try_parse_json(F.col(text_col)).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    rows = docs.select(F.explode(F.col("v").cast("map<string, variant>")).alias(key_name, "v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = rows.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found.startswith("OBJECT<"):
        return df.sparkSession.createDataFrame([], f"`{key_name}` string")
    return rows.select(key_name, F.try_variant_get("v", "$", _ddl(found)).alias("r")).select(key_name, "r.*")


def records(spark: SparkSession, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """In-line records with a fixed column order; missing keys are null."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = [f.name for f in st.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], st)
