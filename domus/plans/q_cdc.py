"""Change detection, upsert and streaming ingest on ``orders``.

Scenario (whole table, split by date like two runs of the job): the stored
property table is the orders placed before 1999; the incoming run sees the
orders placed from 1998 on, with the price of urgent orders raised by 1000.
So 1998 orders are re-seen (changed or not) and 1999+ orders are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.operators.cdc import changed_or_new, changed_or_new_unique, skip_landed, upsert
from domus.plans.registry import load, query
from domus.session import scratch_path
from domus.sinks.writers import read_bucketed, upsert_table, write_bucketed, write_json_drops, write_version
from domus.sources.readers import COLD_START_SCHEMA, read_table_or_empty
from domus.streaming.ingest import ingest_drops

STORED_BEFORE = "1999-01-01 00:00:00"
INCOMING_FROM = "1998-01-01 00:00:00"
COLS = ["o_orderkey", "price", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def ts(text: str):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.where(F.col("o_orderdate") < ts(STORED_BEFORE)).select(
        "o_orderkey", F.round("o_totalprice").cast("bigint").alias("price"),
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


def incoming_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    bump = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1000)).otherwise(F.lit(0))
    return o.where(F.col("o_orderdate") >= ts(INCOMING_FROM)).select(
        "o_orderkey", (F.round("o_totalprice").cast("bigint") + bump).alias("price"),
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


SQL_SCENARIO = """
stored AS (
  SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price, o_custkey, o_orderstatus,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
incoming AS (
  SELECT o_orderkey,
         CAST(round(o_totalprice) AS BIGINT) + CASE WHEN o_orderpriority = '1-URGENT' THEN 1000 ELSE 0 END AS price,
         o_custkey, o_orderstatus, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
inc AS (
  SELECT *, CAST(o_orderkey AS VARCHAR) || '-' || CAST(price AS VARCHAR) AS fingerprint FROM incoming),
ex AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '-' || CAST(price AS VARCHAR) AS efp
  FROM stored WHERE o_orderkey IN (SELECT o_orderkey FROM inc)),
changed AS (
  SELECT inc.* FROM inc LEFT JOIN ex ON inc.o_orderkey = ex.o_orderkey
  WHERE ex.o_orderkey IS NULL OR ex.efp IS NULL OR inc.fingerprint IS NULL OR ex.efp <> inc.fingerprint)
"""


@query("cdc_changed_or_new", ids="I1 E6 E1 D1", bench=True, sql="WITH " + SQL_SCENARIO + """
SELECT o_orderkey, price, fingerprint FROM changed""")
def cdc_changed_or_new(spark, sf):
    ch = changed_or_new(incoming_orders(spark, sf), stored_orders(spark, sf), "o_orderkey", "price")
    return ch.select("o_orderkey", "price", "fingerprint")


@query("cdc_changed_or_new_sql", ids="L1 I1 E1", sql="WITH " + SQL_SCENARIO + """
SELECT o_orderkey, price, fingerprint FROM changed""")
def cdc_changed_or_new_sql(spark, sf):
    """The same change set written as Spark SQL over named frames (L1)."""
    return spark.sql("""
        WITH inc AS (SELECT o_orderkey, price,
                            CAST(o_orderkey AS STRING) || '-' || CAST(price AS STRING) AS fingerprint
                     FROM {incoming}),
             ex AS (SELECT o_orderkey, CAST(o_orderkey AS STRING) || '-' || CAST(price AS STRING) AS efp
                    FROM {stored} s WHERE EXISTS (SELECT 1 FROM inc WHERE inc.o_orderkey = s.o_orderkey))
        SELECT inc.o_orderkey, inc.price, inc.fingerprint
        FROM inc LEFT JOIN ex ON inc.o_orderkey = ex.o_orderkey
        WHERE ex.efp IS NULL OR inc.fingerprint IS NULL OR ex.efp <> inc.fingerprint""",
                     incoming=incoming_orders(spark, sf), stored=stored_orders(spark, sf))


UPSERT_SQL = "WITH " + SQL_SCENARIO + """
SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.o_orderkey = s.o_orderkey)
UNION ALL
SELECT o_orderkey, price, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM changed"""


@query("cdc_upsert", ids="B7 E1", bench=True, sql=UPSERT_SQL)
def cdc_upsert(spark, sf):
    stored = stored_orders(spark, sf)
    ch = changed_or_new_unique(incoming_orders(spark, sf), stored, "o_orderkey", "price").drop("fingerprint")
    return upsert(stored, ch, "o_orderkey", dedupe="none").select(*COLS)


@query("cdc_upsert_evolve", ids="B7 H1", sql="WITH " + SQL_SCENARIO + """,
src AS (SELECT o_orderkey, price, o_custkey, o_orderdate, o_orderpriority,
               'r' || CAST(o_orderkey % 3 AS VARCHAR) AS revision, true AS hit FROM changed)
SELECT CASE WHEN s.hit THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s.hit THEN s.price ELSE t.price END AS price,
       CASE WHEN s.hit THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       t.o_orderstatus AS o_orderstatus,
       CASE WHEN s.hit THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.hit THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       s.revision AS revision
FROM stored t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey""")
def cdc_upsert_evolve(spark, sf):
    """The source gains a column (``revision``) and lacks one
    (``o_orderstatus``): matched rows keep the stored status, new rows get
    null for it, and old rows get a null revision."""
    stored = stored_orders(spark, sf)
    ch = changed_or_new_unique(incoming_orders(spark, sf), stored, "o_orderkey", "price")
    src = ch.select("o_orderkey", "price", "o_custkey", "o_orderdate", "o_orderpriority",
                    F.concat(F.lit("r"), (F.col("o_orderkey") % 3).cast("string")).alias("revision"))
    return upsert(stored, src, "o_orderkey", dedupe="none")


@query("fingerprint_null_price", ids="I1 E1", sql="""
WITH stored AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(round(o_totalprice) AS BIGINT) END AS price
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
incoming AS (
  SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
inc AS (SELECT *, CAST(o_orderkey AS VARCHAR) || '-' || CAST(price AS VARCHAR) AS fingerprint FROM incoming),
ex AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '-' || CAST(price AS VARCHAR) AS efp FROM stored)
SELECT inc.o_orderkey, inc.price, inc.fingerprint FROM inc LEFT JOIN ex ON inc.o_orderkey = ex.o_orderkey
WHERE ex.o_orderkey IS NULL OR ex.efp IS NULL OR ex.efp <> inc.fingerprint""")
def fingerprint_null_price(spark, sf):
    """Stored rows with a null price (every 11th key) have a null
    fingerprint and are always re-emitted; nothing else changed."""
    o = load(spark, sf, "orders")
    stored = o.where(F.col("o_orderdate") < ts(STORED_BEFORE)).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.lit(None))
        .otherwise(F.round("o_totalprice").cast("bigint")).alias("price"))
    inc = o.where(F.col("o_orderdate") >= ts(INCOMING_FROM)).select(
        "o_orderkey", F.round("o_totalprice").cast("bigint").alias("price"))
    return changed_or_new(inc, stored, "o_orderkey", "price").select("o_orderkey", "price", "fingerprint")


@query("skip_landed", ids="E5", sql="""
SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def skip_landed_q(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return skip_landed(docs, load(spark, sf, "labels"), "doc_id")


def _doc_schema() -> str:
    return ("propertyDetails struct<id: bigint, price: bigint>, "
            "order struct<custkey: bigint, status: string, date: timestamp_ntz, priority: string>, "
            "year int")


def _as_docs(df: DataFrame) -> DataFrame:
    return df.select(
        F.struct(F.col("o_orderkey").alias("id"), F.col("price").alias("price")).alias("propertyDetails"),
        F.struct(F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"),
                 F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("priority")).alias("order"),
        F.year("o_orderdate").alias("year"))


def _from_flat(flat: DataFrame) -> DataFrame:
    return flat.select(F.col("propertyDetails_id").alias("o_orderkey"), F.col("propertyDetails_price").alias("price"),
                       F.col("order_custkey").alias("o_custkey"), F.col("order_status").alias("o_orderstatus"),
                       F.col("order_date").alias("o_orderdate"), F.col("order_priority").alias("o_orderpriority"))


@query("stream_upsert", ids="K1 C1 B2 E1 B7", bench=True, sql=UPSERT_SQL)
def stream_upsert(spark, sf):
    """The incoming run lands as gz JSON drops (by order year); a Structured
    Streaming query ingests them (flatten → detect change → upsert). The
    table is split by a hash bucket of the key, and each batch adds a version
    of the buckets it touches. The final table equals the batch
    ``cdc_upsert``."""
    base = scratch_path(spark, "stream_upsert")
    table, landing = f"{base}/table", f"{base}/landing"
    write_bucketed(stored_orders(spark, sf), table, "o_orderkey")
    write_json_drops(_as_docs(incoming_orders(spark, sf)), landing, partition_by=["year"], mode="overwrite")
    ingest_drops(spark, landing, _doc_schema(), table, "o_orderkey", "price", f"{base}/checkpoint", ["o_orderdate"],
                 prepare=_from_flat, files_per_batch=2, bucketed=True)
    return read_bucketed(spark, table).select(*COLS)


@query("stream_restart", ids="K1 B7", sql=UPSERT_SQL)
def stream_restart(spark, sf):
    """The drops arrive in two landing folders, read by two streams with a checkpoint each over the
    same table; the second one starts from nothing and loses nothing, and the first, started again,
    merges nothing twice. Buckets are small, so the table splits as it grows."""
    base = scratch_path(spark, "stream_restart")
    write_bucketed(stored_orders(spark, sf), f"{base}/table", "o_orderkey", 2_000)
    docs = _as_docs(incoming_orders(spark, sf))
    for i in (0, 1):
        write_json_drops(docs.where(F.col("year") % 2 == i), f"{base}/landing{i}", mode="overwrite")
    for i in (0, 1, 0):
        ingest_drops(spark, f"{base}/landing{i}", _doc_schema(), f"{base}/table", "o_orderkey", "price", f"{base}/checkpoint{i}", ["o_orderdate"],
                     prepare=_from_flat, files_per_batch=None, bucketed=True, rows_per_bucket=2_000)
    return read_bucketed(spark, f"{base}/table").select(*COLS)


@query("stream_evolve", ids="B1 B7 K1 A4", sql="""
WITH b AS (SELECT c_custkey AS id, CAST(floor(c_acctbal) AS BIGINT) AS price, c_mktsegment AS segment FROM customer WHERE c_custkey % 3 <> 0),
s AS (SELECT o_custkey AS id, CAST(round(o_totalprice) AS BIGINT) AS price, o_orderstatus AS status, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
d AS (SELECT * FROM s WHERE rn = 1)
SELECT coalesce(d.id, b.id) AS id, coalesce(d.price, b.price) AS price, b.segment, CASE WHEN b.price IS NULL OR d.price <> b.price THEN d.status END AS status
FROM b FULL JOIN d ON b.id = d.id""")
def stream_evolve(spark, sf):
    """A table that starts cold with customers (a segment, no status), then a drop of their latest
    orders that lacks the segment and brings a status: old rows keep their segment, new ones have
    none, and the price's type widens."""
    base = scratch_path(spark, "stream_evolve")
    c = load(spark, sf, "customer").where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("id"), F.floor("c_acctbal").cast("int").alias("price"), F.col("c_mktsegment").alias("segment"), F.lit(0).alias("at"))
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.round("o_totalprice").cast("bigint").alias("price"), F.col("o_orderstatus").alias("status"),
                                         F.date_format("o_orderdate", "yyyyMMddHHmmss").cast("bigint").alias("at"), F.col("o_orderkey").alias("number"))
    for i, (df, order) in enumerate([(c, ["at"]), (o, ["at", "number"])]):
        write_json_drops(df, f"{base}/landing{i}", mode="overwrite")
        ingest_drops(spark, f"{base}/landing{i}", df.schema, f"{base}/table", "id", "price", f"{base}/checkpoint{i}", order,
                     files_per_batch=None, bucketed=True, rows_per_bucket=300)
    return read_bucketed(spark, f"{base}/table").select("id", "price", "segment", "status")


def _customer_docs(spark, sf) -> DataFrame:
    """Drops that repeat ids: an order is a sighting of its customer's price;
    every 50th sighting has no id."""
    o = load(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey"))
    return o.select(F.struct(key.alias("id"), F.round("o_totalprice").cast("bigint").alias("price")).alias("propertyDetails"),
                    F.struct(F.col("o_orderkey").alias("number"), F.col("o_orderdate").alias("date")).alias("search"))


@query("stream_cold_start", ids="K1 A4 B7", sql="""
WITH s AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS id, CAST(round(o_totalprice) AS BIGINT) AS price,
                  o_orderkey AS number, o_orderdate AS searched FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY searched DESC, number DESC) AS rn FROM s)
SELECT id, price, number FROM r WHERE id IS NULL OR rn = 1""")
def stream_cold_start(spark, sf):
    """A table that does not exist yet, drops with repeated ids (the latest
    search wins, whether its price rose or fell) and rows without an id (each
    is kept)."""
    base = scratch_path(spark, "stream_cold_start")
    write_json_drops(_customer_docs(spark, sf), f"{base}/landing", mode="overwrite")
    ingest_drops(spark, f"{base}/landing", "propertyDetails struct<id: bigint, price: bigint>, "
                 "search struct<number: bigint, date: timestamp_ntz>", f"{base}/table", "id", "price", f"{base}/checkpoint",
                 ["searched", "number"], files_per_batch=None, bucketed=True,
                 prepare=lambda d: d.select(F.col("propertyDetails_id").alias("id"), F.col("propertyDetails_price").alias("price"),
                                            F.col("search_number").alias("number"), F.col("search_date").alias("searched")))
    return read_bucketed(spark, f"{base}/table").select("id", "price", "number")


@query("cdc_price_returns", ids="E1 E6", sql="""
WITH st AS (SELECT o_custkey AS id, CAST(o_orderkey % 3 AS BIGINT) AS price, o_orderdate AS seen, o_orderkey AS number FROM orders),
l AS (SELECT id, price FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen DESC, number DESC) AS rn FROM st) WHERE rn = 1),
i AS (SELECT c_custkey AS id, CAST(1 AS BIGINT) AS price FROM customer)
SELECT i.id, i.price, CAST(i.id AS VARCHAR) || '-1' AS fingerprint FROM i LEFT JOIN l ON i.id = l.id WHERE l.id IS NULL OR l.price <> 1""")
def cdc_price_returns(spark, sf):
    """The store repeats ids with prices that come and go; only the latest
    stored row counts, so a price that returns to an older value is a change."""
    stored = load(spark, sf, "orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 3).alias("price"),
                                              F.col("o_orderdate").alias("seen"), F.col("o_orderkey").alias("number"))
    inc = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit(1).cast("bigint").alias("price"))
    return changed_or_new(inc, stored, "id", "price", latest_by=["seen", "number"])


@query("table_upsert", ids="B7 B1 A4", sql=UPSERT_SQL)
def table_upsert(spark, sf):
    """Versioned table on storage: write the stored table, merge the change
    set into the next version, read the newest committed version."""
    base = scratch_path(spark, "table_upsert")
    write_version(stored_orders(spark, sf), base)
    cur = read_table_or_empty(spark, base)
    ch = changed_or_new_unique(incoming_orders(spark, sf), cur, "o_orderkey", "price").drop("fingerprint")
    upsert_table(spark, ch, base, "o_orderkey", dedupe="error")
    return read_table_or_empty(spark, base).select(*COLS)


@query("cold_start_upsert", ids="A4 B7", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS propertyDetails_propertyId,
       CAST(round(o_totalprice) AS BIGINT) AS propertyDetails_normalizedPrice FROM orders""")
def cold_start_upsert(spark, sf):
    """First run: the table does not exist, so it reads as the empty
    cold-start table and the whole incoming set is inserted."""
    empty = read_table_or_empty(spark, scratch_path(spark, "cold_start"), COLD_START_SCHEMA)
    src = load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("propertyDetails_propertyId"),
        F.round("o_totalprice").cast("bigint").alias("propertyDetails_normalizedPrice"))
    return upsert(empty, src, "propertyDetails_propertyId", dedupe="none")
