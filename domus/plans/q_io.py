"""Source/sink round trips (A1–A4, B1–B3, B5, B6) through the shared
checkpoint folder; each reads back what it wrote over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.operators.columns import flatten_structs
from domus.plans.q_cdc import ts
from domus.plans.registry import load, query
from domus.session import scratch_path
from domus.sinks.writers import (create_table_as, overwrite_parquet, overwrite_partitions, register_table, replace_interval,
                                 write_csv, write_json_drops)
from domus.sources.readers import read_delimited, read_json_drops, read_parquet, typed_json

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")


@query("csv_round_trip", ids="A2 B3", sql="SELECT * FROM orders")
def csv_round_trip_q(spark, sf):
    """Written as CSV beside a file of malformed rows, which are left out
    whatever columns are asked for."""
    p = scratch_path(spark, "csv")
    write_csv(load(spark, sf, "orders"), p, sep=";")
    bad = load(spark, sf, "customer").select(F.concat(F.lit("x;"), F.col("c_custkey").cast("string"), F.lit(";F;oops;;")).alias("value"))
    bad.write.mode("append").text(p)
    return read_delimited(spark, p, ORDERS_SCHEMA, sep=";", header=True)


@query("csv_malformed", ids="A2", sql="SELECT 'x;' || c_custkey || ';F;oops;;' AS malformed FROM customer")
def csv_malformed_q(spark, sf):
    p = scratch_path(spark, "csv")
    write_csv(load(spark, sf, "orders"), p, sep=";")
    bad = load(spark, sf, "customer").select(F.concat(F.lit("x;"), F.col("c_custkey").cast("string"), F.lit(";F;oops;;")).alias("value"))
    # a text file of rows has no header line of its own: one is put first in each partition's file
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    bad.select(F.explode(F.when(first, F.array(F.lit("h"), "value")).otherwise(F.array("value"))).alias("value")
                           ).write.mode("append").text(p)
    return read_delimited(spark, p, ORDERS_SCHEMA, sep=";", malformed="only")


@query("json_pretty_round_trip", ids="A1", sql="SELECT c_custkey AS id, c_name AS name FROM customer")
def json_pretty_round_trip_q(spark, sf):
    """Pretty-printed arrays of documents, one array of at most 500 customers a file."""
    p = scratch_path(spark, "json")
    c = load(spark, sf, "customer")
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), {"pretty": "true"})
    files = c.groupBy(F.floor(F.col("c_custkey") / 500).alias("part")).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(doc), ",\n"), F.lit("\n]\n")).alias("value"))
    files.write.partitionBy("part").text(p)
    return read_json_drops(spark, p, "id bigint, name string", multi_line=True).select("id", "name")


@query("json_gz_round_trip", ids="A1 B2 C1", sql="""
SELECT o_orderkey AS listing_id, o_totalprice AS listing_price, o_custkey AS lister_id,
       o_orderstatus AS listing_status, o_orderdate AS listing_date, o_orderpriority AS o_orderpriority FROM orders""")
def json_gz_round_trip_q(spark, sf):
    p = scratch_path(spark, "json")
    o = load(spark, sf, "orders")
    docs = o.select(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"),
                             F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("date")).alias("listing"),
                    F.struct(F.col("o_custkey").alias("id")).alias("lister"), "o_orderpriority")
    write_json_drops(docs, p, partition_by=["o_orderpriority"], mode="overwrite")
    schema = ("listing struct<id: bigint, price: double, status: string, date: timestamp_ntz>, "
              "lister struct<id: bigint>, o_orderpriority string")
    return flatten_structs(read_json_drops(spark, p, schema))


@query("json_typed_drops", ids="A1 C1", sql="""
SELECT o_custkey AS lister_id, o_orderkey AS listing_id, o_totalprice AS listing_price, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS listing_status FROM orders""")
def json_typed_drops_q(spark, sf):
    """gz JSON drops read without a schema; a field that only some documents have."""
    p = scratch_path(spark, "json")
    o = load(spark, sf, "orders")
    docs = o.select(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("status")).alias("listing"),
                    F.struct(F.col("o_custkey").alias("id")).alias("lister"))
    write_json_drops(docs, p, mode="overwrite")
    return flatten_structs(typed_json(spark.read.text(p), "value")).select("lister_id", "listing_id", "listing_price", "listing_status")


@query("parquet_round_trip", ids="A3 B1", sql="SELECT * FROM orders")
def parquet_round_trip_q(spark, sf):
    p = scratch_path(spark, "parquet")
    overwrite_parquet(load(spark, sf, "orders"), p, partition_by=["o_orderpriority"])
    return read_parquet(spark, p).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                         "o_orderdate", "o_orderpriority")


@query("interval_replace", ids="B5", sql="""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01')
UNION ALL
SELECT o_orderkey, o_totalprice + 1, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def interval_replace_q(spark, sf):
    """The table is written by year; the year's new rows replace that
    partition only."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate").withColumn("year", F.year("o_orderdate"))
    p = scratch_path(spark, "interval")
    overwrite_partitions(o, p, ["year"])
    new = replace_interval(o.limit(0), o.withColumn("o_totalprice", F.col("o_totalprice") + 1), "o_orderdate",
                           ts("1997-01-01 00:00:00"), ts("1998-01-01 00:00:00"))
    overwrite_partitions(new, p, ["year"])
    return read_parquet(spark, p).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("ctas", ids="B6 L2", sql="""
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority""")
def ctas_q(spark, sf):
    base = scratch_path(spark, "ctas")
    db = "domus_" + base.rsplit("-", 1)[-1]
    overwrite_parquet(load(spark, sf, "orders"), f"{base}/orders")
    register_table(spark, db, "orders", f"{base}/orders", db_location=f"{base}/db")
    create_table_as(spark, db, "by_priority",
                    f"SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total "
                    f"FROM `{db}`.orders GROUP BY o_orderpriority", f"{base}/by_priority")
    return spark.sql(f"SELECT * FROM parquet.`{base}/by_priority`")
