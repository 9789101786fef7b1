"""Schema, column, filter, join, set and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.functions.scalar import (bin_right_closed, escape_quotes, indicator, json_path, ln_or_null,
                                    name_part, ratio, run_date_text, run_datetime_text, search_key,
                                    dround, money_avg, sig_round, zero_aware_log)
from domus.operators import columns as C
from domus.operators import filters as D
from domus.operators.setops import attach_by_key, flatten_lists, left_join, union_many
from domus.plans.registry import load, query, sql_money_avg, sql_round, sql_sig
from domus.sources.readers import object_of_records, sub_document, typed_object_of_records

# ---------------------------------------------------------------- helpers

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def lineitem_with_nulls(spark, sf):
    """lineitem with missing values made by key (the driver tables have none)."""
    li = load(spark, sf, "lineitem")
    return li.select(
        *KEYS,
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.when(F.col("l_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", "l_shipdate")


LI_NULLS_SQL = """li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS l_discount,
         l_tax,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus, l_shipdate
  FROM lineitem)"""


# ---------------------------------------------------------------- C: columns

def _listing_docs(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.struct(F.col("o_totalprice").alias("price"), F.lit("CHF").alias("currency")).alias("prices"),
                 F.col("o_orderstatus").alias("status"),
                 F.struct(F.col("o_orderdate").alias("createdAt")).alias("meta")).alias("listing"),
        F.struct(F.col("c_name").alias("legalName"),
                 F.struct(F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("segment"))
                 .alias("address")).alias("lister"),
        F.array(F.col("o_orderpriority")).alias("platforms"))


@query("flatten_structs", ids="C1 C4 C5", bench=True, sql="""
SELECT o_orderkey AS id, o_totalprice AS listing_prices_price, 'CHF' AS listing_prices_currency,
       o_orderstatus AS listing_status, o_orderdate AS listing_meta_createdAt,
       c_name AS lister_legalName, c_nationkey AS lister_address_country
FROM orders JOIN customer ON o_custkey = c_custkey""")
def flatten_structs_q(spark, sf):
    return C.flatten_structs(_listing_docs(spark, sf), drop=["lister_address_segment", "platforms"])


@query("flatten_explode", ids="C2", bench=True, sql="""
SELECT id, vector_label, CAST(vector_points_pos AS INTEGER) AS vector_points_pos, CAST(v AS DOUBLE) AS vector_points_value FROM (
  SELECT vec_id AS id, label AS vector_label,
         unnest(generate_series(0, len(embedding) - 1)) AS vector_points_pos, unnest(embedding) AS v
  FROM embeddings)""")
def flatten_explode_q(spark, sf):
    e = load(spark, sf, "embeddings")
    doc = e.select(F.col("vec_id").alias("id"), F.struct(
        F.col("label").alias("label"),
        F.transform("embedding", lambda x, i: F.struct(i.alias("pos"), x.alias("value"))).alias("points"))
        .alias("vector"))
    out = C.flatten_explode(doc, explode=["vector_points"])
    return out.withColumn("vector_points_value", F.col("vector_points_value").cast("double"))


def _messy_customer(spark, sf):
    c = load(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name (full)"),
                    F.col("c_nationkey").alias("Nation=Key"), F.col("c_acctbal").alias("acct;bal"),
                    F.col("c_mktsegment").alias("Mkt{Segment}"))


@query("clean_names", ids="C3", sql="""
SELECT c_custkey AS "CustKey", c_name AS "Namefull", c_nationkey AS "NationKey", c_acctbal AS "acctbal",
       c_mktsegment AS "MktSegment" FROM customer""")
def clean_names_q(spark, sf):
    return C.clean_names(_messy_customer(spark, sf))


@query("lower_names", ids="C6 C3", sql="""
SELECT c_custkey AS custkey, c_name AS namefull, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer""")
def lower_names_q(spark, sf):
    return C.lower_names(C.clean_names(_messy_customer(spark, sf)))


@query("prefix_names", ids="C7", sql="""
SELECT c_custkey AS customer_c_custkey, c_name AS customer_c_name, c_nationkey AS customer_c_nationkey,
       c_acctbal AS customer_c_acctbal, c_mktsegment AS customer_c_mktsegment FROM customer""")
def prefix_names_q(spark, sf):
    return C.prefix_names(load(spark, sf, "customer"), "customer_")


@query("rename_map", ids="C8", sql="""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS f2, c_acctbal AS f3, c_mktsegment AS f4 FROM customer""")
def rename_map_q(spark, sf):
    c = C.rename(load(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name"})
    return C.rename(c, ["id", "name", "f2", "f3", "f4"])


@query("select_by_type", ids="C9 C10", sql="SELECT p_partkey, p_name, p_brand, p_type FROM part")
def select_by_type_q(spark, sf):
    return C.select_by_type(load(spark, sf, "part"), "string", keep=["p_partkey"])


RUN_TS = "2024-05-06 07:08:09"


@query("enrich_document", ids="C11 I6", sql=f"""
SELECT event_id AS listing_id, value AS listing_detail_value,
       event_type AS propertyDetails_propertyType, 'buy' AS propertyDetails_isBuyRent,
       CAST(event_id AS VARCHAR) AS propertyDetails_propertyId,
       'user_' || CAST(user_id AS VARCHAR) AS propertyDetails_searchCity,
       0 AS propertyDetails_searchRadius,
       strftime(TIMESTAMP '{RUN_TS}', '%y%m%d') AS propertyDetails_searchDate,
       strftime(TIMESTAMP '{RUN_TS}', '%y%m%d_%H%M%S') AS propertyDetails_searchDateTime,
       strftime(ts, '%y%m%d') AS propertyDetails_eventDate
FROM events""")
def enrich_document_q(spark, sf):
    ev = load(spark, sf, "events")
    doc = ev.select(F.struct(F.col("event_id").alias("id"),
                             F.struct(F.col("value").alias("value")).alias("detail")).alias("listing"),
                    "event_type", "user_id", "ts")
    run = F.expr(f"TIMESTAMP_NTZ '{RUN_TS}'")
    doc = C.enrich(doc, "propertyDetails", {
        "propertyType": F.col("event_type"), "isBuyRent": F.lit("buy"),
        "propertyId": F.col("listing.id").cast("string"),
        "searchCity": F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        "searchRadius": F.lit(0), "searchDate": run_date_text(run),
        "searchDateTime": run_datetime_text(run), "eventDate": run_date_text(F.col("ts"))})
    return C.flatten_structs(doc.drop("event_type", "user_id", "ts"))


@query("replace_values", ids="C12", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_linestatus = 'R' THEN 'X' ELSE l_linestatus END AS l_linestatus
FROM lineitem""")
def replace_values_q(spark, sf):
    li = load(spark, sf, "lineitem").select(*KEYS, "l_returnflag", "l_linestatus")
    return C.replace_values(li, "R", "X", subset=["l_returnflag", "l_linestatus"])


@query("fill_constant", ids="C13", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(l_quantity, 0) AS l_quantity,
       coalesce(l_discount, 0) AS l_discount, coalesce(l_returnflag, 'None') AS l_returnflag FROM li""")
def fill_constant_q(spark, sf):
    li = lineitem_with_nulls(spark, sf).select(*KEYS, "l_quantity", "l_discount", "l_returnflag")
    return C.fill_constant(li, 0, "None", subset=["l_quantity", "l_discount", "l_returnflag"])


@query("fill_mean", ids="C14", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       """ + sql_round("coalesce(l_quantity, avg(l_quantity) OVER ())", 6) + """ AS l_quantity,
       """ + sql_round("coalesce(l_discount, avg(l_discount) OVER ())", 6) + """ AS l_discount FROM li""")
def fill_mean_q(spark, sf):
    li = lineitem_with_nulls(spark, sf).select(*KEYS, "l_quantity", "l_discount")
    out = C.fill_mean(li, subset=["l_quantity", "l_discount"])
    return out.select(*KEYS, dround("l_quantity", 6).alias("l_quantity"), dround("l_discount", 6).alias("l_discount"))


@query("numeric_if_all_parse", ids="C15", sql="""
SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def numeric_if_all_parse_q(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("string").alias("p_size"),
                                       F.col("p_retailprice").cast("string").alias("p_retailprice"))
    return C.numeric_if_all_parse(p)


@query("price_per_unit", ids="C17 I13", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       l_extendedprice / l_quantity AS price_per_unit,
       CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END AS quantity_missing FROM li""")
def price_per_unit_q(spark, sf):
    li = lineitem_with_nulls(spark, sf)
    return li.select(*KEYS, ratio("l_extendedprice", "l_quantity").alias("price_per_unit"),
                     indicator(F.col("l_quantity").isNull()).alias("quantity_missing"))


@query("map_markers", ids="C16 I11", sql="""
SELECT p_partkey AS id, '/buy/' || CAST(p_partkey AS VARCHAR) AS link,
       replace(p_name, '''', '\\''') AS title,
       'CHF ' || CAST(CAST(round(p_retailprice) AS BIGINT) AS VARCHAR) AS price_text,
       CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon
FROM part JOIN embeddings ON p_partkey = vec_id""")
def map_markers_q(spark, sf):
    p = load(spark, sf, "part")
    e = load(spark, sf, "embeddings")
    j = p.join(e, p.p_partkey == e.vec_id, "inner")
    return j.select(F.col("p_partkey").alias("id"), F.concat(F.lit("/buy/"), F.col("p_partkey").cast("string")).alias("link"),
                    escape_quotes("p_name").alias("title"),
                    F.concat(F.lit("CHF "), F.round("p_retailprice").cast("bigint").cast("string")).alias("price_text"),
                    F.col("embedding")[0].cast("double").alias("lat"),
                    F.col("embedding")[1].cast("double").alias("lon"))


# ---------------------------------------------------------------- A5, A6, D10, I9

@query("map_records", ids="A6 C15", sql="""
SELECT event_id AS id, event_type, value, user_id AS "user" FROM events""")
def map_records_q(spark, sf):
    ev = load(spark, sf, "events")
    doc = ev.select(F.to_json(F.create_map(
        F.col("event_id").cast("string"),
        F.struct("event_type", F.col("value").cast("string").alias("value"),
                 F.col("user_id").cast("string").alias("user")))).alias("doc"))
    rows = object_of_records(doc, "doc", "struct<event_type: string, value: string, user: string>", "id")
    return C.numeric_if_all_parse(rows, subset=["id", "value", "user"])


@query("map_records_typed", ids="A6", sql="""
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS "type", CAST(user_id AS BIGINT) AS "user", value FROM events""")
def map_records_typed_q(spark, sf):
    """Objects of up to 50 records each, a broken text among them, and no declared schema."""
    ev = load(spark, sf, "events").withColumn("part", F.floor(F.col("event_id") / 50))
    record = F.struct(F.col("event_type").alias("type"), F.col("user_id").cast("bigint").alias("user"), "value")
    docs = ev.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("event_id").cast("string"), record)))).alias("doc")).select("doc")
    return typed_object_of_records(docs.unionByName(spark.range(1).select(F.lit('{"1": {"type": ').alias("doc"))), "doc").select("id", "type", "user", "value")


def _broken_props(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", F.when(F.col("event_id") % 5 == 0, F.replace("props", F.lit("}"), F.lit("")))
                     .otherwise(F.col("props")).alias("props"), "event_type", "value")


@query("json_valid", ids="D10 I9", sql="""
WITH ev AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN replace(props, '}', '') ELSE props END AS props
            FROM events)
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM ev WHERE json_valid(props)""")
def json_valid_q(spark, sf):
    ev = D.valid_json(_broken_props(spark, sf), "props")
    return ev.select("event_id", json_path("props", "$.k").cast("int").alias("k"))


@query("nested_price", ids="I9 A5", sql="""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS propertyDetails_type
FROM events""")
def nested_price_q(spark, sf):
    """A JSON document per event where error events lack the
    ``propertyDetails`` level: the price path yields null there (I9), and
    the sub-document is taken out and flattened (A5)."""
    ev = load(spark, sf, "events")
    pd_ = F.struct(F.col("value").alias("normalizedPrice"), F.col("event_type").alias("type"))
    doc = ev.select("event_id", F.when(F.col("event_type") == "error",
                                       F.to_json(F.struct(F.struct(F.col("value").alias("v")).alias("other"))))
                    .otherwise(F.to_json(F.struct(pd_.alias("propertyDetails")))).alias("doc"))
    parsed = doc.select("event_id", json_path("doc", "$.propertyDetails.normalizedPrice").cast("double").alias("price"),
                        F.from_json("doc", "propertyDetails struct<normalizedPrice: double, type: string>").alias("d"))
    item = parsed.select(F.struct("event_id", "price", F.col("d.propertyDetails").alias("propertyDetails")).alias("item"))
    flat = C.flatten_structs(sub_document(item, "item"))
    return flat.select("event_id", "price", "propertyDetails_type")


# ---------------------------------------------------------------- D: filters

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("quarantine", ids="D11", sql="""
SELECT c_custkey,
       concat_ws(',', CASE WHEN NOT coalesce(c_acctbal >= 0, false) THEN 'acctbal_nonneg' END,
                      CASE WHEN NOT coalesce(c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE'), false)
                           THEN 'segment_known' END,
                      CASE WHEN NOT coalesce(c_name LIKE 'Customer#%', false) THEN 'name_format' END) AS reasons,
       (coalesce(c_acctbal >= 0, false) AND coalesce(c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE'), false)
        AND coalesce(c_name LIKE 'Customer#%', false)) AS ok
FROM customer""")
def quarantine_q(spark, sf):
    c = load(spark, sf, "customer")
    q = D.quarantine(c, {"acctbal_nonneg": F.col("c_acctbal") >= 0,
                         "segment_known": F.col("c_mktsegment").isin(SEGMENTS[:3]),
                         "name_format": F.col("c_name").like("Customer#%")})
    return q.select("c_custkey", F.concat_ws(",", "reasons").alias("reasons"), "ok")


@query("price_band", ids="D2", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= 200000")
def price_band_q(spark, sf):
    return D.at_most(load(spark, sf, "orders"), "o_totalprice", 200000).select("o_orderkey", "o_totalprice")


BRANDS = [f"Brand#{i}" for i in range(1, 8)]


@query("category_filter", ids="D4", sql="SELECT p_partkey, p_brand FROM part WHERE p_brand IN ("
       + ", ".join(f"'{b}'" for b in BRANDS) + ")")
def category_filter_q(spark, sf):
    return D.one_of(load(spark, sf, "part"), "p_brand", BRANDS).select("p_partkey", "p_brand")


@query("route_filter", ids="D5", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
WHERE ((l_quantity <= 20 AND l_discount <= 0.05) OR l_returnflag = 'R') AND l_linestatus = 'O'""")
def route_filter_q(spark, sf):
    li = load(spark, sf, "lineitem")
    cond = (((F.col("l_quantity") <= 20) & (F.col("l_discount") <= 0.05)) | (F.col("l_returnflag") == "R")) \
        & (F.col("l_linestatus") == "O")
    return li.where(cond).select(*KEYS)


@query("nonzero_price", ids="D3", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount FROM li WHERE coalesce(l_discount, 0) <> 0""")
def nonzero_price_q(spark, sf):
    return D.nonzero(lineitem_with_nulls(spark, sf), "l_discount").select(*KEYS, "l_discount")


@query("drop_null_rows", ids="D6", sql="WITH " + LI_NULLS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM li WHERE l_quantity IS NOT NULL""")
def drop_null_rows_q(spark, sf):
    return D.drop_null(lineitem_with_nulls(spark, sf), ["l_quantity"]).select(*KEYS, "l_quantity")


@query("drop_by_key", ids="D7", sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (5, 7, 1299) AND o_totalprice > 0""")
def drop_by_key_q(spark, sf):
    o = D.positive(D.drop_keys(load(spark, sf, "orders"), "o_orderkey", [5, 7, 1299]), "o_totalprice")
    return o.select("o_orderkey", "o_totalprice")


@query("point_lookup", ids="D8 L2", sql="SELECT * FROM orders WHERE o_orderkey = 1299")
def point_lookup_q(spark, sf):
    path = f"{sf.rstrip('/')}/orders.parquet"
    return spark.sql(f"SELECT * FROM parquet.`{path}` WHERE o_orderkey = 1299")


# ---------------------------------------------------------------- E, H: joins and sets

@query("left_join_routes", ids="E2", sql="""
WITH r AS (SELECT o_custkey, count(*) AS n_orders, """ + sql_round(sql_money_avg("o_totalprice"), 4) + """ AS avg_price
           FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, r.n_orders, r.avg_price FROM customer LEFT JOIN r ON c_custkey = r.o_custkey""")
def left_join_routes_q(spark, sf):
    routes = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), dround(money_avg("o_totalprice"), 4).alias("avg_price"))
    return left_join(load(spark, sf, "customer").select("c_custkey", "c_name"), routes, "c_custkey")


@query("attach_by_key", ids="E3 I7", sql="""
SELECT c_custkey, c_name,
       CASE WHEN c_acctbal > 0 THEN """ + sql_sig("ln(c_acctbal)") + """ END AS log_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_building
FROM customer""")
def attach_by_key_q(spark, sf):
    c = load(spark, sf, "customer")
    a = c.select("c_custkey", "c_name")
    b = c.select("c_custkey", sig_round(ln_or_null("c_acctbal")).alias("log_acctbal"),
                 indicator(F.col("c_mktsegment") == "BUILDING").alias("is_building"))
    return attach_by_key(a, b, "c_custkey")


@query("union_many", ids="H1", sql="""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment,
       'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def union_many_q(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                           F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                           F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                           F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                                           F.lit("supplier").alias("kind"))
    return union_many([c, s])


@query("gather_lists", ids="H2", sql="""
WITH x AS (SELECT conv_id, turn,
                  list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' ')) AS lists
           FROM conversations),
y AS (SELECT conv_id, turn, CAST(len(lists) AS INTEGER) AS n_lists, flatten(lists) AS items FROM x)
SELECT conv_id, turn, n_lists, CAST(len(items) AS INTEGER) AS n_items, items[1] AS first_item, items[len(items)] AS last_item
FROM y""")
def gather_lists_q(spark, sf):
    cv = load(spark, sf, "conversations")
    lists = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    x = cv.select("conv_id", "turn", lists.alias("lists"))
    y = x.select("conv_id", "turn", F.size("lists").alias("n_lists"), flatten_lists("lists").alias("items"))
    return y.select("conv_id", "turn", "n_lists", F.size("items").alias("n_items"),
                    F.element_at("items", 1).alias("first_item"), F.element_at("items", -1).alias("last_item"))


# ---------------------------------------------------------------- I: scalar functions

@query("search_key", ids="I2", sql="""
SELECT c_custkey,
       lower(replace(concat_ws('_', n_name, c_mktsegment, 'real-estate', CAST(c_nationkey AS VARCHAR)), '-', '_'))
         AS search_key
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def search_key_q(spark, sf):
    c = load(spark, sf, "customer")
    n = load(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    return j.select("c_custkey", search_key("n_name", "c_mktsegment", F.lit("real-estate"), "c_nationkey").alias("search_key"))


@query("date_text", ids="I6", sql="""
SELECT event_id, strftime(ts, '%y%m%d') AS run_date, strftime(ts, '%y%m%d_%H%M%S') AS run_datetime FROM events""")
def date_text_q(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", run_date_text("ts").alias("run_date"), run_datetime_text("ts").alias("run_datetime"))


@query("name_part", ids="I12", sql="SELECT c_custkey, split_part(c_name, '#', 2) AS name_part FROM customer")
def name_part_q(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", name_part("c_name", "#", 2).alias("name_part"))


@query("log_transform", ids="I7", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
       + sql_sig("ln(l_extendedprice)") + " AS log_price FROM lineitem")
def log_transform_q(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(*KEYS, sig_round(ln_or_null("l_extendedprice")).alias("log_price"))


@query("zero_log", ids="I8 I13", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
       "CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS has_discount, "
       "CASE WHEN l_discount > 0 THEN " + sql_sig("ln(l_discount)") + " ELSE l_discount END AS log_discount "
       "FROM lineitem")
def zero_log_q(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(*KEYS, indicator(F.col("l_discount") > 0).alias("has_discount"),
                     F.when(F.col("l_discount") > 0, sig_round(zero_aware_log("l_discount")))
                     .otherwise(F.col("l_discount")).alias("log_discount"))


EDGES = [float(x) for x in range(0, 52, 4)]  # 13 edges, 12 right-closed bins


@query("bins_range", ids="I10", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE "
       + " ".join(f"WHEN l_quantity > {EDGES[i]} AND l_quantity <= {EDGES[i + 1]} THEN {i}" for i in range(len(EDGES) - 1))
       + " END AS quantity_bin FROM lineitem")
def bins_range_q(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(*KEYS, bin_right_closed("l_quantity", EDGES).alias("quantity_bin"))


@query("id_membership", ids="D1 E6", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def id_membership_q(spark, sf):
    """Orders of the customers in one segment: the id list is a frame joined
    with ``left_semi``, never text spliced into SQL."""
    keys = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return D.in_keys(load(spark, sf, "orders"), keys, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")
