"""Change detection and upsert: FIXTURES §2 worked rows and MERGE properties."""

import pytest
from pyspark.sql import functions as F

from domus.operators.cdc import changed_or_new, changed_or_new_unique, dedupe_latest, skip_landed, upsert
from domus.sources.readers import records

ROW = "id string, price bigint"


def ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_worked_rows(spark):
    stored = spark.createDataFrame([("41", 880000), ("52", 1250000), ("777", None)], ROW)
    incoming = spark.createDataFrame([("41", 880000), ("52", 1260000), ("123", 1260000),
                                      ("777", 1)], ROW)
    for fn in (changed_or_new, changed_or_new_unique):
        out = fn(incoming, stored, "id", "price")
        assert ids(out) == ["123", "52", "777"]
        fp = {r["id"]: r["fingerprint"] for r in out.collect()}
        assert fp["52"] == "52-1260000"


def test_duplicates_in_store_do_not_multiply(spark):
    stored = spark.createDataFrame([("1", 10), ("1", 10), ("1", 11), ("2", 5), ("2", None)], ROW)
    incoming = spark.createDataFrame([("1", 10), ("2", 5), ("3", 1)], ROW)
    out = changed_or_new(incoming, stored, "id", "price")
    # 1 has a stored copy with another price, 2 one without a price
    assert ids(out) == ["1", "2", "3"]
    assert ids(changed_or_new(incoming.where("id = '1'"), stored.where("price = 10"), "id", "price")) == []


def test_latest_stored_row_counts(spark):
    stored = spark.createDataFrame([("1", 10, 1), ("1", 11, 2), ("2", 7, 1), ("2", 5, 2), ("3", 4, 1), ("3", None, 2)], ROW + ", at int")
    incoming = spark.createDataFrame([("1", 10), ("2", 5), ("3", 4), ("4", None)], ROW)
    assert ids(changed_or_new(incoming, stored, "id", "price", latest_by=["at"])) == ["1", "3", "4"]


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 2), ("a", 5), ("a", 4)], ROW)
    assert sorted(((r[0] or "", r[1]) for r in dedupe_latest(df, "id", ["price"]).collect())) == [("", 1), ("", 2), ("", 2), ("a", 5)]


def test_float_price_text_matches_integer(spark):
    stored = spark.createDataFrame([("1", 570000.0)], "id string, price double")
    incoming = spark.createDataFrame([("1", 570000)], ROW)
    assert changed_or_new(incoming, stored, "id", "price").count() == 0


def test_upsert_semantics_and_idempotence(spark):
    t = spark.createDataFrame([("1", 10), ("2", 20), (None, 1)], ROW)
    s = spark.createDataFrame([("2", 21), ("3", 30), (None, 2)], ROW)
    u = upsert(t, s, "id", dedupe="none")
    got = sorted((r["id"] or "", r["price"]) for r in u.collect())
    assert got == [("", 1), ("", 2), ("1", 10), ("2", 21), ("3", 30)]
    # idempotent for non-null keys; null keys insert again, as MERGE does
    uu = upsert(u, s, "id", dedupe="none")
    assert sorted((r["id"], r["price"]) for r in uu.where("id is not null").collect()) == \
        sorted((r["id"], r["price"]) for r in u.where("id is not null").collect())
    # change detection after the upsert of the same source is empty (non-null keys)
    assert changed_or_new(s.where("id is not null"), u, "id", "price").count() == 0


def test_upsert_schema_evolution(spark):
    t = spark.createDataFrame([("1", 10, "a"), ("2", 20, "b")], "id string, price bigint, status string")
    s = spark.createDataFrame([("2", 21, "x"), ("3", 30, "y")], "id string, price bigint, revision string")
    u = {r["id"]: r.asDict() for r in upsert(t, s, "id", dedupe="none").collect()}
    assert u["1"] == {"id": "1", "price": 10, "status": "a", "revision": None}
    assert u["2"] == {"id": "2", "price": 21, "status": "b", "revision": "x"}
    assert u["3"] == {"id": "3", "price": 30, "status": None, "revision": "y"}


def test_upsert_dedupe(spark):
    t = spark.createDataFrame([("1", 10, "200101")], "id string, price bigint, ts string")
    s = spark.createDataFrame([("1", 11, "200102"), ("1", 12, "200103"), ("2", 5, "200101")],
                              "id string, price bigint, ts string")
    with pytest.raises(ValueError):
        upsert(t, s, "id", dedupe="error")
    u = {r["id"]: r["price"] for r in upsert(t, s, "id", dedupe="latest", order_by=["ts"]).collect()}
    assert u == {"1": 12, "2": 5}


def test_dedupe_latest_hot_key(spark):
    rows = [("hot", i, f"{i:06d}") for i in range(3000)] + [(f"k{i}", i, "0") for i in range(100)]
    df = spark.createDataFrame(rows, "id string, price bigint, ts string").repartition(7)
    out = {r["id"]: r["price"] for r in dedupe_latest(df, "id", ["ts"]).collect()}
    assert out["hot"] == 2999 and len(out) == 101


def test_skip_landed_and_records(spark):
    inc = records(spark, [{"id": "1"}, {"id": "2", "x": 1}, {"id": "3"}], "id string, x int")
    landed = spark.createDataFrame([("2",)], "id string")
    assert ids(skip_landed(inc, landed, "id")) == ["1", "3"]
    assert inc.where(F.col("x").isNull()).count() == 2


def test_same_result_after_repartition(spark):
    stored = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 3).alias("price"))
    inc = spark.range(1000, 3000).select(F.col("id").cast("string").alias("id"),
                                         (F.col("id") * 3 + (F.col("id") % 5 == 0).cast("int")).alias("price"))
    a = ids(changed_or_new(inc, stored, "id", "price"))
    b = ids(changed_or_new(inc.repartition(7), stored.repartition(3), "id", "price"))
    assert a == b and len(a) == 1000 + 200
