"""Properties of SURVEY §7.4: results do not depend on partitioning; hot keys
are handled; the model views agree with each other."""

import os
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture()
def repartitioned_reads(monkeypatch):
    orig = DataFrameReader.parquet

    def parquet(self, *paths, **kw):
        return orig(self, *paths, **kw).repartition(7)
    monkeypatch.setattr(DataFrameReader, "parquet", parquet)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_result_after_repartition(spark, con, repartitioned_reads, name):
    df = entry.queries()[name](spark, SF)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    b = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert Counter(a) == Counter(b)


def test_change_detection_hot_key(spark):
    from domus.operators.cdc import changed_or_new
    # a third of the stored table is one key, with many prices
    hot = spark.range(0, 3000).select(F.lit("hot").alias("id"), F.col("id").alias("price"))
    rest = spark.range(0, 6000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("price"))
    stored = hot.unionByName(rest).repartition(8)
    inc = spark.createDataFrame([("hot", 17), ("hot", 5000), ("1", 1), ("2", 3), ("x", 1)], "id string, price bigint")
    got = sorted((r["id"], r["price"]) for r in changed_or_new(inc, stored, "id", "price").collect())
    # without an order, stored rows that disagree make every price a change
    assert got == [("2", 3), ("hot", 17), ("hot", 5000), ("x", 1)]
    latest = changed_or_new(inc.unionByName(spark.createDataFrame([("hot", 2999)], inc.schema)), stored, "id", "price", latest_by=["price"])
    assert sorted((r["id"], r["price"]) for r in latest.collect()) == got


def test_nested_models_agree_with_one_predictor_ols(spark):
    from domus.operators import models as M
    from domus.operators import profile as P
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    one = P.ols_one(li, "l_extendedprice", "l_quantity").first()
    nm = {r["formula"]: r for r in M.nested_models(li, "l_extendedprice", [["l_quantity"]]).collect()}
    r = nm["l_extendedprice ~ l_quantity"]
    assert r["r2"] == pytest.approx(one["r2"], rel=1e-8)
    assert r["llf"] == pytest.approx(one["llf"], rel=1e-9) and r["aic"] == pytest.approx(one["aic"], rel=1e-9)
