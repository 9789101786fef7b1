"""Sources, sinks and the streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from domus.operators.cdc import changed_or_new_unique, upsert
from domus.sinks.writers import (create_table_as, latest_version_path, register_table, replace_interval,
                                 upsert_table, write_json_drops, write_version)
from domus.sources.readers import (COLD_START_SCHEMA, read_delimited, read_json_drops, read_object_of_records,
                                   read_table_or_empty)
from domus.streaming.ingest import ingest_drops


def test_csv_drops_malformed(spark, tmp):
    p = f"{tmp}/x.csv"
    with open(p, "w") as f:
        f.write("a;b\n1;2\n3;4;5\n6;7\n")
    df = read_delimited(spark, p, "a int, b int", sep=";")
    assert sorted(tuple(r) for r in df.collect()) == [(1, 2), (6, 7)]
    assert df.count() == df.select("b").count() == 2 and sorted(r[0] for r in df.select("b").collect()) == [2, 7]
    assert [r[0] for r in read_delimited(spark, p, "a int, b int", sep=";", malformed="only").collect()] == ["3;4;5"]


def test_pretty_printed_documents(spark, tmp):
    with open(f"{tmp}/d.json", "w") as f:
        json.dump([{"id": 1, "p": {"x": 2}}, {"id": 3, "p": {"x": 4}}], f, indent=2)
    df = read_json_drops(spark, f"{tmp}/d.json", "id int, p struct<x: int>", multi_line=True)
    assert sorted((r["id"], r["p"]["x"]) for r in df.collect()) == [(1, 2), (3, 4)]


def test_cold_start_and_versions(spark, tmp):
    base = f"{tmp}/table"
    empty = read_table_or_empty(spark, base)
    assert empty.count() == 0 and empty.schema.simpleString() == \
        "struct<propertyDetails_propertyId:string,propertyDetails_normalizedPrice:bigint>"
    src = spark.createDataFrame([("1", 10), ("2", 20)], COLD_START_SCHEMA)
    upsert_table(spark, src, base, "propertyDetails_propertyId")
    upsert_table(spark, spark.createDataFrame([("2", 21)], COLD_START_SCHEMA), base, "propertyDetails_propertyId")
    assert latest_version_path(spark, base).endswith("version=000001")
    got = sorted(tuple(r) for r in read_table_or_empty(spark, base).collect())
    assert got == [("1", 10), ("2", 21)]


def test_object_of_records(spark, tmp):
    p = f"{tmp}/routes.json"
    with open(p, "w") as f:
        json.dump({"11": {"routeDurationSecCity": 600.0, "transitsNoWalkingCity": 1.0},
                   "12": {"routeDurationSecCity": 1200.0, "transitsNoWalkingCity": 2.0}}, f, indent=2)
    df = read_object_of_records(spark, p, "struct<routeDurationSecCity: double, transitsNoWalkingCity: double>")
    assert sorted(tuple(r) for r in df.collect()) == [("11", 600.0, 1.0), ("12", 1200.0, 2.0)]


def test_interval_replace_and_ddl(spark, tmp):
    t = spark.createDataFrame([(1, 5), (2, 15), (3, 25)], "id int, d int")
    s = spark.createDataFrame([(9, 12)], "id int, d int")
    assert sorted(r[0] for r in replace_interval(t, s, "d", 10, 20).collect()) == [1, 3, 9]
    t.write.parquet(f"{tmp}/t")
    register_table(spark, "domus_test_db", "t", f"{tmp}/t", db_location=f"{tmp}/db")
    create_table_as(spark, "domus_test_db", "agg", "SELECT count(*) AS n FROM domus_test_db.t", f"{tmp}/agg")
    assert spark.sql("SELECT n FROM domus_test_db.agg").first()[0] == 3


def test_stream_equals_batch(spark, tmp):
    schema = "propertyDetails struct<id: string, price: bigint>, batch int"
    stored = spark.createDataFrame([("1", 10), ("2", 20), ("3", 30)], "id string, price bigint")
    drops = spark.createDataFrame([(("2", 21), 0), (("4", 40), 0), (("3", 30), 1), (("5", 50), 1)], schema)
    write_version(stored, f"{tmp}/table")
    write_json_drops(drops, f"{tmp}/landing", partition_by=["batch"])
    prep = lambda d: d.select(F.col("propertyDetails_id").alias("id"), F.col("propertyDetails_price").alias("price"))
    ingest_drops(spark, f"{tmp}/landing", schema, f"{tmp}/table", "id", "price", f"{tmp}/ckpt", ["price"], prepare=prep)
    got = sorted(tuple(r) for r in spark.read.parquet(latest_version_path(spark, f"{tmp}/table")).collect())
    src = prep(drops.select("propertyDetails.*", "batch").select(F.struct("id", "price").alias("propertyDetails")).select(
        F.col("propertyDetails.id").alias("propertyDetails_id"), F.col("propertyDetails.price").alias("propertyDetails_price")))
    batch = upsert(stored, changed_or_new_unique(src, stored, "id", "price").drop("fingerprint"), "id", dedupe="none")
    assert got == sorted(tuple(r) for r in batch.collect())
    assert got == [("1", 10), ("2", 21), ("3", 30), ("4", 40), ("5", 50)]


def test_gz_json_round_trip(spark, tmp):
    df = spark.createDataFrame([(1, "a", "zurich"), (2, "b", "bern")], "id long, t string, city string")
    write_json_drops(df, f"{tmp}/j", partition_by=["city"])
    back = read_json_drops(spark, f"{tmp}/j", "id long, t string, city string", partitions=2)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", "zurich"), (2, "b", "bern")]


def test_bucketed_merge_writes_only_touched_buckets(spark, tmp):
    import os

    from domus.sinks.writers import merge_bucketed, read_bucketed, write_bucketed
    base = spark.range(0, 1000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("price"))
    assert write_bucketed(base, f"{tmp}/t", "id", rows_per_bucket=63) == 16
    src = spark.createDataFrame([("5", 1), ("2000", 7), (None, 3)], "id string, price bigint")
    touched = merge_bucketed(spark, src, f"{tmp}/t", "id", order_by=["price"], price="price", rows_per_bucket=500)
    assert 1 <= len(touched) <= 3
    assert len([d for d in os.listdir(f"{tmp}/t/version=000001") if d.startswith("_bucket")]) == len(touched)
    got = {r["id"]: r["price"] for r in read_bucketed(spark, f"{tmp}/t").collect()}
    assert len(got) == 1002 and got["5"] == 1 and got["2000"] == 7 and got["6"] == 12 and got[None] == 3


def test_a_stopped_batch_can_run_again(spark, tmp):
    import os

    from domus.sinks.writers import merge_bucketed, read_bucketed, write_bucketed
    base = spark.range(0, 100).select(F.col("id").cast("string").alias("id"), F.lit(1).cast("long").alias("price"))
    write_bucketed(base, f"{tmp}/t", "id", rows_per_bucket=25)
    src = spark.createDataFrame([(str(i), 2) for i in range(50, 150)] + [(None, 9), (None, 9)], "id string, price bigint")
    merge_bucketed(spark, src, f"{tmp}/t", "id", ("s", 0), order_by=["price"], price="price")
    want = sorted(map(str, read_bucketed(spark, f"{tmp}/t").collect()))
    assert len(want) == 152
    # stopped before the record was written, with a bucket missing: the table is as before, then as after
    os.rename(f"{tmp}/t/_commits/000001.json", f"{tmp}/record")
    gone = next(d for d in os.listdir(f"{tmp}/t/version=000001") if d.startswith("_bucket"))
    os.rename(f"{tmp}/t/version=000001/{gone}", f"{tmp}/{gone}")
    assert read_bucketed(spark, f"{tmp}/t").count() == 100
    for _ in range(2):  # again, and once more after it was committed
        merge_bucketed(spark, src, f"{tmp}/t", "id", ("s", 0), order_by=["price"], price="price")
        assert sorted(map(str, read_bucketed(spark, f"{tmp}/t").collect())) == want
    assert sorted(os.listdir(f"{tmp}/t/_commits"))[-1] == "000001.json"


def test_a_fresh_checkpoint_loses_nothing(spark, tmp):
    from domus.sinks.writers import read_bucketed
    schema = "id string, price long, at string"
    for i in range(4):
        write_json_drops(spark.createDataFrame([(str(i + 1), 10 * i, "a")], schema).coalesce(1), f"{tmp}/l{i // 2}", mode="append")
    for run, (landing, checkpoint) in enumerate([("l0", "c0"), ("l1", "c1"), ("l1", "c1"), ("l1", "c2")]):
        ingest_drops(spark, f"{tmp}/{landing}", schema, f"{tmp}/t", "id", "price", f"{tmp}/{checkpoint}", ["at"], bucketed=True)
        assert sorted(r["id"] for r in read_bucketed(spark, f"{tmp}/t").collect()) == ["1", "2", "3", "4"][:2 if run == 0 else 4]


def test_buckets_split_as_the_table_grows(spark, tmp):
    from domus.sinks import buckets as B
    want = {}
    for i, (lo, hi) in enumerate([(0, 3), (0, 50), (40, 400), (395, 410), (0, 1)]):
        src = spark.range(lo, hi).select(F.col("id").cast("string").alias("id"), (F.col("id") + i).alias("price"))
        src = src.unionByName(spark.createDataFrame([(None, 1000 + i)], "id string, price long"))
        B.merge_bucketed(spark, src, f"{tmp}/t", "id", order_by=["price"], rows_per_bucket=20)
        want.update({str(k): k + i for k in range(lo, hi)})
        want.update({f"null{i}": 1000 + i})
        rows = B.read_bucketed(spark, f"{tmp}/t").collect()
        got = {r["id"] if r["id"] is not None else f"null{r['price'] - 1000}": r["price"] for r in rows}
        assert got == want and len(rows) == len(want)
    record = B._Record.newest(spark, f"{tmp}/t")
    assert record.buckets >= 32 and max(record.rows) <= 20 and sum(record.rows) >= len(want)


def test_columns_that_come_and_go(spark, tmp):
    from domus.sinks import buckets as B
    merge = lambda rows, schema: B.merge_bucketed(spark, spark.createDataFrame(rows, schema), f"{tmp}/t", "id", order_by=["price"], rows_per_bucket=2)
    merge([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], "id long, price int, t string")
    merge([(2, 21, 7), (4, 2**40, 8), (None, 5, 9)], "id long, price long, extra int")
    merge([(5, 1, 2.5)], "id long, price int, extra double")
    got = {r["id"]: (r["price"], r["t"], r["extra"]) for r in B.read_bucketed(spark, f"{tmp}/t").collect()}
    assert got == {1: (10, "a", None), 2: (21, "b", 7.0), 3: (30, "c", None), 4: (2**40, None, 8.0), None: (5, None, 9.0), 5: (1, None, 2.5)}
    assert B.read_bucketed(spark, f"{tmp}/t").dtypes == [("id", "bigint"), ("price", "bigint"), ("t", "string"), ("extra", "double")]
    with pytest.raises(ValueError, match="do not go together"):
        merge([(1, "x")], "id long, price string")
    assert B.read_bucketed(spark, f"{tmp}/t").count() == 6
    merge([], "id long, price long")
    assert B.read_bucketed(spark, f"{tmp}/nothing") is None and B.read_bucketed(spark, f"{tmp}/t").count() == 6


def test_stream_keeps_the_latest_and_starts_cold(spark, tmp):
    from domus.sinks.writers import read_bucketed
    drops = spark.createDataFrame([("1", 500, "240101"), ("1", 450, "240202"), (None, 7, "240101"), (None, 7, "240101")], "id string, price long, at string")
    for bucketed in (True, False):
        base = f"{tmp}/{bucketed}"
        write_json_drops(drops.coalesce(1), f"{base}/landing")
        ingest_drops(spark, f"{base}/landing", "id string, price long, at string", f"{base}/t", "id", "price", f"{base}/c", ["at"], bucketed=bucketed)
        table = read_bucketed(spark, f"{base}/t") if bucketed else spark.read.parquet(latest_version_path(spark, f"{base}/t"))
        assert sorted((r["id"] or "", r["price"]) for r in table.collect()) == [("", 7), ("", 7), ("1", 450)]


def test_overwrite_partitions_replaces_only_present(spark, tmp):
    from domus.sinks.writers import overwrite_partitions
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, d string")
    t.write.partitionBy("d").parquet(f"{tmp}/p")
    overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, d string"), f"{tmp}/p", ["d"])
    got = sorted((r["d"], r["v"]) for r in spark.read.parquet(f"{tmp}/p").collect())
    assert got == [("a", 1), ("b", 9), ("c", 3)]


def test_many_small_batches_do_not_rewrite_the_table(spark, tmp):
    import random

    from domus.sinks import buckets as B
    rng = random.Random(5)
    schema = "id long, price long, note string"
    want = {i: (i % 7, "old") for i in range(1200)}
    B.write_bucketed(spark.createDataFrame([(k, *v) for k, v in want.items()], schema).coalesce(1), f"{tmp}/t", "id")
    loose, came = [], 0
    for turn in range(12):
        batch = {k: (rng.choice([None, 1, 2, 3]) if k % 10 == 0 else rng.randrange(7), f"n{turn}") for k in rng.sample([*range(40), *range(1190, 1240)], 30)}
        B.merge_bucketed(spark, spark.createDataFrame([(k, *v) for k, v in batch.items()] + [(None, 1, f"x{turn}")], schema), f"{tmp}/t", "id", ("s", turn), order_by=["note"], price="price")
        loose.append((1, f"x{turn}"))
        came += 31
        for k, v in batch.items():  # merged in turn: an unchanged price keeps the stored row
            if k not in want or None in (v[0], want[k][0]) or v[0] != want[k][0]:
                want[k] = v
        if turn in (0, 3, 11):
            rows = B.read_bucketed(spark, f"{tmp}/t").collect()
            assert {r["id"]: (r["price"], r["note"]) for r in rows if r["id"] is not None} == want and len(rows) == len(want) + len(loose)
            assert sorted((r["price"], r["note"]) for r in rows if r["id"] is None) == sorted(loose)
    written = sum(spark.read.parquet(f"{tmp}/t/version={v:06d}").count() for v in range(13))
    assert written <= 1200 + 5 * came  # every batch used to write the table again: some 16,000 rows


def test_rows_of_old_folders_stay_out(spark, tmp):
    from domus.sinks import buckets as B
    of = lambda b, n: [i for i in range(4000) if keys[i] % n == b]
    keys = [r[0] for r in spark.range(4000).select(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(64))).collect()]
    want = {}

    def merge(ids, price):
        df = spark.createDataFrame([(i, price) for i in ids], "id long, price long")
        B.merge_bucketed(spark, df, f"{tmp}/t", "id", order_by=["price"], dedupe="latest", rows_per_bucket=30)
        want.update(dict.fromkeys(ids, price))

    merge(of(0, 8)[:10] + of(1, 8)[:60], 1)
    merge(of(0, 16)[:10], 2)
    merge(of(1, 8)[60:130], 3)
    merge(of(8, 16)[:12], 4)
    merge(of(0, 32)[:20], 5)
    rows = B.read_bucketed(spark, f"{tmp}/t").collect()
    assert {r["id"]: r["price"] for r in rows} == want and len(rows) == len(want)


def test_small_buckets_are_written_by_few_tasks_and_read_as_one_folder(spark, tmp, monkeypatch):
    from domus.sinks import buckets as B
    listed = []
    real = B.list_dir
    monkeypatch.setattr(B, "list_dir", lambda s, p: listed.append(p) or real(s, p))
    df = spark.range(3000).select("id", (F.col("id") % 5).alias("price"))
    assert B.write_bucketed(df, f"{tmp}/t", "id", 10) == 512
    rows = B.read_bucketed(spark, f"{tmp}/t")
    assert rows.count() == 3000 and not [p for p in listed if "version=" in p]
    files = spark.read.parquet(f"{tmp}/t/version=000000").select(F.input_file_name().alias("f"), "_bucket").distinct().collect()
    assert len({r["_bucket"] for r in files}) == len({r["f"] for r in files}) > 400
    tasks = {r["f"].rsplit("/", 1)[1][:10] for r in files}
    assert len(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert B.write_bucketed(df.where("id < 0"), f"{tmp}/none", "id", 10) == 1 and B.read_bucketed(spark, f"{tmp}/none").count() == 0
    B.merge_bucketed(spark, df.limit(3), f"{tmp}/none", "id", order_by=["price"], price="price")
    assert B.read_bucketed(spark, f"{tmp}/none").count() == 3
