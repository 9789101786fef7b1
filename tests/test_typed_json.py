"""Schemas found in the data, and profiles that merge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.operators import sketches as S
from domus.sources.readers import typed_json, typed_object_of_records


def test_documents_of_different_fields(spark):
    texts = ['{"id": 1, "price": 2.5, "a": {"x": 1}}', '{"id": 3000000000, "t": "v", "a": {"y": null}}', '{"id": 2, "price": 7, "a": null}', "[1]", "{broken", None, '"text"', '{"mixed": 1}', '{"mixed": "s"}']
    df = typed_json(spark.createDataFrame([(t,) for t in texts], "doc string"), "doc")
    assert dict(df.dtypes) == {"a": "struct<x:bigint,y:string>", "id": "bigint", "mixed": "string", "price": "double", "t": "string"}
    rows = {r["id"]: r for r in df.collect() if r["id"] is not None}
    assert rows[1]["price"] == 2.5 and rows[2]["price"] == 7.0 and rows[3000000000]["t"] == "v" and rows[1]["a"]["x"] == 1
    assert sorted(r["mixed"] for r in df.collect() if r["id"] is None) == ["1", "s"]
    for nothing in ([], [("{broken",)], [(None,)]):
        empty = spark.createDataFrame(nothing, "doc string")
        assert typed_json(empty, "doc").columns == [] and typed_object_of_records(empty, "doc").columns == ["id"]


def test_objects_of_many_records(spark):
    df = spark.createDataFrame([('{"a": {"p": 1}, "b": {"p": 2.5, "q": "x"}}',), ('{"c": {"q": "y"}, "d": 5}',)], "doc string")
    got = {r["id"]: (r["p"], r["q"]) for r in typed_object_of_records(df, "doc").collect()}
    assert got == {"a": (1.0, None), "b": (2.5, "x"), "c": (None, "y")}


def test_merged_profile_is_near_the_exact_one(spark):
    rng = np.random.default_rng(2)
    x = rng.lognormal(0, 2, 6000)
    df = spark.createDataFrame([(float(v) if i % 10 else None, float(i % 50), i % 4) for i, v in enumerate(x)], "x double, y double, part int")
    parts = [S.sketch_columns(df.where(F.col("part") == i), ["x", "y"]) for i in range(4)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = {r["column_name"]: r for r in S.read_sketches(S.merge_sketches(rows)).collect()}
    kept = np.array([v for i, v in enumerate(x) if i % 10])
    r = got["x"]
    assert (r["rows"], r["known"], r["missing"], r["lo"], r["hi"]) == (6000, 5400, 600, kept.min(), kept.max())
    assert abs((kept <= r["p50"]).mean() - 0.5) < 3 * 1.8 / S.K and r["n_distinct"] == pytest.approx(5400, rel=3 * 1.04 / 2 ** (S.LG / 2))
    assert abs(got["y"]["n_distinct"] - 50) <= 1
    nothing = S.read_sketches(S.merge_sketches(S.sketch_columns(df.where("part > 9"), ["x"]))).first()
    assert nothing["known"] == 0 and nothing["p50"] is None
