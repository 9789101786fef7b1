"""Schema and column operators on nested listing-like documents."""

import json

import pytest
from pyspark.sql import functions as F

from domus.operators import columns as C

DOC = {
    "listingCard": {"size": "L"},
    "listing": {
        "localization": {"de": {"text": {"title": "T", "description": "D"},
                                "attachments": [{"file": "a"}, {"file": "b"}]}, "primary": "de"},
        "characteristics": {"numberOfRooms": 3.5, "yearBuilt": 1990, "hasLift": True},
        "address": {"geoDistances": [{"distance": float(i), "geoTag": f"g{i}"} for i in range(10)],
                    "geoCoordinates": {"latitude": 46.9, "longitude": 7.4}},
        "platforms": ["p1", "p2", "p3", "p4", "p5"],
        "publishers": [{"id": "x", "options": [{"key": f"k{i}"} for i in range(13)]}],
        "prices": {"currency": "CHF", "buy": {"price": 570000}},
        "id": "42",
    },
    "id": "42",
    "paused": False,
}


@pytest.fixture()
def doc(spark, tmp):
    p = f"{tmp}/doc.json"
    with open(p, "w") as f:
        json.dump([DOC], f)  # one array on one line → one row per element
    return spark.read.json(p)


def test_flatten_structs_keeps_rows_and_arrays(doc):
    flat = C.flatten_structs(doc)
    assert flat.count() == 1
    assert "listing_prices_buy_price" in flat.columns
    assert "listing_address_geoCoordinates_latitude" in flat.columns
    assert dict(flat.dtypes)["listing_platforms"].startswith("array")
    r = flat.first()
    assert r["listing_prices_buy_price"] == 570000 and len(r["listing_platforms"]) == 5


def test_flatten_drop_after_naming(doc):
    flat = C.flatten_structs(doc, drop=["listing_localization_de_attachments", "listingCard_size"])
    assert "listing_localization_de_attachments" not in flat.columns and "listingCard_size" not in flat.columns


def test_flatten_explode_counts(doc):
    one = C.flatten_explode(doc, explode=["listing_address_geoDistances"])
    assert one.count() == 10
    two = C.flatten_explode(doc, explode=["listing_address_geoDistances", "listing_platforms"])
    assert two.count() == 50
    opts = C.flatten_explode(doc, explode=["listing_publishers"])
    assert opts.count() == 13 and "listing_publishers_options_key" in opts.columns


def test_flatten_explode_outer_keeps_empty(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [1, 2])], "id int, xs array<int>")
    assert C.flatten_explode(df).count() == 4


def test_name_collision_raises(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b: int>")
    with pytest.raises(ValueError):
        C.flatten_structs(df)
    with pytest.raises(ValueError):
        C.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, ab int"))


def test_clean_lower_prefix_rename(spark):
    df = spark.createDataFrame([(1, 2)], "`Cust Key` int, `x=(y)` int")
    assert C.clean_names(df).columns == ["CustKey", "xy"]
    assert C.lower_names(C.clean_names(df)).columns == ["custkey", "xy"]
    assert C.prefix_names(df, "p_").columns == ["p_Cust Key", "p_x=(y)"]
    assert C.rename(df, lambda c: c.upper()).columns == ["CUST KEY", "X=(Y)"]
    assert C.rename(df, ["f0", "f1"]).columns == ["f0", "f1"]


def test_fill_and_numeric_parse(spark):
    df = spark.createDataFrame([(1, None, "a", "1"), (2, 4.0, None, "2"), (3, float("nan"), "c", "x")],
                               "k int, v double, t string, n string")
    filled = {r["k"]: r for r in C.fill_constant(df).collect()}
    assert filled[1]["v"] == 0 and filled[2]["t"] == "None" and filled[3]["v"] == 0
    mean = {r["k"]: r["v"] for r in C.fill_mean(df, subset=["v"]).collect()}
    assert mean[1] == 4.0 and mean[3] == 4.0
    parsed = C.numeric_if_all_parse(df.where("k < 3"), subset=["n"])
    assert dict(parsed.dtypes)["n"] == "bigint"
    kept = C.numeric_if_all_parse(df, subset=["n"])
    assert dict(kept.dtypes)["n"] == "string"


def test_dummies_null_all_zero_and_baseline(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, c string")
    d = C.dummies(df)
    assert sorted(d.columns) == ["c_a", "c_b", "k"]
    assert d.where("k = 3").first().asDict() == {"k": 3, "c_a": 0, "c_b": 0}
    assert C.dummies(df, ["c"], drop={"c": "a"}).columns == ["k", "c_b"]
    train_vals = C.dummy_values(df, ["c"])
    test = spark.createDataFrame([(9, "z")], "k int, c string")
    assert C.dummies(test, ["c"], values=train_vals).first().asDict() == {"k": 9, "c_a": 0, "c_b": 0}


def test_enrich_creates_struct(spark):
    df = spark.createDataFrame([(1, None)], "id int, propertyDetails struct<a: int>")
    out = C.enrich(df, "propertyDetails", {"searchCity": F.lit("bern"), "isBuyRent": F.lit("buy")}).first()
    assert out["propertyDetails"]["searchCity"] == "bern"
    out2 = C.enrich(df.drop("propertyDetails"), "propertyDetails", {"x": F.lit(1)}).first()
    assert out2["propertyDetails"]["x"] == 1


def test_select_by_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, d double")
    assert C.select_by_type(df, "string", keep=["k"]).columns == ["k", "s"]
    assert C.select_by_type(df, "number").columns == ["k", "d"]


def test_nested_lists_and_search_key(spark):
    from domus.functions.scalar import search_key
    from domus.operators.setops import flatten_lists
    df = spark.createDataFrame([([[12, 7], [31, 408, 5, 90210, 6], [77, 2]],)], "xs array<array<int>>")
    assert len(df.select(flatten_lists("xs").alias("f")).first()["f"]) == 9
    s = spark.createDataFrame([("Oslo", "town-house", 5, "rent"), ("Lund", "town-house", 5, "rent")],
                              "city string, propertyType string, radius int, rentOrBuy string")
    keys = [r[0] for r in s.select(search_key("city", "rentOrBuy", "propertyType", "radius")).collect()]
    assert keys == ["oslo_rent_town_house_5", "lund_rent_town_house_5"]


def test_valid_json_and_quarantine(spark):
    from domus.operators.filters import quarantine, valid_json
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": 1'), (3, None)], "k int, t string")
    assert [r[0] for r in valid_json(df, "t").collect()] == [1]
    q = quarantine(df, {"has_text": F.col("t").isNotNull(), "small": F.col("k") < 3})
    got = {r["k"]: (r["ok"], r["reasons"]) for r in q.collect()}
    assert got[1] == (True, []) and got[3] == (False, ["has_text", "small"])


def test_bins_right_closed(spark):
    from domus.functions.scalar import bin_right_closed
    df = spark.createDataFrame([(0.0,), (0.5,), (4.0,), (4.01,), (48.0,), (49.0,)], "x double")
    got = [r[0] for r in df.select(bin_right_closed("x", [0.0, 4.0, 8.0, 48.0])).collect()]
    assert got == [None, 0, 0, 1, 2, None]


def test_flatten_explode_prefix(doc):
    out = C.flatten_explode(doc, explode=["listing_platforms"], prefix="listing")
    assert out.count() == 5 and all(c.startswith("listing") for c in out.columns)


def test_dummies_of_any_cardinality(spark):
    df = spark.range(0, 2000).select("id", F.concat(F.lit("v"), "id").alias("c"))
    assert len(C.dummy_values(df, ["c"])["c"]) == 2000
    long = C.dummy_long(df.union(spark.createDataFrame([(5000, None)], "id long, c string")), "id", ["c"])
    assert long.count() == 2000 and long.where("id = 7").first()["value"] == "v7"


def test_deep_nesting(spark):
    value, kind = "x", "string"
    for _ in range(17):
        value, kind = [value], f"array<{kind}>"
    df = spark.createDataFrame([(1, value)], f"id int, a {kind}")
    assert [tuple(r) for r in C.flatten_explode(df).collect()] == [(1, "x")]


def test_numbers_have_no_suffix(spark):
    df = spark.createDataFrame([("12d", "1e3", "7"), ("5f", " 2.5 ", None)], "a string, b string, c string")
    assert [t for _, t in C.numeric_if_all_parse(df).dtypes] == ["string", "double", "bigint"]

