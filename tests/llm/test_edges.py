"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for
every operator and every pipeline stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from domus.llm import ann, line_dedup, mixing, pieces, pii, quality, repeats, secrets, simhash, suffix_dedup, url_filter
from domus.llm import queries as Q
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(5)
PROSE = [" ".join(RNG.choice(["stone", "river", "cloud", "amber", "field", "lamp", "north", "quiet", "harbor", "window"]) + RNG.choice(["", "s", "ed", "ing"])
                  for _ in range(90)) + "." for _ in range(8)]
LONG = "\n".join(f"line {i} {RNG.random()} of a very long text." for i in range(6000))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Odd documents, stored so that they are read in the same order each time."""
    texts = [None, "", " \t\n", "a", "one two", PROSE[0], PROSE[0], PROSE[1], PROSE[2] + "\n" + PROSE[3], "x\n" + PROSE[2] + "\n" + PROSE[3],
             LONG, "ß\u00a0\u2028é 𝒳 漢字 \u0000 ▁▁ ﬁ", "a" * 5000, " " * 300 + "end", PROSE[4]]
    rows = [(i, t, "en", RNG.choice(["s1", "s2", "é"]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, PROSE[5], None, None, None), (None, None, None, None, None), (3, PROSE[6], "de", None, 9)]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


CLASHES = ["fp", "uid", "bid", "body", "n_words", "kept", "size", "row", "start", "place", "root", "tilt", "q_text", "m_id", "copy", "quality", "c0"]


@pytest.fixture(scope="module")
def clashing(odd, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clash") / "documents.parquet")
    odd.withColumns({c: F.lit(c) for c in CLASHES}).write.parquet(path)
    return spark.read.parquet(path)


OPERATORS = {
    "mix": lambda d: mixing.mix(d), "lay_out": lambda d: mixing.lay_out(d), "simhash": lambda d: simhash.near_duplicates(d),
    "one_of_each": lambda d: simhash.drop_near_duplicates(d), "strings": lambda d: suffix_dedup.remove_repeated_strings(d),
    "secrets": lambda d: secrets.scan_secrets(d), "redact": lambda d: secrets.redact(d), "lines": lambda d: line_dedup.dedup_lines(d),
    "line_report": lambda d: line_dedup.dedup_lines(d, report=True), "pii": lambda d: pii.pseudonymise(d, b"k"),
    "pieces": lambda d: pieces.digests(d, Q.tokenizer_path()), "encode": lambda d: pieces.encode_documents(d, Q.tokenizer_path()),
    "quality": lambda d: quality.judge(d)[0], "keep_good": lambda d: quality.keep_good(d),
    "urls": lambda d: url_filter.filter_urls(d, "doc_id", "text"),
}
ROW_FOR_ROW = {"mix", "simhash", "strings", "secrets", "redact", "lines", "line_report", "pii", "pieces", "encode", "quality", "urls"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, name):
    n = OPERATORS[name](odd).count()
    assert n == odd.count() if name in ROW_FOR_ROW else 0 < n <= 3 * odd.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(odd, clashing, name):
    plain, clash = OPERATORS[name](odd), OPERATORS[name](clashing)
    assert plain.count() == clash.count()
    kept = [c for c in CLASHES if c in clash.columns and c not in plain.columns]
    for c in kept:  # the input's own columns stay as they are
        assert {r[0] for r in clash.select(c).distinct().collect()} == {c}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, odd, empty, clashing, stage):
    name, run = stage
    for docs in (odd, empty, clashing):
        out = run(spark, docs, "")
        assert (out.count() == 0) == (docs is empty)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_simhash_of_odd_rows(odd):
    rows = odd.select("doc_id", "text").collect()
    fps = [brute.simhash(r[1]) for r in rows]
    want = sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, brute.components(fps, [r[0] for r in rows]))), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(odd).collect()), key=str) == want
    # parts of any size and routes of any number of blocks find the same links
    assert sorted(map(tuple, simhash.near_duplicates(odd, part=2).collect()), key=str) == want
    assert sorted(map(tuple, simhash.near_duplicates(odd, shared=3).collect()), key=str) == want


def test_strings_of_odd_rows(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    for hot in (10, 0):
        done = suffix_dedup.remove_repeated_strings(odd, hot=hot).collect()
        got = sorted(((r[0], r[1], r[1] - len(r[3]), len(r[2]) // 16, brute.sha(bytes(r[3]))) for r in done), key=str)
        assert got == sorted(brute.repeated_strings(rows), key=str)


def test_a_phrase_between_different_neighbours_is_hot(spark):
    """A 60-byte phrase in every row: as many different contents as rows, in few batches."""
    rng = random.Random(3)
    noise = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=150))
    phrase = noise()[:60]
    rows = [(i, noise() + phrase + noise()) for i in range(600)]
    rows += [(1000 + i, rows[0][1] + rows[1][1]) for i in range(300)] + [(2000, noise() * 3000), (2001, None), (None, phrase)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    batches = repeats.in_batches(df, "doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert batches.select("bid").distinct().count() == 5  # 903 rows, and the long one by itself
    flags = b"".join(bytes(r["flags"]) for r in repeats.repeated_keys(batches, suffix_dedup._keys, 3, 400).collect())
    assert repeats.HOT in flags
    want = sorted(brute.repeated_strings(rows), key=str)
    for hot in (400, repeats.HOT_ENTRIES):
        done = suffix_dedup.remove_repeated_strings(df, hot=hot).collect()
        assert sorted(((r[0], r[1], r[1] - len(r[3]), len(r[2]) // 16, brute.sha(bytes(r[3]))) for r in done), key=str) == want


def test_nulls_and_empties_are_defined(odd):
    null = [r for r in secrets.scan_secrets(odd).collect() if r["doc_id"] in (0, 1)]
    assert all(r["spans"] == [] for r in null)
    assert {r["text"] for r in pii.pseudonymise(odd, b"k").where("doc_id = 0").collect()} == {None}
    assert {(r["n_tokens"], r["decoded_sha256"]) for r in pieces.digests(odd, Q.tokenizer_path()).where("doc_id in (0, 1)").collect()} == {(0, brute.sha(""))}
    assert {r["taken"] for r in mixing.mix(odd).where("doc_id in (0, 1, 2)").collect()} == {0}
    assert {r["kept"] for r in quality.judge(odd)[0].where("doc_id in (0, 1, 2)").collect()} == {False}


def test_vectors(spark):
    vectors = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
               (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [3.0, 3.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (6, [1.0, 0.0]), (40, [1.0, 1.0, 1.0]), (60, None)]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, code string")
    got = {}
    for r in ann.nearest_neighbours(df, slice_rows=4, block_queries=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute.nearest(vectors)
    assert ann.nearest_neighbours(df.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://x.com/fr/", "http://x.com/de/a",
            "http://org/", "http://org", "http://borg/", "ftp://x.org:80/", "a://b://c/d", "http://www.spam-farm.net/x", "http://é.org/é\n/x", "http://x.com/fr"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(4, urls[4], "h")], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[5][2:] == ("example.org/en/1", "block") and got[6][2:] == ("com/fr/", "allow") and got[7][2:] == ("com/de/", "block")
    assert got[8] == ("org", "/", "org/", "allow") and got[9][2] is None and got[10][2] is None and got[11][:3] == ("x.org:80", "/", None)
    assert got[12][:2] == ("b:", "//c/d") and got[13][2:] == (None, "block") and got[14][:3] == ("é.org", "/é\n/x", "org/") and got[15][2] is None
    assert url_filter.filter_urls(df).count() == len(urls) + 1
