"""The numbered queries against SQL or brute force on the small tables, and the operators' inner workings."""

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from domus.llm import ann, line_dedup, mixing, pieces, pii, quality, repeats, secrets, simhash, suffix_dedup, url_filter
from domus.llm import queries as Q
from domus.llm.components import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def collected(spark, name):
    return Q.queries()[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.queries()[name](spark, SF)
    cur = con.execute(Q.oracle_sql()[name])
    assert [d[0] for d in cur.description] == df.columns
    assert Counter(map(tuple, df.collect())) == Counter(cur.fetchall())


# ---- 1 ----

def test_rules_are_found_by_one_token_and_none_is_missed(spark):
    rng = random.Random(1)
    parts = ["spam", "farm", "casino", "wiki", "org", "example", "com", "fr", "es", "en", "1", "exe", "adult", "education", "xxx"]
    urls = ["http://" + ".".join(rng.sample(parts, 3)) + "/" + "/".join(rng.sample(parts, 3)) + rng.choice(["", "?a=spam", ".exe"]) for _ in range(300)]
    got = {r["url"]: (r["n_block"], r["n_allow"], r["label"]) for r in url_filter.judge_urls(
        spark.createDataFrame([(u,) for u in urls], "url string"), "url", url_filter.HOST_RULES + url_filter.PATTERN_RULES).collect()}
    for u in set(urls):
        n = Counter(r.verdict for r in url_filter.PATTERN_RULES if re.search(r.regex, u.lower()))
        host, _, path = u[7:].partition("/")
        site = host + "/" + re.split("[?#]", path)[0]
        labels = [r.label for r in url_filter.HOST_RULES if re.search(r.regex, site)]
        want = (n["block"], n["allow"], max(labels, key=len, default=None))
        assert got.get(u, (0, 0, None)) == want


# ---- 2 ----

@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=30))
def test_targets(sizes):
    named = [(str(i), n) for i, n in enumerate(sizes)]
    got = mixing.targets(named)
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    # filling step by step until no source is above its cap
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        share = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / share > 3 * sizes[i]}
        if not over:
            for i in free:
                target[i] = left * weights[i] / share
            break
        for i in over:
            target[i] = 3.0 * sizes[i]
        left -= sum(3 * sizes[i] for i in over)
        free -= over
    assert got == pytest.approx(target, rel=1e-9, abs=1e-6)
    assert all(t <= 3 * n + 1e-6 for t, n in zip(got, sizes))


def test_mix_takes_the_targets(spark):
    by: dict = {}
    for r in collected(spark, "op2_mixing"):
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) < 1 for (_, target), t in by.items())


def test_lay_out_follows_the_schedules(spark):
    df = spark.createDataFrame([(i, "w " * 10, f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    out = [r["source"] for r in mixing.lay_out(df).collect()]
    share = Counter(out)
    assert share["s0"] > 1.8 * share["s1"] > 2.5 * share["s2"] and abs(len(out) - 300) <= 3
    half = len(out) // 2  # s0 and s2 rise, s1 falls
    assert Counter(out[:half])["s1"] > Counter(out[half:])["s1"] and Counter(out[:half])["s0"] < Counter(out[half:])["s0"]


# ---- 3 ----

def test_simhash_query(spark, docs):
    fps = [brute.simhash(t) for _, t in docs]
    want = {(i, f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, brute.components(fps, [i for i, _ in docs]))}
    assert {tuple(r) for r in collected(spark, "op3_simhash")} == want


def test_simhash_routes(spark, docs):
    assert [simhash.shared_blocks(n) for n in (0, 10**6, 10**9, 10**11)] == [1, 1, 2, 3]
    rng = random.Random(7)
    for shared in (1, 2, 3, 4):
        masks = simhash.routes(4, shared)
        assert len(masks) == len(set(masks)) == math.comb(4 + shared, shared)
        for _ in range(200):  # codes at 4 differing bits agree on a route
            differ = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(differ & m == 0 for m in masks)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {tuple(r) for r in collected(spark, "op3_simhash")}
    assert {tuple(r) for r in simhash.near_duplicates(df, shared=2).collect()} == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=60), st.integers(0, 2**32))
def test_gray_index_finds_every_pair(seeds, seed):
    rng = random.Random(seed)
    near = [s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1) for s in seeds]
    codes = np.unique(np.array(seeds + near, np.uint64))
    groups = np.sort(np.array([rng.randrange(2) for _ in codes]))
    groups = np.unique(groups, return_inverse=True)[1]
    index = simhash.GrayIndex(codes, groups)
    u, v = index.search(0, len(codes), 4)
    got = {frozenset((int(index.codes[a]), int(index.codes[b]))) for a, b in zip(u, v)}
    want = {frozenset((int(codes[a]), int(codes[b]))) for a in range(len(codes)) for b in range(a)
            if groups[a] == groups[b] and (int(codes[a]) ^ int(codes[b])).bit_count() <= 4}
    assert got == want and len(u) == len(got)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {201: 200}


def test_one_document_of_each_group_stays(spark, docs):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()}
    assert left == {r["component_id"] for r in collected(spark, "op3_simhash")}


# ---- 4 ----

def test_nearest_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    want, got = brute.nearest(rows), {}
    for r in sorted(collected(spark, "op4_nearest"), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    found = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert set(got) == set(want) and found >= 0.9 * sum(map(len, want.values()))


def test_bounds_hold():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((2000, 96))
    turn = ann.rotation(96)
    assert np.allclose(turn @ turn.T, np.eye(96))
    import pyarrow as pa
    code, norm, align = ann.encode(vectors, turn)
    table = pa.table({"vec_id": range(2000), "code": pa.array([c.tobytes() for c in code], pa.binary()), "norm": norm, "align": align,
                      "vector": pa.array(vectors.tolist(), pa.list_(pa.float64()))})
    codes = ann.CodeSlice(table)
    outside = 0
    for q in rng.standard_normal((20, 96)):
        estimate, upper = codes.bounds(q, turn)
        outside += int((vectors @ q > upper).sum())
        assert np.corrcoef(estimate, vectors @ q)[0, 1] > 0.75
    assert outside < 0.005 * 20 * 2000


def test_few_candidates_are_all_found(spark):
    """21 vectors: every query gets all 20 others, with their exact products, whatever the estimates."""
    rng = np.random.default_rng(4)
    rows = [(20 * i, (rng.standard_normal(8) * 10.0 ** rng.integers(-3, 3)).tolist()) for i in range(21)]
    got: dict = {}
    for r in ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute.nearest(rows)
    for q, _ in rows:
        assert sorted(got[q]) == [(k + 1, i, pytest.approx(s, rel=1e-12)) for k, (i, s) in enumerate(want[q])]


# ---- 5 ----

def test_repeated_strings_query(spark, docs):
    assert {tuple(r) for r in collected(spark, "op5_repeated_strings")} == set(brute.repeated_strings(docs))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=400), max_size=4), st.integers(0, 2**32))
def test_each_string_is_in_one_phrase_and_copies_share_its_key(bodies, seed):
    rng = random.Random(seed)
    bodies = bodies + [bytes(rng.choice(b"ab") for _ in range(350)), b"a" * 250]
    copy = bodies[-2][30:300]
    bodies.append(b"x" * rng.randrange(90) + copy + b"tail")
    key_of: dict[bytes, int] = {}
    strings = 0
    for doc, first, last, keys in suffix_dedup.phrases(bodies):
        for d, a, b, k in zip(doc.tolist(), first.tolist(), last.tolist(), keys.tolist()):
            for p in range(a, b + 1):
                strings += 1
                assert key_of.setdefault(bodies[d][p:p + 100], k) == k
    assert strings == sum(max(0, len(b) - 99) for b in bodies)


def test_later_strings():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(300))
    contents = [text[:180], text[40:200], b"z" * 120, text[:180]]
    got = suffix_dedup.later_strings(contents)
    seen: set = set()
    for c, offsets in zip(contents, got):
        want = []
        for i in range(len(c) - 99):
            if c[i:i + 100] in seen:
                want.append(i)
            seen.add(c[i:i + 100])
        assert offsets.tolist() == want


def test_parts_shared_with_an_earlier_entry():
    rng = random.Random(11)
    texts = [bytes(rng.choice(b"ab") for _ in range(40)) for _ in range(6)]
    bodies = [b"".join(rng.choice(texts) for _ in range(8)) for _ in range(30)]
    entries: dict[tuple, None] = {}
    for doc, first, last, keys, place in suffix_dedup.triggered(bodies):
        for d, a, b, k, t in zip(doc.tolist(), first.tolist(), last.tolist(), keys.view(np.int64).tolist(), place.tolist()):
            entries.setdefault((k, t - a, bodies[d][a:b + 100]))
    keys, triggers, contents = (list(x) for x in zip(*entries))
    got: dict[int, set] = {}
    for n, s, e in zip(*(x.tolist() for x in suffix_dedup.later_parts(contents, np.array(keys), np.array(triggers)))):
        got.setdefault(n, set()).update(range(s, e))
    seen: set = set()
    for n, c in enumerate(contents):
        grams = [(keys[n], c[i:i + 100]) for i in range(len(c) - 99)]
        assert got.get(n, set()) == {j for i, g in enumerate(grams) if g in seen for j in range(i, i + 100)}
        seen.update(grams)
    assert got


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 20)), max_size=20))
def test_merge_spans(spans):
    s, e = np.array([a for a, _ in spans], np.int64), np.array([a + n for a, n in spans], np.int64)
    x, y = repeats.merge_spans(s, e)
    covered = {i for a, n in spans for i in range(a, a + n)}
    assert {i for a, b in zip(x, y) for i in range(a, b)} == covered and all(a > b for a, b in zip(x[1:], y))


# ---- 6 ----

def test_secrets_query(spark, docs):
    got = {tuple(r)[:5] for r in collected(spark, "op6_secrets")}
    assert got == {(i, *brute.base_secrets(t)) for i, t in docs}


@given(st.text(alphabet="AKIA01bcdef:=\"' .tokenPASSWDsecrtpi_ſK", max_size=120))
def test_base_secrets(text):
    spans = sorted(secrets.base_spans(text), key=lambda s: (s[0], secrets.KINDS.index(s[2])))
    assert brute.sha(",".join(f"{k}:{a}:{b}" for a, b, k in spans)) == brute.base_secrets(text)[3]


@given(st.text(alphabet="abcdef0123456789", min_size=0, max_size=80), st.integers(2, 24))
def test_entropy_windows(text, width):
    def entropy(s):
        return -sum(c / len(s) * np.log2(c / len(s)) for c in Counter(s).values())
    least = 2.5
    covered = {j for i in range(len(text) - width + 1) if entropy(text[i:i + width]) >= least - 1e-9 for j in range(i, i + width)}
    got = list(secrets.windows_above(text, width, least))
    assert {i for a, b in got for i in range(a, b)} == covered


def test_entropy_finds_and_the_allow_list_suppresses():
    found = secrets.entropy_spans("key Xk29dLq0ZzPw83mNvB7tYhR5 and 123e4567-e89b-12d3-a456-426614174000 and ThisIsExample1ThisIsExample2Xk29dLq")
    assert [k for _, _, k in found] == ["entropy_base64"]


def brute_entropy(text):
    """Ranges of entropy spans, window by window."""
    out = []
    for kind, candidates, width, least, holds in secrets.CLASSES:
        for m in candidates.finditer(text):
            if not holds.match(m[0]) or any(a.search(m[0]) for a in secrets.ALLOW):
                continue
            hot = set()
            for i in range(len(m[0]) - width + 1):
                n = Counter(m[0][i:i + width])
                if -sum(c / width * math.log2(c / width) for c in n.values()) >= least - 1e-9:
                    hot |= set(range(m.start() + i, m.start() + i + width))
            for j in sorted(hot):
                if j - 1 not in hot:
                    end = next(e for e in range(j, len(text) + 1) if e not in hot)
                    out.append((j, end, kind))
    return sorted(out)


@given(st.lists(st.sampled_from(["A", "a", "0", "f", "iVBORw0KGgo1", "A" * 40, "0" * 25, "f0e1", "b2", " ", "Xk29dLq0ZzPw83mNvB7tYhR5", "3ax6xnjp29jd6fds4gc373sgvjxteol0", "KEY7QWERT2YUIOPASDFGHJKLZXC", "-", "="]), max_size=12).map("".join))
def test_entropy_spans_equal_plain_windows(text):
    merged = []
    for s_, e, k in sorted(secrets.entropy_spans(text), key=lambda s: (s[2], s[0])):
        if merged and merged[-1][2] == k and s_ <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]), k)
        else:
            merged.append((s_, e, k))
    plain = []
    for s_, e, k in sorted(brute_entropy(text), key=lambda s: (s[2], s[0])):
        if plain and plain[-1][2] == k and s_ <= plain[-1][1]:
            plain[-1] = (plain[-1][0], max(e, plain[-1][1]), k)
        else:
            plain.append((s_, e, k))
    assert merged == plain


def test_tokens_of_one_case_and_runs_of_one_character():
    assert [k for _, _, k in secrets.entropy_spans("key-3ax6xnjp29jd6fds4gc373sgvjxteol0 ")] == ["entropy_base36"]
    for text in ("iVBORw0KGgo1" + "A" * 40 + "b2", "a" + "0" * 25 + "1", "f0e1" + "0" * 30):
        secrets.entropy_spans(text)


# ---- 7 ----

def test_line_query(spark, docs):
    """The report's chunks are those of the text; one counts as removed if its lines are."""
    got = {r["doc_id"]: r for r in collected(spark, "op7_line_dedup")}
    for i, text in docs:
        lines, chunks = line_dedup.line_chunks((text or "").encode())
        r = got[i]
        assert (r["n_lines"], r["n_chunks"]) == ((len(lines), len(chunks)) if text is not None else (0, 0))
        assert r["n_removed_chunks"] <= sum(b - a >= 2 for a, b in chunks) and (r["n_removed_chunks"] == 0 or r["n_removed_lines"] >= 2)
    assert any(r["n_removed_chunks"] for r in got.values())


def test_blank_lines_are_no_passage(spark):
    rows = [(1, "a\n\n\nb"), (2, "x1\n\n\nx2\n\n\nx3"), (3, "x2\n\n\nx3\n\n \nend"), (4, "x2\n\nx3"), (5, "\n\n\n")]
    got = {r["doc_id"]: r["kept"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    assert got == {1: "a\n\n\nb", 2: "x1\n\n\nx2\n\n\nx3", 3: "\n \nend", 4: "x2\n\nx3", 5: "\n\n\n"}


def test_line_query_removes_every_run(spark, docs):
    got = {(r["doc_id"], r["n_lines"], r["n_removed_lines"], r["kept_sha256"]) for r in collected(spark, "op7_line_dedup")}
    assert got == {(i, n, gone, brute.sha(kept)) for i, n, gone, kept in brute.repeated_lines(docs)}


def test_passages_go_from_their_first_line_to_their_last(spark):
    rng = random.Random(8)
    passages = [[f"passage {p} line {j}" for j in range(2 + p % 5)] for p in range(12)]
    rows = []
    for i in range(900):  # over several batches; one passage stands in a third of the rows
        own = [f"{i} {rng.random()}" for _ in range(rng.randrange(4))]
        text = own[:1] + (passages[0] if i % 3 == 0 else []) + own[1:] + rng.choice(passages) + own[3:]
        rows.append((rng.choice([None, i, i // 2]), "\n".join(text)))
    rows += [(950, ""), (951, None), (952, "one line"), (953, "one line"), (954, "x\nx\nx\nx"), (955, "\n\n"), (956, "a\n\n\n\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    rows = [tuple(r) for r in df.collect()]
    got = sorted(((r["doc_id"], r["n_lines"], r["n_removed_lines"], r["kept"]) for r in line_dedup.dedup_lines(df, report=True).collect()), key=str)
    assert got == sorted(brute.repeated_lines(rows), key=str)
    texts = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df).collect())
    assert texts == Counter((w[0], w[3] if r[1] is not None else None) for r, w in zip(rows, brute.repeated_lines(rows)))


def test_chunks_resist_shifts():
    rng = random.Random(4)
    lines = [f"{rng.random()}".encode() for _ in range(200)]
    plain = {c for _, c in line_dedup.multi_line_chunks(b"\n".join(lines))}
    moved = {c for _, c in line_dedup.multi_line_chunks(b"\n".join([b"new", b"lines", *lines[3:]]))}
    assert len(plain & moved) >= len(plain) - 3


@pytest.mark.parametrize("run", [line_dedup.dedup_lines, simhash.drop_near_duplicates], ids=["lines", "near"])
def test_splits_may_change_between_jobs(spark, tmp_path, run):
    """As when executors come or go: the scan that applies what was decided has other splits."""
    rng = random.Random(9)
    texts = [f"{rng.random()} {rng.random()}\n{rng.random()} {rng.random()} {rng.random()}" for _ in range(60)]
    rows = [(i, f"{texts[rng.randrange(60)]}\nown {i} {rng.random()}" if i % 2 else texts[rng.randrange(60)], f"s{i % 3}") for i in range(300)] + [(None, texts[0], "s")] * 2
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7).write.parquet(path)
    splits = "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(splits, "1")
        want = sorted(map(tuple, run(spark.read.parquet(path)).collect()), key=str)
        out = run(spark.read.parquet(path))
        spark.conf.set(splits, "64")
        assert sorted(map(tuple, out.collect()), key=str) == want
        assert 0 < len(want) <= len(rows)
    finally:
        spark.conf.unset(splits)


# ---- 8 ----

def test_pseudonyms_of_the_table(spark, docs):
    for r, (i, text) in zip(sorted(collected(spark, "op8_pseudonyms"), key=lambda r: r["doc_id"]), docs):
        built, done = [], 0
        for s in r["pii"]:
            built += [text[done:s["start"]], s["pseudonym"]]
            done = s["end"]
        assert r["doc_id"] == i and r["text"] == "".join(built) + text[done:]


def test_pseudonyms_keep_format_and_links():
    names = pii.Pseudonyms(b"k")
    text = ("mail Ann.Lee-9@mail.example.com, card 4111 1111 1111 1111 or 378282246310005, not 4111111111111112, ip 10.0.0.7 not 300.1.1.1, "
            "ssn 078-05-1120 not 000-12-3456, iban DE89 3704 0044 0532 0130 00, born 1984-02-29 or 3.12.1999 not 2023-02-30, call +1 (212) 555-0187")
    new, spans = names.replace(text)
    assert [s[0] for s in spans] == ["email", "card", "card", "ip", "ssn", "iban", "date", "date", "phone"]
    for kind, a, b, p in spans:
        old = text[a:b]
        assert p != old and (len(p) == len(old) or kind in ("ip", "date"))
        again, more = names.replace(f"elsewhere: {old} !")
        assert again == f"elsewhere: {p} !" and more[0][0] == kind
        assert names.replace(f"elsewhere: {p} !")[1][0][0] == kind  # as valid as the original
    assert "4111111111111112" in new and "300.1.1.1" in new and "000-12-3456" in new and "2023-02-30" in new
    assert pii.Pseudonyms(b"other").replace(text)[0] != new


def test_phones_beside_other_numbers():
    new, spans = pii.Pseudonyms(b"k").replace("Des +1 (826) 555-4081 190.137.223.204 d +44 20 7946 0958, 9400000000000003")
    assert [s[0] for s in spans] == ["phone", "ip", "phone"] and new.endswith("9400000000000003")


@given(st.integers(1, 10**30), st.data())
def test_permutation(n, data):
    p = pii.Permutation(b"k", "card")
    x = data.draw(st.integers(0, n - 1))
    assert 0 <= p(x, n) < n and p.inverse(p(x, n), n) == x


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_permutation_is_one_to_one(n):
    p = pii.Permutation(b"k", "date")
    assert sorted(p(x, n) for x in range(n)) == list(range(n))


def test_letters_outside_a_to_z_stay_apart():
    """Every local part of the form jo?n@x.org has a pseudonym of its own, of the same form."""
    p = pii.Pseudonyms(b"k")
    letters = [chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha() and chr(c).islower()]
    out = [p._chars("email", f"jo{c}n") for c in letters]
    assert len(set(out)) == len(letters) and all(len(x) == 4 and x[2].islower() and not x[2].isascii() for x in out)


class PlainFeistel:
    """The permutation written out plainly: ten or so rounds over two halves, walking until inside."""

    def __init__(self, secret, name):
        self.key, self.name = hashlib.blake2b(secret, digest_size=32).digest(), name

    def __call__(self, x, n):
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while n > 1:
            left, right = divmod(x, 1 << bits)
            for i in range(pii.ROUNDS):
                data = b"".join(hashlib.blake2b(f"{self.name}|{n}|{i}|{right}|{k}".encode(), key=self.key, digest_size=64).digest() for k in range(0, -(-bits // 512) * 64, 64))
                left, right = right, left ^ (int.from_bytes(data, "big") & mask)
            x = (left << bits) + right
            if x < n:
                break
        return x


def test_permutation_equals_a_plain_one():
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 97, 365, 10**6, 26**7, 10**40, 36**120):
        fast, plain = pii.Permutation(b"key", "date"), PlainFeistel(b"key", "date")
        for x in {0, n - 1, *(rng.randrange(n) for _ in range(20))}:
            assert fast(x, n) == plain(x, n) and fast.inverse(fast(x, n), n) == x
        if n <= 365:
            assert sorted(fast(x, n) for x in range(n)) == list(range(n))


# ---- 9 ----

@pytest.fixture(scope="module")
def model():
    m = pieces.PieceModel(Q.tokenizer_path())
    m.build()
    return m


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_path())


def test_pieces_query(spark, docs, library):
    want = {(i, len(ids := library.encode(t or "")), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids))) for i, t in docs}
    assert {tuple(r) for r in collected(spark, "op9_pieces")} == want


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=200) | st.text(alphabet=" ab▁\n\tthe", max_size=300) | st.text(alphabet="aeinorst ", max_size=300))
def test_pieces_equal_the_library(text, model, library):
    ids = library.encode(text)
    assert model.encode([text])[0].tolist() == ids
    assert model.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_pieces_of_long_words(model, library):
    rng = random.Random(9)
    for text in (" " * 1000 + "x", "a" * 3000, "ab" * 1500, "".join(rng.choice("etaoin") for _ in range(5000)), "漢字かな" * 300, "▁" * 77):
        assert model.encode([text])[0].tolist() == library.encode(text)


@given(ids=st.lists(st.integers(0, 31999), max_size=30))
def test_decode_any_ids(ids, model, library):
    assert model.decode(np.array(ids, np.int32)) == library.decode(ids)


@pytest.mark.parametrize("seed", range(4))
def test_long_words_equal_the_library(seed):
    import sentencepiece
    path = Q.tokenizer_path()
    model, library = pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    model.build()
    rng = random.Random(seed)
    for letters, n in (("abcdefghijklmnopqrstuvwxyz", 20_000), ("etaoins", 5000), ("ab", 3000), ("a", 1500), ("aé漢𝒳z0", 2000), ("=-", 1000)):
        word = "".join(rng.choice(letters) for _ in range(n))
        text = f"before {word} after{word[:600]}"
        assert model.encode([text])[0].tolist() == library.encode(text)
        long = max(model.split(text), key=len)
        symbols = np.array([model.symbol.get(c, model.width - 1) for c in long[:3000]], np.int64)
        assert model.merge_long(symbols).tolist() == model.merge(symbols, np.zeros(len(symbols), np.int64))[0].tolist()


def test_a_million_letters_end_in_time():
    import time
    model = pieces.PieceModel(Q.tokenizer_path())
    model.build()
    rng = random.Random(1)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    start = time.process_time()
    assert 400_000 < len(model.encode([word])[0]) < 800_000 and time.process_time() - start < 60


# ---- 10 ----

def test_quality_query(spark, docs):
    got = {tuple(r)[:7] for r in collected(spark, "op10_quality")}
    assert got == {(i, *brute.quality(t)) for i, t in docs}


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n#", max_size=300), min_size=1, max_size=20))
def test_quality_measures(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    m = quality.with_measures(df, "text", {c: c for c in quality.MEASURES}).collect()
    for r in m:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.quality(texts[r["doc_id"]])[:5]


def test_label_model_learns_who_is_right():
    rng = random.Random(6)
    counts: Counter = Counter()
    truth = []
    for _ in range(4000):
        good = rng.random() < 0.85
        bad_vote = [0.02, 0.02, 0.02] if good else [0.8, 0.7, 0.02]
        pattern = tuple(-1 if rng.random() < b else 1 if rng.random() < 0.9 else 0 for b in bad_vote)
        counts[pattern] += 1
        truth.append((pattern, good))
    m = quality.fit_label_model(sorted(counts.items()), ["a", "b", "c"])
    odds = lambda p: np.log(m.prior / (1 - m.prior)) + sum(m.logs[n][v] for n, v in zip("abc", p))
    assert m.logs["a"][-1] < -2 and sum((odds(p) > 0) == g for p, g in truth) / len(truth) > 0.95


def test_quality_agrees_with_the_labels(spark):
    labels = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    judged = [r for r in Q.queries()["op10_quality"](spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(r["kept"] == bool(labels[r["doc_id"]]) for r in judged) / len(judged) > 0.97


# ---- pipeline ----

def test_pipeline(spark, docs, library):
    out = corpus_pipeline.run(spark, SF).collect()
    text = dict(docs)
    assert out and all(r["decodes"] for r in out)
    assert max(Counter(r["doc_id"] for r in out).values()) <= 3
    kept = {i for i, t in docs if not brute.quality(t)[5]}
    assert {r["doc_id"] for r in out} <= kept
    untouched = [r for r in out if library.encode(text[r["doc_id"]]) == r["ids"]]
    assert len(untouched) > 0.5 * len(out)


def test_library_works_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("domus.llm") or m == "__spark_entry__"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "domus.llm", None)
    monkeypatch.syspath_prepend(os.path.dirname(os.path.abspath(corpus_pipeline.__file__)))
    import __spark_entry__ as entry

    assert "cdc_upsert" in entry.queries() and not any(re.match(r"op\d+_|pipeline", n) for n in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
