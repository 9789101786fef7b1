"""Phrase mining, chat formatting and whitening against brute force; nulls, ties, repeats, empty tables."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus.llm import chat, phrases, whitening
from domus.llm import queries as Q

SF = "/root/testdata/sf0.001"


# ---- 11 ----

def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_phrases(rows, threshold, longest, best, percent=100):
    """rows: (text, lang). The result of mine_phrases, counted plainly."""
    out = []
    for lang in {x or "und" if x is None else x for _, x in rows}:
        f, n = Counter(), 0
        for text, own in rows:
            if (own if own is not None else "und") != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        rows_of = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("shards,slots", [(1, 1 << 16), (4, 1024)])
def test_phrases_equal_a_plain_count(spark, monkeypatch, shards, slots):
    """Also with so few slots that nearly all phrases share one: counts stay exact."""
    monkeypatch.setattr(phrases, "LEAST_SLOTS", slots)
    monkeypatch.setattr(phrases, "SLOTS", slots)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 500)
    rng = random.Random(shards)
    vocabulary = ["Aa", "b", "ć", "d d", "e", "漢", "G", "the"]
    rows = [("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", " ", ". ", "\n", ",", "  "]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, ""])) for _ in range(60)]
    rows += [(None, "en"), ("", None), rows[0], rows[0], ("the b e " * 3000, "en"), ("x\x00y x\x00y", None)]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumns({"phrase": F.lit(1), "n": F.lit("n"), "body": F.lit(2), "shard": F.lit(0)})
    got = sorted(map(tuple, phrases.mine_phrases(docs, threshold=5, shards=shards, best=25).collect()))
    assert got == brute_phrases(rows, 5, 5, 25) and len(got) > 40


def test_late_phrases_are_counted_over_a_whole_cycle(spark):
    """A phrase whose words reach the threshold in the last shard is found with its full count."""
    rows = [("left right", "en")] * 11 + [(f"w{i} other{i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = phrases.mine_phrases(docs, threshold=11, shards=5).collect()
    assert [tuple(r) for r in got] == [("en", 1, "left right", 11, 11, 11, 622, 1000 * 11 * 622 // 121)]


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    done = phrases.mine_phrases(empty)
    assert done.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and done.collect() == []
    assert phrases.mine_phrases(spark.createDataFrame([(None, None), ("", "en"), (". ,", None)], "text string, lang string"), threshold=1).collect() == []


def test_products_beyond_64_bits(spark):
    big = 10**13
    counts = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "x", 2 * big), ("en", 1, "y", 3 * big + 1), ("en", 2, "x y", big + 7)], "lang string, words int, phrase string, n long")
    row = phrases.score_phrases(counts).collect()[0]
    assert row["score"] == 1000 * (big + 7) * 9 * big // (2 * big * (3 * big + 1))


# ---- 12 ----

def plain_chats(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


control = st.lists(st.sampled_from(["<", "|", "\\", "<|", "turn", "|>", "<|end|>\n", "<|says|>", "<|turn|>", "a", "é", "\n", "$1", "<|image|>"]), max_size=12).map("".join)


def test_texts_come_back(spark):
    rng = random.Random(3)
    atoms = ["<", "|", "\\", "<|", "turn", "|>", "<|end|>\n", "<|says|>", "<|turn|>", "a", "é𝒳", "\n", "$1", "<|image|>", "<\\|", "###", "</turn>"]
    text = lambda: "".join(rng.choice(atoms) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", None, "<|says|>x", "assistant"]), rng.choice([text(), text(), text(), None])) for c in range(150) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (7, 0, "assistant", "tie"), (-3, 5, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(c) for c in ("conv", "at", "begin", "parts", "t", "formatted", "held")})
    done = chat.format_chats(df)
    got = done.select("conv_id", "formatted", "n_turns", "turns", chat.read_turns(F.col("formatted")).alias("read"), chat.masked_text(F.col("formatted"), F.col("turns")).alias("learnt")).collect()
    want = plain_chats(rows)
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [tuple(x) for x in r["read"]] == turns and r["n_turns"] == len(turns)
        assert r["learnt"] == "".join(t for role, t in turns if role == "assistant")
        assert [r["formatted"][t["begin"]:].startswith(chat.TURN) for t in r["turns"]] == [True] * len(turns)
        spans = [r["formatted"][t["loss_start"]:t["loss_end"]] for t in r["turns"] if t["loss_start"] is not None]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", s) for s in spans] == [t for role, t in turns if role == "assistant"]


@given(control)
def test_escapes_leave_no_control_string(text):
    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and re.sub(r"<\\(\\*)\|", r"<\1|", escaped) == text


def test_typed_parts(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    P = lambda **k: tuple(k.get(f) for f in chat.PART_FIELDS)
    rows = [(1, 0, "user", [P(type="text", text="see "), P(type="image", ref="a.png", width=100, height=57), P(type="text", text="<|image|> and"), P(type="document", ref="d.pdf", pages=3)]),
            (1, 1, "assistant", [P(type="text", text="heard"), P(type="audio", ref="s.wav", seconds=2.01), None, P(type="zip", ref="z")]),
            (2, 0, "user", None), (2, 1, "assistant", []), (2, 2, "user", [P(type="image", ref=None)])]
    done = chat.with_attachment_tokens(chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text array<{part}>"))).orderBy("conv_id").collect()
    one, two = done
    assert one["formatted"] == "<|turn|>user<|says|>see <|image|><\\|image|> and<|document|><|end|>\n<|turn|>assistant<|says|>heard<|audio|><|file|><|end|>\n"
    assert [(a["turn"], a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [
        (0, "image", "a.png", 4 * 3), (0, "document", "d.pdf", 3 * 512), (1, "audio", "s.wav", 51), (1, "other", "z", 0)]
    marks = {"image": "<|image|>", "document": "<|document|>", "audio": "<|audio|>", "other": "<|file|>"}
    assert all(one["formatted"][a["start"]:].startswith(marks[a["kind"]]) for a in one["attachments"])
    assert one["n_attachment_tokens"] == 12 + 1536 + 51 and one["model_tokens_of_attachments"] == {"image": 12, "document": 1536, "audio": 51, "other": 0}
    assert two["n_turns"] == 3 and [tuple(a)[2:] for a in two["attachments"]] == [("image", None, 1)]


def test_no_chats_and_other_visitors(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []

    class Short(chat.Visitor):
        tokens_per_page = 7

    part = "struct<type:string,ref:string,pages:int>"
    got = chat.format_chats(spark.createDataFrame([("c", 1, "user", [("document", "d", 2)])], f"conv_id string, turn int, role string, text array<{part}>"), visitor=Short()).collect()
    assert got[0]["n_attachment_tokens"] == 14


# ---- 13 ----

def symmetric(kind, n, rng):
    a = rng.standard_normal((n, n))
    if kind == "full":
        return a @ a.T
    if kind == "thin":
        return a[:, :2] @ a[:, :2].T
    if kind == "equal":
        return np.eye(n) * 3
    q, _ = np.linalg.qr(a)
    return (q * np.r_[np.array([5, 5, 5 - 1e-13, 5 - 1e-9])[:n], np.linspace(0, 1, max(0, n - 4))]) @ q.T


@pytest.mark.parametrize("kind", ["full", "thin", "equal", "close"])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 64])
def test_eigenpairs(kind, n):
    m = symmetric(kind, n, np.random.default_rng(n))
    m = (m + m.T) / 2
    values, vectors = whitening.leading_pairs(m, 4)
    want = np.sort(np.linalg.eigvalsh(m))[::-1][:4]
    scale = abs(want).max()
    assert np.abs(values - want).max() < 1e-13 * scale
    assert np.abs(m @ vectors.T - vectors.T * values).max() < 1e-13 * scale
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13


def plain_whitening(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for dim in {len(x) for _, x in kept}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == dim})
        n, total = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(x, total)] for x in fit])
        v = centred.T @ centred / n
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components].T
        for i, x in kept:
            if len(x) == dim:
                at = np.array([float(Fraction(n * c - t, n)) for c, t in zip(x, total)])
                out.setdefault(i, []).append((n, sum((n * c - t) ** 2 for c, t in zip(x, total)), vectors @ at / np.sqrt(np.abs(values)), values / np.trace(v) if np.trace(v) else values))
    return out


def test_whitening_equals_a_plain_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(6) * [5, 3, 2, 1.5, 1, .5]).tolist()) for i in range(300)]
    rows += [(1000, rows[0][1]), (1001, rows[1][1]), (1001, rows[1][1]), (2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [1.0, math.nan] * 3), (2004, [math.inf] * 6),
             (2005, [1e300] * 6), (None, rows[2][1]), (3000, [1.0, 2.0]), (3001, [2.0, 5.0]), (3002, [4.0, 1.0]), (4000, [3.0, 3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(c) for c in ("id", "x", "v", "dim", "n")})
    got = {}
    for r in whitening.whiten(df).collect():
        got.setdefault(r["vec_id"], []).append(r)
    want = plain_whitening([r for r in rows if r[0] not in (2005,)])
    assert set(got) == set(want) - {4000}  # a single distinct vector has no component
    for i, found in got.items():
        n, deviation, whitened, explained = want[i][0]
        k = min(4, 2 if i in (3000, 3001, 3002) else 4)
        times = sum(r[0] == i for r in rows)
        assert sorted(r["component"] for r in found) == sorted(list(range(1, k + 1)) * times)
        for r in found:
            c = r["component"] - 1
            assert (r["n"], r["deviation"]) == (n, deviation) and r["identity_error"] < 1e-9
            assert abs(abs(r["whitened"]) - abs(whitened[c])) < 1e-9 and abs(r["explained"] - explained[c]) < 1e-9


def test_whitening_of_given_table(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_whitening(rows)
    got = Q.op13_whitening(spark, SF).collect()
    assert len(got) == 4 * len(rows)
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"]][0]
        assert (r["n"], r["deviation"]) == (n, deviation) and r["identity_error"] < 1e-9
        assert abs(abs(r["whitened"]) - abs(whitened[r["component"] - 1])) < 1e-8
    by_component = np.array([r["whitened"] for r in sorted(got, key=lambda r: (r["component"], r["vec_id"]))]).reshape(4, -1)
    assert np.abs(by_component @ by_component.T / len(rows) - np.eye(4)).max() < 0.05


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], schema)).collect() == []
    thin = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], schema)).collect()
    assert {r["component"] for r in thin} == {1} and abs(thin[0]["explained"] - 1) < 1e-12


def test_deviation_beyond_a_long_is_null(spark):
    got = whitening.whiten(spark.createDataFrame([(i, [1e15 * i, 0.0]) for i in range(4)], "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {None} and max(r["identity_error"] for r in got) < 1e-9


def test_query_columns(spark):
    done = Q.op12_chat(spark, SF)
    row = done.where("conv_id = -7").collect()[0]
    both = "".join(f"{role}\n{Q.HARD_TEXT}\n" for role in ("user", "assistant"))
    assert row["turns_sha256"] == hashlib.sha256(both.encode()).hexdigest() and row["loss_sha256"] == hashlib.sha256(Q.HARD_TEXT.encode()).hexdigest()
