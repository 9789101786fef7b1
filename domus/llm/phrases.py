"""Phrase collocation mining by dynamic itemset counting.

The corpus is cut into words once and written as chunks (a vocabulary, and for each position its word
and the words left in its piece), dealt into shards that are scanned in a cycle. All words are counted
from the first shard on; a longer phrase is counted from the first shard after both its subphrases (all but the
last word, all but the first) have reached the threshold, for one full cycle, so lengths interleave
and every count is exact.

Which phrases have reached the threshold, and after which scan, is told to the tasks by a table of
at most ``SLOTS`` bytes that phrases are hashed into, whatever the corpus; phrases that share a slot
can only start a count early or needlessly, never late, and a needless count falls at the threshold.
So every phrase's first scan follows from the table alone, in all tasks alike. Counts are kept by the
phrase's text, never by a hash.

Pairs of words are many and mostly rare. The first cycle therefore also counts all pairs by hash
bucket; a pair waits until its bucket, which counts at least as much as the pair itself, has reached
the threshold too. A frequent pair's bucket does so within that cycle, so no pair is lost.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from domus.llm.common import shuffle_width, stored
from domus.session import scratch_path

LONGEST, THRESHOLD, SHARDS, BEST, ABSORB_PERCENT, PER_MILLE = 5, 100, 3, 2000, 100, 1000
#: Slots (and pair buckets) of the table, a byte each, a power of two: one for so many bytes of text, within these bounds.
SLOT_BYTES, LEAST_SLOTS, SLOTS = 64, 1 << 16, 1 << 24
#: Bytes of text of a chunk; a longer text is cut between pieces.
CHUNK_BYTES = 4 << 20
NO_LANG = "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    """For each byte: 0 in a word, 1 between words, 2 between pieces."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(b" \t")] = 1
    kinds[list(PIECE_ENDS)] = 2
    return kinds


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


KINDS, LOWER = _kinds(), _lower()


def lang_seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang.encode())


def word_code(seed: int, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def extend(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Code of a phrase from the code of all but its last word and that word's code."""
    mixed = (code ^ (code >> np.uint64(31))) * _MIX
    return mixed + word


def slot_of(code: np.ndarray, words: int, n_slots: int) -> np.ndarray:
    mixed = (code + np.uint64(words)) * _MIX
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return (mixed >> np.uint64(65 - n_slots.bit_length())).astype(np.int64)


def chunks(rows: Iterator[tuple[bytes, str]]) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts with their languages, about ``CHUNK_BYTES`` at a time; long texts are cut after a piece."""
    out, out_langs, size = [], [], 0
    for text, lang in rows:
        begin = 0
        while begin < len(text):
            end = len(text)
            if end - begin > CHUNK_BYTES:
                cut = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]").search(text, begin + CHUNK_BYTES)
                end = cut.end() if cut else end
            out.append(text[begin:end])
            out_langs.append(lang)
            size += end - begin
            begin = end
            if size >= CHUNK_BYTES:
                yield out, out_langs
                out, out_langs, size = [], [], 0
    if out:
        yield out, out_langs


CHUNK = "shard int, langs array<string>, words binary, ends binary, word_lang binary, code binary, place binary, left binary"


def cut_words(texts: list[bytes], langs: list[str]) -> tuple | None:
    """A chunk: the languages; its distinct words by language (bytes, where each ends, language, code);
    for each position the word and the number of words (255 at most) that its piece has from there on."""
    names = sorted(set(langs))
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kinds = KINDS[raw]
    inside = kinds == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.r_[0, edges] if inside[0] else edges
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return None
    packed = LOWER[raw[inside]]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.r_[0, np.searchsorted(starts, text_ends)])
    code = {name: i for i, name in enumerate(names)}
    lang = np.repeat(np.array([code[x] for x in langs], np.int64), per_text)
    size = len(words.dictionary)
    pairs, place = _numbered(lang * size + words.indices.to_numpy(), size * len(names))
    word_lang = pairs // size
    text_of = words.dictionary.take(pa.array(pairs % size)).to_pylist()
    seeds = [lang_seed(x) for x in names]
    codes = np.fromiter((word_code(seeds[a], w) for a, w in zip(word_lang.tolist(), text_of)), np.uint64, len(pairs))
    piece_ends = np.searchsorted(starts, np.flatnonzero(kinds == 2))  # a piece ends before this word
    bounds = np.unique(np.r_[0, piece_ends, len(starts)])
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts))
    return (names, b"".join(text_of), np.cumsum([len(w) for w in text_of]).astype(np.int32).tobytes(), word_lang.astype(np.int32).tobytes(), codes.tobytes(),
            place.astype(np.int32).tobytes(), np.minimum(left, 255).astype(np.uint8).tobytes())


def _cut_corpus(rows: DataFrame, shards: int) -> DataFrame:
    """The rows (lang, body) as chunks, dealt out over the shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for b in batches for pair in _chunks_of(b, "body", "lang"))
        first = TaskContext.get().partitionId()
        for i, (texts, langs) in enumerate(chunks(pairs)):
            cut = cut_words(texts, langs)
            if cut:
                yield pa.RecordBatch.from_arrays([pa.array([(first + i) % shards], pa.int32()), pa.array([cut[0]], pa.list_(pa.string())), *[pa.array([x], pa.binary()) for x in cut[1:]]],
                                                 names=["shard", "langs", "words", "ends", "word_lang", "code", "place", "left"])

    return rows.mapInArrow(run, CHUNK)


def count_chunk(langs: list[str], words: bytes, ends: bytes, word_lang: bytes, code: bytes, place: bytes, left: bytes,
                slots: np.ndarray, buckets: np.ndarray, scan: int, shards: int, longest: int) -> Iterator[tuple]:
    """(lang, words, phrase, first scan, count) arrays of what is counted in this scan; words 0: the
    number of all words of the language."""
    offsets = np.r_[np.int32(0), np.frombuffer(ends, np.int32)]
    text = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(words)])
    names, of_lang = pa.array(langs, pa.string()), np.frombuffer(word_lang, np.int32)
    word_code_, place, left = np.frombuffer(code, np.uint64), np.frombuffer(place, np.int32), np.frombuffer(left, np.uint8)
    n = len(place)
    if scan < shards:
        count = np.bincount(place, minlength=len(text))
        yield names, 0, pa.array([""] * len(names)), np.zeros(len(names), np.int64), np.bincount(of_lang, count, len(names)).astype(np.int64)
        yield names.take(pa.array(of_lang)), 1, text, np.zeros(len(text), np.int64), count
    at, codes = np.arange(n, dtype=np.int32), None  # of the phrases that begin at these positions
    reach = slots[slot_of(word_code_, 1, len(slots))][place]
    for size in range(2, longest + 1):
        # positions (a subset of the last round's) where both subphrases have reached the threshold
        by_position = np.zeros(n + 1, np.uint8)
        by_position[at] = reach
        after = by_position[at + 1]
        keep = np.flatnonzero((reach > 0) & (after > 0) & (left[at] >= size))
        if not len(keep):
            return
        codes = word_code_[place[at[keep]]] if codes is None else codes[keep]
        first, at = np.maximum(reach[keep], after[keep]), at[keep]
        codes = extend(codes, word_code_[place[at + (size - 1)]])
        if size == 2:
            full = buckets[slot_of(codes, 0, len(buckets))]
            keep = np.flatnonzero(full)
            codes, at, first = codes[keep], at[keep], np.maximum(first[keep], full[keep])
        reach = slots[slot_of(codes, size, len(slots))]
        reach = np.where(reach > 0, np.maximum(reach, first), np.uint8(0))  # a shared slot may be set before this phrase is looked for
        now = np.flatnonzero((first <= scan) & (scan - shards < first.astype(np.int16)))
        if len(now):
            one, count = _distinct_phrases(place, at[now], size, len(text))
            p = at[now][one]
            parts = [text.take(pa.array(place[p + j])) for j in range(size)]
            yield names.take(pa.array(of_lang[place[p]])), size, pc.binary_join_element_wise(*parts, " "), first[now][one].astype(np.int64), count


def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (below ``size``), rising, and each key's place among them."""
    seen = np.zeros(size, bool)
    seen[keys] = True
    place = np.cumsum(seen) - 1
    return np.flatnonzero(seen), place[keys]


def _distinct_phrases(place: np.ndarray, at: np.ndarray, words: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One index into ``at`` for each distinct phrase of ``words`` words, and how often it occurs."""
    key, range_ = place[at].astype(np.int64), size
    for j in range(1, words):
        if range_ * size >= 2**62:
            key, range_ = pd.factorize(key)[0].astype(np.int64), len(key)
        key, range_ = key * size + place[at + j], range_ * size
    codes, distinct = pd.factorize(key)
    one = np.empty(len(distinct), np.int64)
    one[codes[::-1]] = np.arange(len(codes))[::-1]
    return one, np.bincount(codes)


def _chunks_of(b: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The chunks of a batch, one by one: a batch can hold a whole partition."""
    for i in range(b.num_rows):
        yield tuple(b.column(c)[i].as_py() for c in columns)


#: Slots of a part of the bucket table; a task sends a part's buckets as places in it and counts.
PART = 1 << 12
MOST = 65_535


def pair_buckets(code: bytes, place: bytes, left: bytes, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the chunk's pairs of words, rising, and how many pairs each has."""
    codes, place, left = np.frombuffer(code, np.uint64), np.frombuffer(place, np.int32), np.frombuffer(left, np.uint8)
    at = np.flatnonzero(left >= 2)
    bucket = np.sort(slot_of(extend(codes[place[at]], codes[place[at + 1]]), 0, n_buckets).astype(np.uint32))
    begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return bucket[begin].astype(np.int64), np.diff(np.r_[begin, len(bucket)])


def _bucket_counts(shard: DataFrame, n_buckets: int) -> DataFrame:
    """part, at, n: packed places (uint16) and counts (uint16, ``MOST`` for more) of the shard's pairs,
    added up in two levels, so no task adds more than about the root of the number of tasks."""
    shape = "part int, at binary, n binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for code, place, left in _chunks_of(b, "code", "place", "left"):
                bucket, n = pair_buckets(code, place, left, n_buckets)
                n = np.minimum(n, MOST).astype(np.uint16)
                parts, begin = np.unique(bucket // PART, return_index=True)
                ends = np.r_[begin[1:], len(bucket)]
                at = (bucket % PART).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([at[a:z].tobytes() for a, z in zip(begin, ends)], pa.binary()),
                                                  pa.array([n[a:z].tobytes() for a, z in zip(begin, ends)], pa.binary())], names=["part", "at", "n"])

    ways = max(1, math.isqrt(shuffle_width(shard.sparkSession)))
    sent = shard.select("code", "place", "left").mapInArrow(send, shape).withColumn("salt", F.spark_partition_id() % ways)
    return sent.groupBy("part", "salt").applyInArrow(_add_buckets, shape)


def _add_buckets(table: pa.Table) -> pa.Table:
    total = np.zeros(PART, np.int64)
    for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
        total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint16)
    at = np.flatnonzero(total)
    return pa.table({"part": table.column("part")[:1], "at": pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                     "n": pa.array([np.minimum(total[at], MOST).astype(np.uint16).tobytes()], pa.binary())})


def _full_buckets(counts: DataFrame, n_buckets: int, threshold: int) -> np.ndarray:
    """Which buckets have reached the threshold: a bit for each comes to the driver."""
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for at, n in zip(b.column("at").to_pylist(), b.column("n").to_pylist()):
                bits = np.zeros(PART, bool)
                bits[np.frombuffer(at, np.uint16)] = np.frombuffer(n, np.uint16) >= min(threshold, MOST)
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(out, pa.binary())], names=["part", "bits"])

    found = np.zeros(max(n_buckets, PART), bool)
    for r in counts.mapInArrow(full, "part int, bits binary").collect():
        found[r["part"] * PART:(r["part"] + 1) * PART] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return found[:n_buckets]


def _scan(shard: DataFrame, slots, scan: int, shards: int, longest: int) -> DataFrame:
    """lang, words, phrase, first, n: counts of one scan, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, buckets = (np.frombuffer(x, np.uint8) for x in slots.value)
        for b in batches:
            for chunk in _chunks_of(b, "langs", "words", "ends", "word_lang", "code", "place", "left"):
                for lang, words, phrase, first, count in count_chunk(*chunk, table, buckets, scan, shards, longest):
                    yield pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(phrase), words, np.int32)), phrase, pa.array(first, pa.int64()), pa.array(count, pa.int64())],
                                                     names=["lang", "words", "phrase", "first", "n"])

    return shard.mapInArrow(run, "lang string, words int, phrase string, first long, n long")


def _reached_slots(reached: DataFrame, longest: int, n_slots: int) -> np.ndarray:
    """The slots of phrases that have reached the threshold. Tasks send bit sets of slot ranges, which
    are joined range by range: a bit for each slot comes to the driver."""
    part = n_slots // 64

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for lang, words, phrase in zip(*(b.column(c).to_pylist() for c in ("lang", "words", "phrase"))):
                codes = [np.array([word_code(lang_seed(lang), w.encode())], np.uint64) for w in phrase.split(" ")]
                code = codes[0]
                for w in codes[1:]:
                    code = extend(code, w)
                found.append(int(slot_of(code, words, n_slots)[0]))
            found = np.unique(np.array(found, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found // part), pa.array(found % part)], names=["part", "slot"])

    def pack(table: pa.Table) -> pa.Table:
        bits = np.zeros(part, np.uint8)
        bits[table.column("slot").to_numpy()] = 1
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    sent = reached.where(F.col("words") < longest).select("lang", "words", "phrase").mapInArrow(slots, "part long, slot long").distinct()
    found = np.zeros(n_slots, bool)
    for r in sent.groupBy("part").applyInArrow(pack, "part long, bits binary").collect():
        found[r["part"] * part:(r["part"] + 1) * part] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return found


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """lang, words, phrase, n of every phrase of up to ``longest`` words that occurs ``threshold`` times
    or more, and, as words 0 and an empty phrase, the number of all words of each language."""
    spark = docs.sparkSession
    path = scratch_path(spark, "phrase-shards")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).cast("string").cast("binary").alias("body")).where("octet_length(body) > 0")
    size = Observation()
    rows = rows.observe(size, F.sum(F.octet_length("body")).alias("bytes"))
    _cut_corpus(rows, shards).write.partitionBy("shard").parquet(path)
    corpus = spark.read.schema(CHUNK).parquet(path)
    n_slots = min(SLOTS, max(LEAST_SLOTS, 1 << ((size.get["bytes"] or 0) // SLOT_BYTES).bit_length()))
    slots = np.zeros(n_slots, np.uint8)  # 1 + the scan after which a phrase of the slot had reached the threshold
    buckets = np.zeros(n_slots, np.uint8)  # likewise, of the buckets of pairs
    done, still, pairs, scan, last_news = [], None, None, 0, -1
    while scan < shards or scan <= last_news + shards:
        shard = corpus.where(F.col("shard") == scan % shards)
        told = spark.sparkContext.broadcast((slots.tobytes(), buckets.tobytes()))
        counts = _scan(shard, told, scan, shards, longest).withColumn("before", F.lit(0).cast("long"))
        if still is not None:
            counts = counts.unionByName(still)
        counts = stored(counts.groupBy("lang", "words", "phrase", "first").agg(F.sum("n").alias("n"), F.max("before").alias("before")), f"phrases-{scan}")
        news = _reached_slots(counts.where((F.col("n") >= threshold) & (F.col("before") < threshold) & (F.col("words") > 0)), longest, n_slots) & (slots == 0)
        told.unpersist()
        if scan < shards and longest > 1:
            now = _bucket_counts(shard, n_slots)
            pairs = stored((now if pairs is None else now.unionByName(pairs)).groupBy("part").applyInArrow(_add_buckets, "part int, at binary, n binary"), f"pairs-{scan}")
            full = _full_buckets(pairs, n_slots, threshold) & (buckets == 0)
            buckets = np.where(full, np.uint8(scan + 1), buckets)
            last_news = scan if full.any() else last_news
        if news.any():
            last_news = scan
            slots = np.where(news, np.uint8(scan + 1), slots)
        whole = F.col("first") + shards - 1 <= scan
        done.append(counts.where(whole & ((F.col("n") >= threshold) | (F.col("words") == 0))).select("lang", "words", "phrase", "n"))
        still = counts.where(~whole).withColumn("before", F.col("n"))
        scan += 1
    return reduce(DataFrame.unionByName, done)


def score_phrases(counts: DataFrame, best: int = BEST, absorb_percent: int = ABSORB_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``best`` phrases of each language, out of ``count_phrases``."""
    part = counts.where("words > 0").select("lang", "phrase", "n")
    total = counts.where("words = 0").select("lang", F.col("n").alias("n"))
    found = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    inside = found.where("words > 2").select("lang", "a", "w", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inside = inside.select("lang", "a", F.explode(F.expr("transform(sequence(1, words - size + 1), i -> array_join(slice(w, i, size), ' '))")).alias("phrase"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = found.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < absorb_percent * F.col("a"), F.lit(True)))
    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr("transform(sequence(1, words - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') AS one, array_join(slice(w, k + 1, words), ' ') AS two))")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("one"), F.col("n").alias("l")), ["lang", "one"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("two"), F.col("n").alias("r")), ["lang", "two"]).join(total, "lang")
    wide = lambda c, digits: f"cast({c} as decimal({digits}, 0))"
    score = F.expr(f"({wide(PER_MILLE, 4)} * {wide('a', 16)} * {wide('n', 16)}) div ({wide('l', 16)} * {wide('r', 16)})").cast("long")
    least = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    top = least.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS,
                 best: int = BEST, absorb_percent: int = ABSORB_PERCENT) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a (its count), l and r (counts of the
    parts at its weakest cut), n (words of the language), score (floor of 1000 a n / (l r)).

    A phrase is two to ``longest`` words of a piece of text, with ``threshold`` occurrences or more,
    overlaps included; those inside a longer one with ``absorb_percent`` of their count go. Null and
    empty texts have no words; a null language is ``und``. Ties: of cuts the first, of phrases the
    more frequent, then the lesser in UTF-8 bytes. Repeated rows count each. An empty table gives an
    empty result. Long texts are counted in chunks, cut between pieces, so a task holds one piece at
    least, whatever its length. Other columns are ignored, whatever their names."""
    return score_phrases(count_phrases(docs, text, lang, threshold, longest, shards), best, absorb_percent)
