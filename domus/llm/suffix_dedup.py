"""Suffix-array style removal of repeated 100-byte strings over a prefix-free parse.

Triggers of a rolling hash cut every text into phrases. A suffix that starts in a phrase begins with
the rest of that phrase and what follows it, so suffixes need not be sorted one by one: phrases are
sorted (grouped) by the rolling hash at their trigger, equal phrases with equal context are one
dictionary entry, and only entries that meet a different entry of the same trigger are compared: by
the common prefix of the suffixes that begin at their triggers, and by what agrees before them. A text
that repeats costs one entry a phrase, however often it repeats.

The trigger is the least hash of a window instead of a hash divisible by a number: that puts a
trigger into each ``LENGTH``-byte string, at the same place in each copy, which makes the result
exact. Hashes only bring candidates together; bytes decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm import repeats as R
from domus.llm.common import bucket_count, shuffle_width

LENGTH = 100
#: Bytes of a trigger's hash and of the key that follows it; triggers looked at for each string.
TRIGGER, KEY = 8, 32
#: Bytes of text parsed at a time.
PIECE = 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _words(buffer: bytes, n: int) -> np.ndarray:
    """The 8 bytes at each of the first n places, as numbers."""
    return np.ndarray((n,), "<u8", buffer, strides=(1,))


def window_argmin(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of each window of ``width``."""
    n = len(hashes) - width + 1
    packed = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(packed) // width) * width, ~np.uint64(0))
    padded[:len(packed)] = packed
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(bodies: list[bytes], length: int = LENGTH, key: int = KEY) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first, last, key): the ``length``-byte strings that start from first to last share
    the trigger that the key belongs to. Every string of every document is in one phrase."""
    for doc, first, last, keys, _ in triggered(bodies, length, key):
        yield doc, first, last, keys


def triggered(bodies: list[bytes], length: int = LENGTH, key: int = KEY) -> Iterator[tuple[np.ndarray, ...]]:
    """:func:`phrases` with the trigger's place."""
    width = length - key + 1
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, body in enumerate(bodies):
        for at in range(0, len(body) - length + 1, PIECE):
            part = body[at:at + PIECE + length - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield _parse(held, length, key, width)
                held, size = [], 0
    if held:
        yield _parse(held, length, key, width)


def _parse(held, length: int, key: int, width: int):
    buffer = b"".join(p for _, _, p in held) + bytes(key + 8)
    n = len(buffer) - key - 8
    trigger = window_argmin(_mix(_words(buffer, n)), width) if n >= width else np.empty(0, np.int64)
    sizes = np.array([len(p) for _, _, p in held])
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    inside = np.zeros(n, bool)  # strings that don't cross documents
    for b, s in zip(begin.tolist(), sizes.tolist()):
        inside[b:b + s - length + 1] = True
    place = np.flatnonzero(inside)
    owner = np.repeat(np.arange(len(held)), sizes - length + 1)
    t = trigger[place]
    cut = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])])
    last = place[np.r_[cut[1:] - 1, len(place) - 1]]
    first, t, owner = place[cut], t[cut], owner[cut]
    keys = np.zeros(len(t), np.uint64)
    for j in range(0, key, 8):
        keys = _mix(keys ^ _words(buffer[j:], n)[t])
    doc, off = np.array([i for i, _, _ in held]), np.array([a for _, a, _ in held]) - begin
    return doc[owner], first + off[owner], last + off[owner], keys, t + off[owner]


def _keys(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's distinct triggers, how often each occurs, and in how many different contents: each
    is an entry, so a phrase between different neighbours counts as often as it occurs."""
    parsed = list(phrases(bodies))
    doc, first, last, keys = (np.concatenate(x) for x in zip(*parsed)) if parsed else (np.empty(0, np.uint64),) * 4
    keys, of, count = np.unique(keys & ~np.uint64(1), return_inverse=True, return_counts=True)
    entries = count.copy()
    some = np.flatnonzero(count[of] > 1)
    seen: set[bytes] = set()
    again: list[int] = []
    for k, d, lo, hi in zip(of[some].tolist(), doc[some].tolist(), first[some].tolist(), last[some].tolist()):
        content = bodies[d][lo:hi + LENGTH]
        if content in seen:
            again.append(k)
        seen.add(content)
    np.subtract.at(entries, np.array(again, np.int64), 1)
    return keys, count, entries


ENTRIES = "bucket long, bid long, uid long, doc_id long, at long, key long, trigger int, content binary, spans binary"


def _entries(n_buckets: int, n_parts: int, docs: pa.Table, answer: pa.Table) -> pa.Table:
    """Of one batch: the dictionary entries of repeated triggers, first occurrences only, and the
    spans that later occurrences in the batch cover (entries without content)."""
    rows = {c: [] for c in ("bucket", "uid", "doc_id", "at", "key", "trigger", "content", "spans")}
    order = R.documents_of(docs) if len(docs) else []
    bodies = [b for _, _, b in order]
    bid = docs.column("bid")[0].as_py() if len(docs) else 0
    ids = docs.column("doc_id").to_pylist() if len(docs) else []
    parsed = list(triggered(bodies))
    seen: set[bytes] = set()
    covered: dict[int, list[tuple[int, int]]] = {}

    def add(bucket, d, at, key, trigger, content, spans):
        for c, v in zip(rows, (bucket, order[d][1], ids[order[d][0]], at, key, trigger, content, spans)):
            rows[c].append(v)

    if parsed:
        doc, first, last, keys, places = (np.concatenate(x) for x in zip(*parsed))
        flags = R.lookup(keys, answer, n_buckets)
        some = np.flatnonzero(flags != R.ONCE)
        buckets = R.bucket_of(keys[some], n_parts)
        signed = (keys[some] & ~np.uint64(1)).view(np.int64)
        for b, d, lo, hi, flag, k, t in zip(buckets.tolist(), doc[some].tolist(), first[some].tolist(), last[some].tolist(), flags[some].tolist(), signed.tolist(), places[some].tolist()):
            content = bodies[d][lo:hi + LENGTH]
            if content in seen:
                covered.setdefault(d, []).append((lo, hi + LENGTH))
                continue
            seen.add(content)
            if flag != R.HOT:
                add(b, d, lo, k, t - lo, content, None)
                continue
            for i in range(hi - lo + 1):  # a hot trigger's strings are dealt out one by one
                gram = content[i:i + LENGTH]
                if b"*" + gram in seen:
                    covered.setdefault(d, []).append((lo + i, lo + i + LENGTH))
                    continue
                seen.add(b"*" + gram)
                add(int.from_bytes(hashlib.blake2b(gram, digest_size=7).digest(), "big") % n_parts, d, lo + i, None, None, gram, None)
    for d, spans in covered.items():
        s, e = R.merge_spans(*(np.array(x) for x in zip(*spans)))
        add(order[d][1] % n_parts, d, -1, None, None, None, R.pack_spans(s, e))
    n = len(rows["uid"])
    return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "bid": pa.array([bid] * n, pa.int64()), "uid": pa.array(rows["uid"], pa.int64()),
                     "doc_id": pa.array(rows["doc_id"], pa.int64()), "at": pa.array(rows["at"], pa.int64()), "key": pa.array(rows["key"], pa.int64()), "trigger": pa.array(rows["trigger"], pa.int32()),
                     "content": pa.array(rows["content"], pa.binary()), "spans": pa.array(rows["spans"], pa.binary())})


def later_strings(contents: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each content the offsets of ``length``-byte strings that an earlier offset or content holds too."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join(contents), np.uint8)
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    n_of = sizes - length + 1
    owner = np.repeat(np.arange(len(contents)), n_of)
    place = np.arange(n_of.sum()) - np.repeat(np.r_[0, np.cumsum(n_of)[:-1]], n_of) + begin[owner]
    # hash of a string from prefix sums of byte * base^place, moved back to place 0
    base = 0xD6E8FEB86659FD93
    power, back = (np.cumprod(np.r_[np.uint64(1), np.full(len(text) - 1, x, np.uint64)]) for x in (base, pow(base, -1, 1 << 64)))
    sums = np.r_[np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power)]
    code = (sums[length:] - sums[:-length]) * back[:len(text) - length + 1]
    code = _mix(code[place])
    order = np.lexsort((np.arange(len(code)), code))
    same = np.r_[False, code[order][1:] == code[order][:-1]]
    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    later = order[same]
    head = head[same]
    equal = np.ones(len(later), bool)
    for a in range(0, len(later), 20_000):  # the bytes decide
        x, y = place[later[a:a + 20_000], None] + np.arange(length), place[head[a:a + 20_000], None] + np.arange(length)
        equal[a:a + 20_000] = (text[x] == text[y]).all(axis=1)
    is_later = np.zeros(len(code), bool)
    is_later[later[equal]] = True
    if not equal.all():  # strings that only share a hash: told apart one by one
        odd = np.isin(code, code[later[~equal]])
        met: set[bytes] = set()
        for i in np.flatnonzero(odd).tolist():
            s = text[place[i]:place[i] + length].tobytes()
            is_later[i] = s in met
            met.add(s)
    ends = np.cumsum(n_of)
    return [np.flatnonzero(is_later[e - k:e]) for e, k in zip(ends.tolist(), n_of.tolist())]


#: Distinct entries of a trigger that are compared pair by pair; more have their strings hashed.
PAIRED = 24
#: Pairs compared at a time.
PAIR_BLOCK = 20_000


def later_parts(contents: list[bytes], keys: np.ndarray, triggers: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(content, start, end): parts of contents that ``length``-byte strings cover which an earlier
    content of the same trigger holds too. The contents differ within a trigger.

    Copies of a string have the trigger at the same place. So the strings that two entries share are
    told by two numbers: how many bytes agree from the triggers on (the common prefix of two
    suffixes), and how many agree before them."""
    size = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join(contents) + bytes(length), np.uint8)
    begin = np.r_[0, np.cumsum(size)[:-1]]
    order = np.lexsort((np.arange(len(keys)), keys))
    head = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    count = np.diff(np.r_[head, len(order)])
    rank = np.arange(len(order)) - np.repeat(head, count)
    later = np.repeat(order, rank)  # each entry meets those before it in its group
    place = np.repeat(np.arange(len(order)) - rank, rank) + (np.arange(rank.sum()) - np.repeat(np.cumsum(rank) - rank, rank))
    earlier = order[place]
    ahead, behind = np.arange(length), np.arange(1, length + 1)
    out = []
    for at in range(0, len(later), PAIR_BLOCK):
        a, b = earlier[at:at + PAIR_BLOCK], later[at:at + PAIR_BLOCK]
        ta, tb = begin[a] + triggers[a], begin[b] + triggers[b]
        right = np.minimum(size[a] - triggers[a], size[b] - triggers[b])
        same = (text[ta[:, None] + ahead] == text[tb[:, None] + ahead]) & (ahead < right[:, None])
        prefix = np.where(same.all(axis=1), length, same.argmin(axis=1))
        near = np.flatnonzero(prefix + np.minimum(triggers[a], triggers[b]) >= length)
        a, b, ta, tb, prefix = a[near], b[near], ta[near], tb[near], prefix[near]
        before = np.minimum(triggers[a], triggers[b])
        same = (text[np.maximum(ta[:, None] - behind, 0)] == text[np.maximum(tb[:, None] - behind, 0)]) & (behind <= before[:, None])
        suffix = np.where(same.all(axis=1), length, same.argmin(axis=1))
        hit = np.flatnonzero(prefix + suffix >= length)
        out.append((b[hit], triggers[b][hit] - np.minimum(suffix[hit], length), triggers[b][hit] + prefix[hit]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _covers(table: pa.Table) -> pa.Table:
    """Of one bucket: the spans covered in each document."""
    cols = {c: table.column(c).to_pylist() for c in ("bid", "uid", "doc_id", "at", "key", "trigger", "content", "spans")}
    entries = sorted((i for i, c in enumerate(cols["content"]) if c is not None),
                     key=lambda i: (cols["doc_id"][i] is not None, cols["doc_id"][i] or 0, cols["uid"][i], cols["at"][i]))
    spans: dict[tuple[int, int], list[bytes]] = {}
    for i, c in enumerate(cols["content"]):
        if c is None:
            spans.setdefault((cols["bid"][i], cols["uid"][i]), []).append(cols["spans"][i])

    def covered(i: int, s, e) -> None:
        spans.setdefault((cols["bid"][i], cols["uid"][i]), []).append(R.pack_spans(s, e))

    first: dict[tuple, int] = {}
    met: dict = {}
    for i in entries:
        key, content = cols["key"][i], cols["content"][i]
        if first.setdefault((key, content), i) != i:
            covered(i, [cols["at"][i]], [cols["at"][i] + len(content)])
        else:
            met.setdefault(key, []).append(i)
    paired = sorted(i for key, own in met.items() if key is not None and 1 < len(own) <= PAIRED for i in own)
    place = {i: n for n, i in enumerate(entries)}
    paired.sort(key=place.__getitem__)
    if paired:
        keys, triggers = np.array([cols["key"][i] for i in paired]), np.array([cols["trigger"][i] for i in paired], np.int64)
        for n, s, e in zip(*(x.tolist() for x in later_parts([cols["content"][i] for i in paired], keys, triggers))):
            i = paired[n]
            covered(i, [cols["at"][i] + s], [cols["at"][i] + e])
    for key, own in met.items():
        if key is not None and len(own) > PAIRED:
            for i, off in zip(own, later_strings([cols["content"][i] for i in own])):
                if len(off):
                    covered(i, cols["at"][i] + off, cols["at"][i] + off + LENGTH)
    out = [(b, u, R.pack_spans(*R.merge_spans(*R.unpack_spans(x)))) for (b, u), x in spans.items()]
    bid, uid, packed = zip(*out) if out else ((), (), ())
    return pa.table({"bid": pa.array(bid, pa.int64()), "uid": pa.array(uid, pa.int64()), "spans": pa.array(packed, pa.binary())})


def remove_repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = R.HOT_ENTRIES) -> DataFrame:
    """``key``, n_bytes, spans (packed pairs of int64, removed runs), kept (binary: the bytes left).

    Removes each byte covered by a 100-byte string that also starts earlier: in a row of a smaller
    id (nulls first; rows with the same id: earlier place in the table), or earlier in the same row.
    Strings never cross rows. Null and empty texts: nothing to remove, kept empty. Of repeated rows
    the first keeps its text. Empty table: empty result. Other columns are ignored. The table has to
    be read in the same order each time (a stored table is)."""
    batches = R.in_batches(docs, key, text)
    n_buckets = R.key_buckets(docs, text, 32)
    answer = R.repeated_keys(batches, _keys, n_buckets, hot)
    n_parts = bucket_count(n_buckets, 0.25, shuffle_width(docs.sparkSession))
    entries = batches.groupBy("bid").cogroup(answer.groupBy("bid")).applyInArrow(
        lambda d, a: _entries(n_buckets, n_parts, d, a), ENTRIES)
    covers = entries.groupBy("bucket").applyInArrow(_covers, "bid long, uid long, spans binary")

    def cut(table: pa.Table, spans: pa.Table) -> pa.Table:
        of: dict[int, list[bytes]] = {}
        for u, s in zip(spans.column("uid").to_pylist(), spans.column("spans").to_pylist()):
            of.setdefault(u, []).append(s)
        bodies = [b or b"" for b in table.column("body").to_pylist()]
        runs = [R.merge_spans(*R.unpack_spans(of.get(u, []))) for u in table.column("uid").to_pylist()]
        return pa.table({"id": table.column("doc_id"), "n_bytes": pa.array([len(b) for b in bodies], pa.int64()),
                         "spans": pa.array([R.pack_spans(s, e) for s, e in runs], pa.binary()),
                         "kept": pa.array([b"".join(R.outside(b, s, e)) for b, (s, e) in zip(bodies, runs)], pa.binary())})

    return batches.groupBy("bid").cogroup(covers.groupBy("bid")).applyInArrow(
        cut, "id long, n_bytes long, spans binary, kept binary").withColumnRenamed("id", key)
