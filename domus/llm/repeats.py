"""Finding keys that occur twice in a corpus, without a row for each key.

Documents travel in batches (``bid``) of neighbouring rows. A batch sends its distinct 64-bit keys
as packed blobs, one to each bucket of the key space; a bucket answers every blob with a flag for
each key. So a key that fills a third of the corpus costs one number a batch, and the answer finds
its way back to the text by the batch's id, over the same exchange as the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import bucket_count, shuffle_width

#: Documents of a batch: a power of two. A longer text is a batch of its own.
BATCH_DOCS, BATCH_BYTES = 256, 256 << 10
ONCE, TWICE, HOT = 0, 1, 2
#: Keys with more entries than this, summed over batches, are hot: what follows deals them out more finely.
HOT_ENTRIES = 100_000


def in_batches(docs: DataFrame, key: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """bid, uid, doc_id, body (UTF-8) and the carried columns (``c0``, ``c1`` ...), dealt out by bid.

    uid numbers the rows by place, which is the same each time a stored table is read; order by
    (doc_id, nulls first; uid) tells rows with the same id apart."""
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("doc_id"),
                           F.col(text).cast("string").cast("binary").alias("body"),
                           *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    bid = F.expr(f"if(octet_length(body) > {BATCH_BYTES}, -1 - uid, shiftright(uid, {BATCH_DOCS.bit_length() - 1}))")
    return numbered.select(bid.alias("bid"), *numbered.columns).repartition("bid")


def key_buckets(docs: DataFrame, text: str, bytes_per_key: float) -> int:
    """Buckets of about a million keys each."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return bucket_count(size / bytes_per_key, 1_000_000, shuffle_width(docs.sparkSession))


def documents_of(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """(row, uid, body) in the order of (doc_id, nulls first; uid); a null text is empty."""
    ids, uids, bodies = (table.column(c).to_pylist() for c in ("doc_id", "uid", "body"))
    order = sorted(range(len(uids)), key=lambda i: (ids[i] is not None, ids[i] or 0, uids[i]))
    return [(i, uids[i], bodies[i] or b"") for i in order]


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def _by_bucket(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys ordered by bucket, then value; the buckets present; where each begins (and the end).
    The last bit of a key is a flag and has no say."""
    bucket = bucket_of(keys & ~np.uint64(1), n)
    order = np.lexsort((keys, bucket))
    present, begin = np.unique(bucket[order], return_index=True)
    return keys[order], present, np.r_[begin, len(keys)]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often each occurs, and one entry for each."""
    keys, count = np.unique(keys & ~np.uint64(1), return_counts=True)
    return keys, count, np.ones(len(keys), np.int64)


def repeated_keys(batches: DataFrame, keys_of: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]], n_buckets: int,
                  hot: int = HOT_ENTRIES) -> DataFrame:
    """bid, bucket, flags: for each batch's distinct keys in the bucket, ordered by value, a byte:
    ONCE in the corpus, more often (TWICE), or with over ``hot`` entries (HOT). ``keys_of`` gives a
    batch's distinct keys, ordered (the last bit zero), how often each occurs, and how many entries
    the batch has for it."""

    def send(table: pa.Table) -> pa.Table:
        keys, count, entries = keys_of([d for _, _, d in documents_of(table)])
        sent = keys | (count > 1).astype(np.uint64)  # the last bit says: twice in this batch
        sent, buckets, begin = _by_bucket(sent, n_buckets)
        entries = entries[np.searchsorted(keys, sent & ~np.uint64(1))]
        more = [np.flatnonzero(entries[a:b] > 1) for a, b in zip(begin, begin[1:])]  # place and number of further entries
        return pa.table({"bid": pa.array([table.column("bid")[0].as_py()] * len(buckets), pa.int64()), "bucket": pa.array(buckets, pa.int64()),
                         "sent": pa.array([sent[a:b].tobytes() for a, b in zip(begin, begin[1:])], pa.binary()),
                         "more": pa.array([pack_spans(m, entries[a + m] - 1) for a, m in zip(begin, more)], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        blobs = table.column("sent").to_pylist()
        keys = np.frombuffer(b"".join(blobs), np.uint64)
        _, place, count = np.unique(keys >> np.uint64(1), return_inverse=True, return_counts=True)
        twice = np.zeros(len(count), bool)
        twice[place[(keys & np.uint64(1)) > 0]] = True
        ends = np.cumsum([len(b) // 8 for b in blobs])
        total = count.copy()
        blobs_more = table.column("more").to_pylist()
        at, further = unpack_spans(blobs_more)
        begin = np.repeat(ends - [len(b) // 8 for b in blobs], [len(m) // 16 for m in blobs_more])
        np.add.at(total, place[begin + at], further)
        flag = np.where(total > hot, HOT, np.where(twice | (count > 1), TWICE, ONCE)).astype(np.uint8)[place]
        flags = [flag[e - len(b) // 8:e].tobytes() for e, b in zip(ends, blobs)]
        return pa.table({"bid": table.column("bid"), "bucket": table.column("bucket"), "flags": pa.array(flags, pa.binary())})

    sent = batches.groupBy("bid").applyInArrow(send, "bid long, bucket long, sent binary, more binary")
    return sent.groupBy("bucket").applyInArrow(answer, "bid long, bucket long, flags binary")


def lookup(keys: np.ndarray, answer: pa.Table, n_buckets: int) -> np.ndarray:
    """The flag of each key, given the batch's own answer. ``keys``: all keys of the batch."""
    distinct = np.unique(keys & ~np.uint64(1))
    ordered, _, _ = _by_bucket(distinct, n_buckets)
    flags = b"".join(f for _, f in sorted(zip(answer.column("bucket").to_pylist(), answer.column("flags").to_pylist())))
    back = np.argsort(ordered)
    return np.frombuffer(flags, np.uint8)[back][np.searchsorted(distinct, keys & ~np.uint64(1))]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans; touching spans make one run."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]


def pack_spans(starts, ends) -> bytes:
    return np.stack([np.asarray(starts, np.int64), np.asarray(ends, np.int64)], axis=1).tobytes()


def unpack_spans(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    return flat[:, 0], flat[:, 1]


def outside(body: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
    """What of ``body`` lies outside the (merged) spans."""
    done = 0
    for s, e in zip(starts.tolist(), ends.tolist()):
        yield body[done:s]
        done = e
    yield body[done:]
