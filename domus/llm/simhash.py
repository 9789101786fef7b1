"""SimHash near-duplicates over a Gray-order hierarchical index.

Distinct fingerprints are routed by blocks of bits (with at most d differing bits, s of d + s
blocks are equal), and every routed group is searched through a tree: codes sorted by Gray rank,
runs of siblings factored into the bits they share (mask and pattern), the shared bits of siblings
factored again into their parent. A search adds up differences on the way down and drops a whole
group as soon as they exceed d. Links become spanning edges inside the task, components outside.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import free_name, stored
from domus.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
FAN_OUT = 8
#: Routed groups of more fingerprints are cut into hashed parts and compared part by part.
PART = 2048
#: Pairs of queries and tree nodes that are looked at together.
FRONTIER = 2_000_000
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text (UTF-8): A-Z lower-cased, white-space words, k-word shingles
    with repeats (all words, if fewer), a bit set where over half the shingles' XXH64 have it.
    No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1, initial=-1))
    spans = zip(ends, ends[k:]) if len(words) > k else ((-1, len(joined)),)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a + 1:b], SEED) for a, b in spans), np.uint64)
    columns = hashes.view(np.uint8).reshape(-1, 8).astype(np.uint16) + np.arange(0, 2048, 256, dtype=np.uint16)
    ones = np.bincount(columns.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(ones.ravel() * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str, name: str, k: int = SHINGLE) -> DataFrame:
    """``docs`` with a long column ``name``: the signed SimHash of column ``text``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t or b"", k) for t in b.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())], names=[*b.schema.names, name])

    return docs.mapInArrow(add, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """One tree for each group, all built at once. ``levels`` run from the codes up to the groups'
    roots; each holds the bits that a node adds to its ancestors: ``mask`` and ``pattern``."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        order = np.lexsort((gray_rank(codes), groups))
        self.order, self.codes = order, codes[order]
        group = groups[order]
        mask, pattern = np.full(len(codes), ~np.uint64(0)), self.codes.copy()
        self.first_child: list[np.ndarray] = []
        shared = [(mask, pattern)]
        while True:
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            if len(starts) == len(group) and self.first_child:
                break
            within = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
            heads = np.flatnonzero(within % FAN_OUT == 0)
            mask, pattern = shared[-1]
            ones = np.bitwise_and.reduceat(pattern & mask, heads)
            some = np.bitwise_or.reduceat(pattern & mask, heads)
            m = np.bitwise_and.reduceat(mask, heads) & ~(ones ^ some)
            shared.append((m, ones & m))
            self.first_child.append(np.r_[heads, len(group)])
            group = group[heads]
        self.root_of = np.searchsorted(group, groups[order])  # groups are sorted
        self.levels = []
        for depth, (m, p) in enumerate(shared):  # what the parent already holds is taken out
            if depth + 1 < len(shared):
                parent = np.repeat(np.arange(len(shared[depth + 1][0])), np.diff(self.first_child[depth]))
                m = m & ~shared[depth + 1][0][parent]
            self.levels.append((m, p & m))

    def search(self, lo: int, hi: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, found), query in [lo, hi), found < query, of the same group within the distance."""
        query = np.arange(lo, hi)
        node = self.root_of[lo:hi]
        diff = np.zeros(len(query), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[depth]
            diff = diff + np.bitwise_count((self.codes[query] ^ pattern[node]) & mask[node])
            keep = diff <= distance
            query, node, diff = query[keep], node[keep], diff[keep]
            if depth:
                first = self.first_child[depth - 1]
                n = first[node + 1] - first[node]
                start = np.repeat(first[node] - np.r_[0, np.cumsum(n)[:-1]], n)
                query, diff, node = np.repeat(query, n), np.repeat(diff, n), start + np.arange(n.sum())
        below = node < query
        return query[below], node[below]


def _spanning(index: GrayIndex, group_sizes: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect, within each group, whatever the links connect: one for each code at most."""
    label = np.arange(len(index.codes))
    cost = np.cumsum(group_sizes)
    lo = 0
    while lo < len(label):
        hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + FRONTIER, "right")))
        u, v = index.search(lo, hi, distance)
        while len(u):
            a, b = label[u], label[v]
            differ = a != b
            u, v = u[differ], v[differ]
            np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
            while (label[label] != label).any():
                label = label[label]
        lo = hi
    moved = np.flatnonzero(label != np.arange(len(label)))
    return index.codes[moved], index.codes[label[moved]]


def routes(distance: int, shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` out of ``distance + shared`` blocks: two codes at
    ``distance`` or fewer differing bits agree on one of them."""
    n_blocks = distance + shared
    ends = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(ends)]
    return [sum(some) for some in itertools.combinations(blocks, shared)]


def shared_blocks(n: int, distance: int = DISTANCE, part: int = PART) -> int:
    """How many blocks a route holds so that n codes make the fewest routed rows. More blocks make
    more routes and smaller groups; a group of over ``part`` codes is routed once for each part."""
    def rows(shared: int) -> float:
        n_blocks = distance + shared
        return math.comb(n_blocks, shared) * max(1.0, n / 2 ** (64 * shared / n_blocks) / part)

    return min(range(1, 5), key=rows)


def links(fps: DataFrame, distance: int = DISTANCE, part: int = PART, shared: int | None = None) -> DataFrame:
    """Edges ``u``, ``v`` (long) that connect whatever fingerprints (distinct long column ``fp``)
    at ``distance`` or fewer differing bits connect. Every such pair is compared or already joined.
    ``shared`` (blocks that a route holds) follows from the number of fingerprints; no result
    depends on it."""
    masks = routes(distance, shared or shared_blocks(fps.count(), distance, part))
    block = F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("bits"))
                                for i, m in enumerate(masks)]))
    routed = fps.select("fp", block.alias("at")).select("fp", "at.block", "at.bits")
    counts = routed.groupBy("block", "bits").count().where("count > 1")
    routed = routed.join(counts, ["block", "bits"])
    # a group of one part meets itself; of more, every two parts meet
    parts = F.ceil(F.col("count") / F.lit(part))
    mine = F.pmod(F.xxhash64("fp"), parts)
    meets = F.when(parts == 1, F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0).cast("long"), parts - 1), lambda k: k != F.col("mine")),
                    lambda k: F.struct(F.least(F.col("mine"), k).alias("i"), F.greatest(F.col("mine"), k).alias("j"))))
    dealt = (routed.withColumn("mine", mine).withColumn("pair", F.explode(meets))
             .select("fp", F.struct("block", "bits", "pair").alias("group")))

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, codes in _whole_groups(batches):
            _, group, sizes = np.unique(group, return_inverse=True, return_counts=True)
            index = GrayIndex(codes.view(np.uint64), group)
            u, v = _spanning(index, sizes[group][index.order], distance)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    # two groups whose hashes agree share a tree, which costs time but no link
    keyed = dealt.select(F.xxhash64("group").alias("g"), "fp").repartition("g").sortWithinPartitions("g")
    return keyed.mapInArrow(connect, "u long, v long")


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(group, code) arrays of about ``rows`` rows, cut between groups; the input is sorted by group."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        if sum(len(g) for g, _ in held) >= rows:
            group, code = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield group[:cut], code[:cut]
            held = [(group[cut:], code[cut:])]
    if held:
        group, code = (np.concatenate(x) for x in zip(*held))
        if len(group):
            yield group, code


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, k: int = SHINGLE,
                    distance: int = DISTANCE, part: int = PART, shared: int | None = None) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id that links reach).

    One row for each row of ``docs``. Null, empty and blank texts have fingerprint zero, linked
    like any other. Equal fingerprints form one node, so groups of copies cost one row. Null ids
    take part but never name a component unless all its ids are null (then it is null). Repeated
    rows each get their row. Empty table: empty result. Other columns are ignored."""
    marked = stored(fingerprints(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), "text", "fp", k)
                    .select("doc_id", "fp"), "simhash")
    rooted = _rooted(marked, distance, part, shared=shared)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(of, "fp").select(
        F.col("doc_id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(marked: DataFrame, distance: int, part: int, least=None, shared: int | None = None) -> DataFrame:
    """fp, root, least for every distinct fingerprint of ``marked``, a stored table: its row count
    stands in for that of its fingerprints."""
    shared = shared or shared_blocks(marked.count(), distance, part)
    nodes = marked.groupBy("fp").agg(F.min(least if least is not None else "doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), distance, part, shared))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, k: int = SHINGLE,
                         distance: int = DISTANCE, part: int = PART) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: that of the smallest id (nulls
    last; of rows with equal ids, one). Columns and types stay; an empty table stays empty. Only
    fingerprints are written to the shared folder; the rows that stay are found again by a digest of
    their id and text, so the table may be read in another order then."""
    mark = free_name(docs, "mark")
    doc_id, body = F.col(key).cast("long"), F.col(text).cast("string")
    digest = F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(" "), F.coalesce(F.concat(F.lit("t"), body), F.lit("")))))
    placed = docs.withColumn(mark, digest)
    narrow = placed.select(doc_id.alias("doc_id"), body.alias("text"), F.col(mark).alias("mark"))
    marked = stored(fingerprints(narrow, "text", "fp", k).drop("text"), "simhash-docs")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("mark"))
    rooted = _rooted(marked, distance, part, least=order)
    stay = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.mark").alias(mark))
    return placed.join(stay, mark, "left_semi").dropDuplicates([mark]).select(*docs.columns)
