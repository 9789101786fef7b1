"""Line dedup by a rolling hash over lines.

A rolling hash over the hashes of the last ``WINDOW`` filled lines (lines that hold more than white
space; blank lines between two filled ones belong to the pair) brings equal neighbouring lines
together: each place where such a pair stands that also stands earlier is a match, and matches that
overlap are one passage. So a passage goes from its first filled line to its last, whatever stands
around it, and blank lines alone are no passage. The same hash ends a chunk where it is divisible by
``DIVISOR``; chunks are counted in the report. Hashes find the candidates, the lines' bytes decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm import repeats as R
from domus.llm.common import bucket_count, shuffle_width

WINDOW, DIVISOR, LEAST_LINES = 2, 4, 2
#: White space inside a line.
SPACES = b" \t\v\f\r"
#: Bytes of text a window, at a guess; batches whose first occurrences are compared before all are.
BYTES_PER_KEY, GROUP_BATCHES = 150, 256


def rolling_hashes(lines: list[bytes]) -> np.ndarray:
    """For each line the hash of the ``WINDOW`` lines that end with it (fewer at the start)."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))
    rolling = np.zeros(len(lines), np.uint64)
    for j in range(WINDOW):
        rolling[j:] += hashes[:max(len(lines) - j, 0)] * np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64))
    return rolling ^ rolling >> np.uint64(31)


def line_chunks(body: bytes) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The text's lines (split at \\n) and its chunks as ranges of them."""
    lines = body.split(b"\n")
    ends = (np.flatnonzero(rolling_hashes(lines) % np.uint64(DIVISOR) == 0) + 1).tolist()
    if not ends or ends[-1] != len(lines):
        ends.append(len(lines))
    return lines, list(zip([0, *ends], ends))


def multi_line_chunks(body: bytes) -> list[tuple[int, bytes]]:
    """(number, bytes) of the text's chunks of two or more lines."""
    lines, chunks = line_chunks(body)
    return [(i, b"\n".join(lines[a:b])) for i, (a, b) in enumerate(chunks) if b - a >= LEAST_LINES]


def filled(lines: list[bytes]) -> list[int]:
    """Which lines hold more than white space."""
    return [i for i, x in enumerate(lines) if x.strip(SPACES)]


def _keys(bodies: list[bytes]) -> np.ndarray:
    """Of every ``WINDOW`` neighbouring filled lines."""
    found = []
    for b in bodies:
        lines = b.split(b"\n")
        found.append(rolling_hashes([lines[i] for i in filled(lines)])[WINDOW - 1:])
    return np.concatenate(found or [np.empty(0, np.uint64)])


WINDOWS = "bucket long, bid long, uid long, doc_id long, at long, content binary, places binary"


def _table(rows: list[tuple]) -> pa.Table:
    kinds = {"bucket": pa.int64(), "bid": pa.int64(), "uid": pa.int64(), "doc_id": pa.int64(), "at": pa.int64(), "content": pa.binary(), "places": pa.binary()}
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(kinds.items(), zip(*rows) if rows else [()] * len(kinds))})


def _candidates(n_buckets: int, n_parts: int, docs: pa.Table, answer: pa.Table) -> pa.Table:
    """Of one batch: the first occurrence of each repeated window, and the places of the later ones
    (rows without content)."""
    order = R.documents_of(docs) if len(docs) else []
    if not order:
        return _table([])
    ids, bid = docs.column("doc_id").to_pylist(), docs.column("bid")[0].as_py()
    lines = [body.split(b"\n") for _, _, body in order]
    keys = _keys([body for _, _, body in order])
    full = [filled(x) for x in lines]
    n_of = [max(len(x) - WINDOW + 1, 0) for x in full]
    owner = np.repeat(np.arange(len(order)), n_of)
    place = np.arange(len(keys)) - np.repeat(np.cumsum([0, *n_of[:-1]]), n_of)
    some = np.flatnonzero(R.lookup(keys, answer, n_buckets) != R.ONCE) if len(keys) else np.empty(0, np.int64)
    rows: list[tuple] = []
    seen: set[bytes] = set()
    later: dict[int, list[int]] = {}
    for bucket, d, at in zip(R.bucket_of(keys[some] & ~np.uint64(1), n_parts).tolist(), owner[some].tolist(), place[some].tolist()):
        content = b"\n".join(lines[d][full[d][at]:full[d][at + WINDOW - 1] + 1])
        if content in seen:
            later.setdefault(d, []).append(at)
        else:
            seen.add(content)
            rows.append((bucket, bid, order[d][1], ids[order[d][0]], at, content, None))
    rows += [(order[d][1] % n_parts, bid, order[d][1], None, -1, None, np.array(at, np.int64).tobytes()) for d, at in later.items()]
    return _table(rows)


def _firsts(table: pa.Table) -> pa.Table:
    """The first occurrence of each window, and the places of the others."""
    entries, rows = [], []
    for r in zip(*(table.column(c).to_pylist() for c in ("bucket", "bid", "uid", "doc_id", "at", "content", "places"))):
        (rows if r[5] is None else entries).append(r)
    seen: set[bytes] = set()
    later: dict[tuple, list[int]] = {}
    for r in sorted(entries, key=lambda r: (r[3] is not None, r[3] or 0, r[2], r[4])):
        if r[5] in seen:
            later.setdefault(r[:3], []).append(r[4])
        else:
            seen.add(r[5])
            rows.append(r)
    rows += [(*row, None, -1, None, np.array(at, np.int64).tobytes()) for row, at in later.items()]
    return _table(rows)


def _removed(docs: DataFrame, batches: DataFrame, text: str) -> DataFrame:
    """bid, uid, places of the windows that occur earlier. First occurrences are compared among
    neighbouring batches, then among all: a passage that stands everywhere costs a row a group."""
    n_buckets = R.key_buckets(docs, text, BYTES_PER_KEY)
    n_parts = bucket_count(n_buckets, 0.25, shuffle_width(docs.sparkSession))
    answer = R.repeated_keys(batches, lambda bodies: R.counted(_keys(bodies)), n_buckets)
    found = batches.groupBy("bid").cogroup(answer.groupBy("bid")).applyInArrow(
        lambda d, a: _candidates(n_buckets, n_parts, d, a), WINDOWS)
    near = found.groupBy("bucket", F.expr(f"bid div {GROUP_BATCHES}")).applyInArrow(_firsts, WINDOWS)
    return near.groupBy("bucket").applyInArrow(_firsts, WINDOWS).where("content is null").select("bid", "uid", "places")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", *, report: bool = False) -> DataFrame:
    """``docs`` with repeated passages of two or more lines cut from column ``text``; rows and columns stay.

    Removes each line covered by two neighbouring filled lines (and the blank ones between) that also
    stand so earlier: in a row of a smaller id (nulls first; rows with the same id: earlier place in
    the table), or earlier in the same row. The first occurrence of every passage stays, and so do
    blank lines around a passage. Ids are whole numbers. Long texts are handled whole. With
    ``report=True`` the result is ``key``, n_lines, n_chunks, n_removed_lines, n_removed_chunks
    (chunks of two or more lines of which none is left) and kept (the remaining text) instead. Null
    text: stays null (report: no lines, kept empty). An empty text is one empty line. Repeated rows:
    all but the first lose their text, unless it is a single line. Empty table: empty result. The
    table has to be read in the same order each time (a stored table is)."""
    columns = docs.columns
    others = tuple(c for c in columns if c != text) if not report else ()
    batches = R.in_batches(docs, key, text, others)
    gone = _removed(docs, batches, text)

    def kept_lines(body: bytes | None, places: list[bytes]) -> tuple:
        if body is None:
            return 0, 0, 0, 0, None
        lines, chunks = line_chunks(body) if report else (body.split(b"\n") if places else [], [])
        if not places:
            return len(lines), len(chunks), 0, 0, body
        out = np.zeros(len(lines), bool)
        full = filled(lines)
        for at in np.frombuffer(b"".join(places), np.int64).tolist():
            out[full[at]:full[at + WINDOW - 1] + 1] = True
        left = [x for x, o in zip(lines, out.tolist()) if not o]
        cut_chunks = sum(b - a >= LEAST_LINES and bool(out[a:b].all()) for a, b in chunks)
        return len(lines), len(chunks), len(lines) - len(left), cut_chunks, b"\n".join(left)

    def cut(table: pa.Table, answer: pa.Table) -> pa.Table:
        places: dict[int, list[bytes]] = {}
        for u, p in zip(answer.column("uid").to_pylist(), answer.column("places").to_pylist()):
            places.setdefault(u, []).append(p)
        done = [kept_lines(b, places.get(u, [])) for b, u in zip(table.column("body").to_pylist(), table.column("uid").to_pylist())]
        kept = pa.array([d[4] for d in done], pa.binary()).cast(pa.string())
        if not report:
            return pa.table({c: kept if c == text else table.column(f"c{others.index(c)}") for c in columns})
        return pa.table({"id": table.column("doc_id"), "n_lines": pa.array([d[0] for d in done], pa.int64()), "n_chunks": pa.array([d[1] for d in done], pa.int64()),
                         "n_removed_lines": pa.array([d[2] for d in done], pa.int64()), "n_removed_chunks": pa.array([d[3] for d in done], pa.int64()),
                         "kept": pa.compute.fill_null(kept, "")})

    schema = docs.schema if not report else "id long, n_lines long, n_chunks long, n_removed_lines long, n_removed_chunks long, kept string"
    out = batches.groupBy("bid").cogroup(gone.groupBy("bid")).applyInArrow(cut, schema)
    return out.withColumnRenamed("id", key) if report else out
