"""Secret scans: key-like strings by pattern and by entropy.

Patterns find assignments, access keys and long hex runs. Candidate strings of each character class
(hex, base32, base36 of one case, base64) are further searched with a sliding window whose Shannon entropy is kept up to
date by incremental counts; windows above the class's threshold make a span, unless an allow-list
pattern knows the string.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base32", "entropy_base64", "entropy_base36")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: One of these is in any text that has an assignment.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: Character classes: candidate strings, window, least entropy in bits a character, what a candidate must hold.
CLASSES = (
    ("entropy_hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])"), 24, 3.0, re.compile(r"(?=.*[0-9])(?=.*[A-Fa-f])")),
    ("entropy_base32", re.compile(r"(?<![A-Z2-7])[A-Z2-7]{24,}=*(?![0-9A-Za-z])"), 24, 3.4, re.compile(r"(?=.*[2-7])(?=.*[A-Z])")),
    ("entropy_base64", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}"), 24, 4.0, re.compile(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])")),
    ("entropy_base36", re.compile(r"(?<![A-Za-z0-9])(?:[a-z0-9]{24,}|[A-Z0-9]{24,})(?![A-Za-z0-9])"), 24, 3.6, re.compile(r"(?=.*[0-9])(?=.*[g-zG-Z])")),
)
#: Strings that look random but are no secrets.
ALLOW = tuple(re.compile(p) for p in (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
    r"(?i)example|sample|dummy|placeholder|changeme",
    r"^(.{1,4})\1+$",  # a short unit over and over
    r"(?i)0123456789|abcdefghij|qwertyuiop",
    r"^[A-Za-z0-9_-]*(?:/[A-Za-z][a-z]+){3,}/?$",  # a path of words
))


def windows_above(text: str, width: int, least: float) -> Iterator[tuple[int, int]]:
    """Maximal ranges covered by windows of ``width`` characters whose Shannon entropy is ``least``
    or more. The sum of c * log2(c) over the counts follows each step of the window."""
    cost = [c * math.log2(c) if c else 0.0 for c in range(width + 1)]
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    for i, ch in enumerate(text):
        if i >= width:
            old = text[i - width]
            c = counts[old]
            total += cost[c - 1] - cost[c]
            counts[old] = c - 1
        c = counts.get(ch, 0)
        total += cost[c + 1] - cost[c]
        counts[ch] = c + 1
        if i >= width - 1 and math.log2(width) - total / width >= least - 1e-9:
            lo = i - width + 1
            if begin < 0:
                begin = lo
            elif lo > end:
                yield begin, end
                begin = lo
            end = i + 1
    if begin >= 0:
        yield begin, end


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of assignments, access keys and hex runs; leftmost, not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the high-entropy ranges of candidates that no allow-list pattern knows."""
    out = []
    for kind, candidates, width, least, holds in CLASSES:
        for m in candidates.finditer(text):
            if holds.match(m[0]) and not any(a.search(m[0]) for a in ALLOW):
                out += [(m.start() + a, m.start() + b, kind) for a, b in windows_above(m[0], width, least)]
    return out


def _found(text: str) -> list[tuple[int, int, str]]:
    spans = base_spans(text) + entropy_spans(text)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``: array of (kind, start, end), code points, end exclusive, by start, then kind.

    Null and empty texts have an empty array. Repeated rows each get their row; an empty table gives
    an empty result; other columns are ignored. Texts are scanned whole."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in _found(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, spans)], names=["id", "spans"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("spans", SPANS)])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", key)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every found span (overlaps merged) replaced by ``mark`` in column ``text``."""
    at = docs.columns.index(text)

    def cut(value: str | None) -> str | None:
        if not value:
            return value
        out, done = [], 0
        for s, e, _ in _found(value):
            if s >= done:
                out += [value[done:s], mark]
            done = max(done, e)
        return "".join(out) + value[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = pa.array([cut(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
