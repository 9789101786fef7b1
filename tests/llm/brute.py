"""Plain single-process versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def simhash(text: str | None, k: int = 4) -> int:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], ids: list, distance: int = 4) -> list:
    codes = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ codes[i]) <= distance).tolist():
            parent[find(j)] = find(i)
    least: dict = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def repeated_strings(rows: list[tuple[int | None, str | None]], length: int = 100) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha) in the order given; rows with equal ids: order given."""
    seen: set[bytes] = set()
    out: list[tuple] = [()] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)):
        body = (rows[i][1] or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - length + 1):
            s = body[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out[i] = (rows[i][0], len(body), len(body) - len(kept), runs, sha(kept))
    return out


def repeated_lines(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, n_lines, n_removed_lines, kept) in the order given: every run of two or more filled lines (blank ones
    between them included) goes if it stands in an earlier place; tried for all runs, longest or not."""
    seen: set[tuple] = set()
    out: list[tuple] = [()] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i)):
        lines = (rows[i][1] or "").split("\n")
        full = [j for j, x in enumerate(lines) if x.strip(" \t\v\f\r")]
        gone = [False] * len(lines)
        for j, end in enumerate(full):  # runs that end here, against runs that ended before
            runs = [tuple(lines[full[k]:end + 1]) for k in range(max(0, j - 6), j)]
            for run in runs:
                if run in seen:
                    gone[end + 1 - len(run):end + 1] = [True] * len(run)
            seen.update(runs)
        out[i] = (rows[i][0], len(lines) if rows[i][1] is not None else 0, sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g))
    return out


def base_secrets(text: str | None) -> tuple:
    t = text or ""
    kinds = {"assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
    good = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    spans = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(kinds.items()) for m in re.finditer(p, t) if good[k](m)]
    spans.sort()
    n = Counter(s[3] for s in spans)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans))


def quality(text: str | None) -> tuple:
    t = text or ""
    words = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed)


def nearest(rows: list[tuple], every: int = 20, k: int = 20) -> dict:
    fit = [(i, np.array(v, np.float64)) for i, v in rows
           if v is not None and None not in v and np.isfinite(np.array(v, np.float64)).all() and np.any(np.array(v, np.float64))]
    out = {}
    for q, qv in fit:
        if q is not None and q % every == 0:
            found = [(-float((qv * v).sum()), i is None, i or 0) for i, v in fit if i != q and len(v) == len(qv)]
            out[q] = [(None if none else i, -s) for s, none, i in sorted(found)[:k]]
    return out
