"""Format-preserving pseudonyms for personal data.

Validated numbers, dates and addresses are mapped to an integer of their format's domain, permuted
there by a keyed Feistel network (cycle-walking keeps it inside the domain) and written back in the
same format. The permutation depends on the key and the kind only, so equal values stay equal in
all documents, different values stay different, and a pseudonym is as valid as the original.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("email", "iban", "card", "phone", "ssn", "ip", "date")
ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_L, _R = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
PATTERNS = {
    "email": re.compile(r"(?<![\w.+%-])([A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_])?|\w(?:[\w.%+-]*\w)?)@((?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24})(?![\w-])"),
    "iban": re.compile(rf"{_L}[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,4}})?){_R}"),
    "card": re.compile(rf"(?<![0-9A-Za-z.])(?:[0-9]{{13,19}}|[0-9]{{4}}([ -])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}|[0-9]{{4}}([ -])[0-9]{{6}}\2[0-9]{{5}}){_R}"),
    "phone": re.compile(rf"(?<![0-9A-Za-z+])\+1[ .-]?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}{_R}|(?<![0-9A-Za-z+])\+[0-9]{{1,3}}(?:[ .-]?\(?[0-9]{{2,4}}\)?){{2,5}}{_R}|(?<![0-9A-Za-z(])\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}{_R}|(?<![0-9A-Za-z.-])[0-9]{{3}}([.-])[0-9]{{3}}\1[0-9]{{4}}(?![0-9A-Za-z-])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "ip": re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])"),
    "date": re.compile(r"(?<![0-9A-Za-z./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])"),
}


class Permutation:
    """A keyed permutation of [0, n) for any n, the same for the same key and name."""

    def __init__(self, secret: bytes, name: str):
        self.secret, self.name = hashlib.blake2b(secret, digest_size=32).digest(), name.encode()

    def _round(self, i: int, half: int, bits: int, n: int) -> int:
        message = b"%b|%d|%d|%d" % (self.name, n, i, half)
        out = b""
        while len(out) * 8 < bits:
            out += hashlib.blake2b(message + b"|%d" % len(out), key=self.secret, digest_size=64).digest()
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def __call__(self, x: int, n: int) -> int:
        return self._walk(x, n, range(ROUNDS))

    def inverse(self, x: int, n: int) -> int:
        return self._walk(x, n, range(ROUNDS - 1, -1, -1))

    def _walk(self, x: int, n: int, rounds: range) -> int:
        if n < 2:
            return x
        bits = max(1, -(-(n - 1).bit_length() // 2))
        back = rounds.step < 0
        while True:
            a, b = x >> bits, x & ((1 << bits) - 1)
            for i in rounds:
                if back:
                    a, b = b ^ self._round(i, a, bits, n), a
                else:
                    a, b = b, a ^ self._round(i, b, bits, n)
            x = a << bits | b
            if x < n:
                return x


def luhn_digit(payload: str) -> str:
    total = 0
    for i, ch in enumerate(reversed(payload)):
        d = int(ch) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


@functools.cache
def _alphabet(ch: str) -> str:
    """The characters that may stand for this one: digits, small and capital letters; for a letter
    outside A-Z those of its case in its block of 256 code points; others stay (empty)."""
    if ch.isascii():
        return next((x for x in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if ch in x), "")
    if not ch.isalpha():
        return ""
    block = range(ord(ch) & ~255, (ord(ch) | 255) + 1)
    return "".join(c for c in map(chr, block) if not c.isascii() and c.isalpha() and c.islower() == ch.islower() and c.isupper() == ch.isupper())


def _mixed(text: str) -> tuple[int, int, str]:
    """(value, size of the domain, radix classes) of a string whose letters and digits vary within their class."""
    value, size = 0, 1
    for ch in text:
        own = _alphabet(ch)
        if own:
            value, size = value * len(own) + own.index(ch), size * len(own)
    return value, size, text


def _unmixed(value: int, like: str) -> str:
    out = []
    for ch in reversed(like):
        own = _alphabet(ch)
        if own:
            value, d = divmod(value, len(own))
            ch = own[d]
        out.append(ch)
    return "".join(reversed(out))


def _refill(digits: str, like: str) -> str:
    """``like`` with its alphanumerics replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in like)


class Pseudonyms:
    def __init__(self, secret: bytes):
        self.of = {k: Permutation(secret, k) for k in KINDS}

    def _chars(self, kind: str, text: str) -> str:
        value, size, like = _mixed(text)
        return _unmixed(self.of[kind](value, size), like)

    def email(self, m: re.Match) -> str:
        return f"{self._chars('email', m[1])}@{m[2]}"

    def iban(self, m: re.Match) -> str | None:
        compact = m[0].replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(compact) <= 34 or number(compact[4:] + compact[:4]) % 97 != 1:
            return None
        inner = self._chars("iban", compact[4:])
        return _refill(compact[:2] + f"{98 - number(inner + compact[:2] + '00') % 97:02d}" + inner, m[0])

    def card(self, m: re.Match) -> str | None:
        digits = re.sub(r"[ -]", "", m[0])
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        if not ("3" <= digits[0] <= "6" or "2221" <= digits[:4] <= "2720"):
            return None  # no issuer's range
        lead = 4 if digits[0] == "2" else 2  # the issuer stays, so the pseudonym is in a range too
        n = len(digits) - 1 - lead
        inner = digits[:lead] + str(self.of["card"](int(digits[lead:-1]), 10**n)).zfill(n)
        return _refill(inner + luhn_digit(inner), m[0])

    def phone(self, m: re.Match) -> str | None:
        digits = re.sub(r"[^0-9]", "", m[0])
        if not 8 <= len(digits) <= 15:
            return None
        lead = len(re.match(r"\+[0-9]{1,3}(?![0-9])|\+[0-9]|", m[0])[0].lstrip("+"))
        inner, n = digits[lead:], len(digits) - lead
        return _refill(digits[:lead] + str(self.of["phone"](int(inner), 10**n)).zfill(n), m[0])

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = (int(x) for x in m[0].split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = 898  # 001-899 without 666
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self.of["ssn"](x, areas * 99 * 9999), 9999)
        area, group = divmod(x, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m[0].split(".")]
        if max(parts) > 255:
            return None
        return ".".join(map(str, self.of["ip"](int.from_bytes(bytes(parts), "big"), 1 << 32).to_bytes(4, "big")))

    def date(self, m: re.Match) -> str | None:
        fields = re.split(r"[-/.]", m[0])
        sep = m[1] or m[2]
        orders = [(0, 1, 2)] if len(fields[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
        for y, mo, d in orders:
            try:
                day = dt.date(int(fields[y]), int(fields[mo]), int(fields[d])).toordinal()
            except ValueError:
                continue
            if not FIRST_DAY <= day <= LAST_DAY:
                return None
            new = dt.date.fromordinal(FIRST_DAY + self.of["date"](day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1))
            out = [""] * 3
            padded = any(len(fields[i]) == 2 and fields[i][0] == "0" for i in (mo, d)) or min(len(fields[mo]), len(fields[d])) == 2
            out[y], out[mo], out[d] = str(new.year), f"{new.month:02d}" if padded else str(new.month), f"{new.day:02d}" if padded else str(new.day)
            return sep.join(out)
        return None

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        """The text with pseudonyms, and (kind, start, end, pseudonym) of what was replaced (places in the original)."""
        found = []
        if "@" in text or any(ch in text for ch in "0123456789"):
            for rank, kind in enumerate(KINDS):
                if kind == "email" and "@" not in text:
                    continue
                found += [(m.start(), rank, m.end(), new) for m in PATTERNS[kind].finditer(text) if (new := getattr(self, kind)(m)) is not None]
        out, spans, done = [], [], 0
        for start, rank, end, new in sorted(found):
            if start >= done:
                out += [text[done:start], new]
                spans.append((KINDS[rank], start, end, new))
                done = end
        return "".join(out) + text[done:], spans


def pseudonymise(docs: DataFrame, secret: bytes, text: str = "text", spans: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in column ``text`` and a column ``spans``: array of (kind, start, end,
    pseudonym), places in the original text, code points, end exclusive.

    Kinds are checked, not guessed: e-mail addresses by form, IBANs by their remainder, cards by their
    issuer's range and check digit, phones by length, social security numbers by range, IPv4 by octets, dates by the
    calendar (1900 to 2099; day before month where both fit). What fails its check stays. Overlaps:
    the earlier start wins, then the kind listed first. Null texts stay null with no spans; equal
    rows have equal results; an empty table gives an empty result; a column already called
    ``spans`` raises ValueError."""
    if spans.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {spans} exists")
    at = docs.columns.index(text)
    item = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("pseudonym", T.StringType())])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(secret)
        for b in batches:
            done = [names.replace(t) if t is not None else (None, []) for t in b.column(at).to_pylist()]
            new = pa.array([d[0] for d in done], pa.string())
            cells = pa.array([[dict(zip(("kind", "start", "end", "pseudonym"), s)) for s in d[1]] for d in done], arrow)
            yield pa.RecordBatch.from_arrays([*[new if i == at else c for i, c in enumerate(b.columns)], cells], names=[*b.schema.names, spans])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(spans, T.ArrayType(item))]))
