"""Model formulas as Spark columns.

``y ~ a + C(g) * log(b) - 1``: terms are joined by ``+`` (or taken out by ``-``), factors of a term
by ``:``, and ``a * b`` stands for ``a + b + a:b``. A factor is a column, ``C(column)`` (a category,
one 0/1 column for each level) or ``log``, ``log1p``, ``exp`` or ``sqrt`` of a column. ``1`` is the
intercept (there unless ``- 1`` or ``0``).

The levels of categories are learnt from one table (``learn``) and used on any other. A category
leaves out its first level where the term without it is in the model too, as the full set would
only repeat that term's columns; what still depends on earlier columns (cells that never occur) is
found when the model is solved."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FUNCTIONS = {"log": F.ln, "log1p": F.log1p, "exp": F.exp, "sqrt": F.sqrt}
_FACTOR = re.compile(r"(?:(\w+)\()?([^()+*:~-]+?)(\))?")
#: A category of more levels has no solvable design.
MAX_LEVELS = 10_000

Term = tuple[str, ...]


def _factor(text: str) -> str:
    text = text.strip()
    m = _FACTOR.fullmatch(text)
    if not m or bool(m[1]) != bool(m[3]) or (m[1] and m[1] != "C" and m[1] not in FUNCTIONS):
        raise ValueError(f"not a factor: {text!r}")
    return f"{m[1]}({m[2].strip()})" if m[1] else m[2]


def _terms(piece: str) -> list[Term]:
    """The terms that a product stands for."""
    crossed = [tuple(_factor(f) for f in part.split(":")) for part in piece.split("*")]
    out = []
    for size in range(1, len(crossed) + 1):
        for chosen in itertools.combinations(crossed, size):
            out.append(tuple(dict.fromkeys(f for t in chosen for f in t)))
    return out


def column_of(factor: str) -> str:
    return factor[factor.index("(") + 1:-1] if factor.endswith(")") else factor


def value_of(factor: str) -> Column:
    c = F.col("`" + column_of(factor).replace("`", "``") + "`").cast("double")
    return FUNCTIONS[factor.split("(")[0]](c) if factor.endswith(")") else c


@dataclass(frozen=True)
class Formula:
    """A response, the terms in order, and whether there is an intercept."""
    response: str
    terms: tuple[Term, ...]
    intercept: bool = True

    @staticmethod
    def parse(text: str) -> "Formula":
        response, _, right = text.partition("~")
        if not right.strip():
            raise ValueError(f"no terms: {text!r}")
        terms: list[Term] = []
        intercept = True
        for sign, piece in re.findall(r"([+-]?)\s*([^+-]+)", right):
            piece = piece.strip()
            if piece in ("0", "1"):
                intercept = (piece == "1") != (sign == "-")
                continue
            for t in _terms(piece):
                same = [u for u in terms if set(u) == set(t)]
                if sign == "-":
                    terms = [u for u in terms if u not in same]
                elif not same:
                    terms.append(t)
        return Formula(_factor(response), tuple(sorted(terms, key=len)), intercept)

    def categories(self) -> list[str]:
        return sorted({column_of(f) for t in self.terms for f in t if f.startswith("C(")})

    def columns(self, levels: dict[str, list[str]]) -> list[tuple[str, tuple]]:
        """(name, parts) of the design's columns; a part is (factor, level or None)."""
        have = {frozenset(t) for t in self.terms} | ({frozenset()} if self.intercept else set())
        out = []
        for t in self.terms:
            choices = []
            for f in t:
                if f.startswith("C("):
                    all_levels = levels[column_of(f)]
                    rest = frozenset(t) - {f}
                    choices.append([(f, x) for x in (all_levels[1:] if rest in have else all_levels)])
                else:
                    choices.append([(f, None)])
            for parts in itertools.product(*choices):
                out.append((":".join(f if x is None else f"{column_of(f)}[{x}]" for f, x in parts), parts))
        return out


def learn_levels(df: DataFrame, formulas: Sequence[Formula], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """The levels of every category, sorted as texts, from one aggregate; nulls are no level."""
    names = sorted({c for f in formulas for c in f.categories()})
    if not names:
        return {}
    # few combinations are left of many rows before each is taken apart
    df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names]).distinct()
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in names])).alias("p")).select("p.*")
    rows = pairs.where("v is not null").distinct().limit(limit * len(names) + 1).collect()
    out: dict[str, list[str]] = {c: sorted(r["v"] for r in rows if r["c"] == c) for c in names}
    if len(rows) > limit * len(names) or any(len(v) > limit for v in out.values()):
        raise ValueError(f"a category has more than {limit} levels")
    return out


def _mark(factor: str, level: str, levels: list[str]) -> Column:
    c = F.col("`" + column_of(factor).replace("`", "``") + "`").cast("string")
    # a level that was not learnt is missing, not the left-out level
    return F.when(c == level, 1.0).when(c.isin(levels), 0.0)


def design_column(parts: tuple, levels: dict[str, list[str]]) -> Column:
    out = None
    for f, level in parts:
        x = value_of(f) if level is None else _mark(f, level, levels[column_of(f)])
        out = x if out is None else out * x
    return out
