"""Quality rules by weak supervision.

Every rule votes a document good (+1), bad (-1) or abstains (0). Expectation-maximisation over the
counts of vote patterns estimates how each rule votes on good and on bad documents; the posterior
probability of being good takes the place of passing all rules. DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.llm.common import SPACE, free_name, stored, words_of

#: Characters that count as symbols, and the fixed rules that no vote overrules.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
VOTES = (-1, 0, 1)
ROUNDS, STRENGTH, PRIOR_GOOD, KEEP_FROM = 50, 0.2, 0.8, 0.5
#: Chances of a vote by a good and by a bad document before the data are seen: bad votes are rare
#: and tell much, good votes are common and tell little.
BELIEFS = {True: {-1: 0.01, 0: 0.19, 1: 0.8}, False: {-1: 0.2, 0: 0.1, 1: 0.7}}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
            "n_letters", "n_upper", "n_marks", "n_distinct")


def _per(n: str, of: str) -> Column:
    return F.col(n) / F.greatest(F.col(of), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


#: name -> vote, from the measures. Abstentions lie between the two limits.
RULES: dict[str, Column | object] = {
    "length": lambda: _vote(F.col("n_words") >= 80, F.col("n_words") < 20),
    "word_length": lambda: _vote(_per("word_chars", "n_words").between(3, 12), ~_per("word_chars", "n_words").between(2, 20)),
    "symbols": lambda: _vote(_per("n_symbols", "n_words") < 0.05, _per("n_symbols", "n_words") > 0.25),
    "letters": lambda: _vote(_per("n_letters", "word_chars") >= 0.94, _per("n_letters", "word_chars") < 0.85),
    "symbol_share": lambda: _vote(_per("n_symbols", "word_chars") < 0.01, _per("n_symbols", "word_chars") > 0.05),
    "dup_lines": lambda: _vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3), _per("n_dup_lines", "n_lines") > 0.5),
    "repeats": lambda: _vote(_per("n_repeat_words", "n_words") < 0.1, _per("n_repeat_words", "n_words") > 0.35),
    "line_ends": lambda: _vote(_per("n_ended_lines", "n_lines") >= 0.6, _per("n_ended_lines", "n_lines") < 0.2),
    "upper_case": lambda: _vote(_per("n_upper", "n_letters") < 0.15, _per("n_upper", "n_letters") > 0.5),
    "marks": lambda: _vote(_per("n_marks", "n_words") < 0.1, _per("n_marks", "n_words") > 0.5),
    "variety": lambda: _vote((_per("n_distinct", "n_words") > 0.4) & (F.col("n_words") >= 30), _per("n_distinct", "n_words") < 0.08),
}


def with_measures(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the measures under the given names."""
    step = {c: free_name(docs, c) for c in ("q_text", "q_words", "q_lines", "q_bits", "q_order", "q_hits", "q_at")}
    t, w, lines, bits, order, hits, at = (step[c] for c in ("q_text", "q_words", "q_lines", "q_bits", "q_order", "q_hits", "q_at"))
    df = docs.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(w, words_of(F.col(t)))
    df = df.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    # three-word windows, found twice: a sort of (low bits of the window's hash, place) brings
    # equal windows together; the windows' own words then decide among the neighbours that agree
    df = df.withColumn(bits, F.length(F.bin(F.size(w))))
    df = df.withColumn(order, F.when(F.size(w) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.call_function("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), F.col(bits)).bitwiseOR(i.cast("long"))))))
    same = lambda x, y: F.call_function("shiftright", x, F.col(bits)) == F.call_function("shiftright", y, F.col(bits))
    df = df.withColumn(hits, F.filter(order, lambda x, k: F.coalesce(same(x, F.get(order, k - 1)), F.lit(False))
                                      | F.coalesce(same(x, F.get(order, k + 1)), F.lit(False))))
    place = lambda x: (x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(bits)) - 1)).cast("int")
    df = df.withColumn(hits, F.sort_array(F.transform(hits, lambda x: F.struct(
        F.concat_ws(" ", F.get(w, place(x)), F.get(w, place(x) + 1), F.get(w, place(x) + 2)).alias("window"), place(x).alias("at")))))
    twice = lambda x, k: (F.coalesce(x["window"] == F.get(hits, k - 1)["window"], F.lit(False))
                          | F.coalesce(x["window"] == F.get(hits, k + 1)["window"], F.lit(False)))
    df = df.withColumn(at, F.sort_array(F.transform(F.filter(hits, twice), lambda x: x["at"])))
    covered = F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    count = lambda pattern: F.regexp_count(F.col(t), F.lit(pattern))
    measures = {
        "n_words": F.size(w), "word_chars": F.length(F.array_join(w, "")), "n_symbols": count(SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lines), "n_ended_lines": F.size(F.filter(lines, lambda x: x.rlike(f"[.!?:;\"')][{SPACE}]*$"))),
        "n_letters": F.length(F.regexp_replace(t, r"\P{L}+", "")), "n_upper": F.length(F.regexp_replace(t, r"\P{Lu}+", "")),
        "n_marks": count("!!|[?]{2}|[.]{4}|[!?]{2}"), "n_distinct": F.size(F.array_distinct(w)),
    }
    return df.select(*docs.columns, *[measures[c].cast("long").alias(names[c]) for c in MEASURES])


def names_of(names: dict[str, str], which: tuple[str, ...]) -> list[Column]:
    return [F.col(f"`{names[c]}`") for c in which]


def votes() -> list[Column]:
    return [rule().cast("int").alias(f"v_{name}") for name, rule in RULES.items()]


@dataclass(frozen=True)
class LabelModel:
    """prior: share of good documents; logs[rule][vote]: log of P(vote | good) / P(vote | bad)."""
    prior: float
    logs: dict[str, dict[int, float]]

    def log_odds(self, vote_of) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, by_vote in self.logs.items():
            v = vote_of(name)
            odds = odds + F.when(v == -1, by_vote[-1]).when(v == 1, by_vote[1]).otherwise(by_vote[0])
        return odds


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], names: list[str]) -> LabelModel:
    """EM (for the most probable parameters) over two classes, with rules that vote independently
    given the class, from counts of vote patterns.

    ``BELIEFS`` are the chances of each vote before the data are seen; they start EM, weigh
    ``STRENGTH`` times the documents (so results are alike at every size) and tie the classes to
    their names. No documents: the beliefs alone."""
    total = sum(n for _, n in patterns)
    mass = {c: max(STRENGTH * total, 1.0) * share for c, share in ((True, PRIOR_GOOD), (False, 1 - PRIOR_GOOD))}
    chance = {c: [dict(BELIEFS[c]) for _ in names] for c in (True, False)}
    prior = PRIOR_GOOD
    for _ in range(ROUNDS if total else 0):
        start = math.log(prior / (1 - prior))
        counts = {c: [{v: mass[c] * BELIEFS[c][v] for v in VOTES} for _ in names] for c in (True, False)}
        weight = dict(mass)
        for p, n in patterns:
            odds = start + sum(math.log(chance[True][r][v] / chance[False][r][v]) for r, v in enumerate(p))
            good = n / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for c, share in ((True, good), (False, n - good)):
                weight[c] += share
                for r, v in enumerate(p):
                    counts[c][r][v] += share
        chance = {c: [{v: x / sum(by.values()) for v, x in by.items()} for by in counts[c]] for c in counts}
        prior = weight[True] / (weight[True] + weight[False])
    return LabelModel(prior, {name: {v: math.log(chance[True][r][v] / chance[False][r][v]) for v in VOTES} for r, name in enumerate(names)})


def judge(docs: DataFrame, text: str = "text", *, carry: tuple[str, ...] | None = None,
          keep_from: float = KEEP_FROM) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (the columns of ``carry`` only, if given) with the measures, ``base_failed``, ``quality`` (posterior probability of being good)
    and ``kept``, and the names of these columns (underscores tell them from the input's).

    Measures are taken once and written to the shared checkpoint folder with the rows; the counts of
    vote patterns (3 to the number of rules at most) are all that goes to the driver.

    Null and empty texts: all measures 0, base_failed, not kept. Rows are judged each, equal rows
    alike. Empty table: empty result. base_failed: fewer than 50 words, or more than half of the
    words in repeated three-word windows."""
    names = {c: free_name(docs, c) for c in (*MEASURES, "base_failed", "quality", "kept")}
    own = list(carry if carry is not None else docs.columns)
    measured = stored(with_measures(docs, text, names).select(*own, *names_of(names, MEASURES)), "quality")
    plain = measured.select(*[F.col(f"`{names[c]}`").alias(c) for c in MEASURES])
    columns = votes()
    seen = plain.where(~_base_failed(plain)).select(*columns).groupBy(*[f"v_{r}" for r in RULES]).count().collect()
    model = fit_label_model([(tuple(r[:-1]), r[-1]) for r in sorted(map(tuple, seen))], list(RULES))
    # the rules read the measures by their own names, so they run beside a struct of the row
    judged = measured.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]).alias("row"),
                             *[F.col(f"`{names[c]}`").alias(c) for c in MEASURES])
    judged = judged.select("*", *votes()).withColumn("odds", model.log_odds(lambda r: F.col(f"v_{r}")))
    posterior = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("odds")))
    failed = _base_failed(judged)
    return judged.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(own)],
                         *[F.col(c).alias(names[c]) for c in MEASURES], failed.alias(names["base_failed"]),
                         posterior.alias(names["quality"]), (~failed & (posterior >= keep_from)).alias(names["kept"])), names


def _base_failed(df: DataFrame) -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)


def keep_good(docs: DataFrame, text: str = "text", *, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps."""
    judged, names = judge(docs, text, keep_from=keep_from)
    return judged.where(F.col(f"`{names['kept']}`")).select(*docs.columns)
