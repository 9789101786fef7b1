"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression together with the literal tokens (runs of ``[a-z0-9]``) that
any matching url must contain whole. A rule is filed under the one of its tokens that the fewest
urls hold; a url's tokens fetch the rules filed under them, and only those run their expression.
DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"
#: Rule tables of at most so many rows are broadcast; larger ones are joined by token.
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    """``regex`` runs on ``host || path`` (``on='site'``) or on the lower-cased url (``on='url'``).
    ``label`` is set for host rules only: among those that fit, the longest label decides."""
    regex: str
    verdict: str
    tokens: tuple[str, ...]
    on: str = "url"
    label: str | None = None


def host_rule(label: str, verdict: str) -> Rule:
    """``example.org/es/``: the host and all subdomains, paths that start with ``/es/``."""
    host, slash, rest = label.partition("/")
    path = slash + rest
    whole = path if path.endswith("/") else path[: path.rfind("/") + 1]
    tokens = re.findall(TOKEN, host.lower()) + re.findall(TOKEN, whole.lower())
    return Rule(rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tuple(tokens), "site", label)


def token_rule(tokens: str, verdict: str, regex: str | None = None) -> Rule:
    """A rule on the whole url: the tokens side by side, bounded on both sides (or ``regex``)."""
    parts = tuple(re.findall(TOKEN, tokens))
    body = "[^a-z0-9]".join(parts)
    return Rule(regex or rf"(?:^|[^a-z0-9]){body}(?:[^a-z0-9]|$)", verdict, parts)


#: The query's host rules, as its contract fixes them.
HOST_RULES = (
    host_rule("org/", "allow"),
    host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"),
    host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
)

#: Rules of the method, for urls that no host rule fits: a block rule that matches blocks the url
#: unless an allow rule matches too.
PATTERN_RULES = (
    token_rule("spam farm", "block"),
    token_rule("link farm", "block"),
    token_rule("casino", "block"),
    token_rule("poker", "block"),
    token_rule("porn", "block"),
    token_rule("xxx", "block"),
    token_rule("adult", "block"),
    token_rule("warez", "block"),
    token_rule("torrent", "block"),
    token_rule("doubleclick", "block"),
    token_rule("adserver", "block"),
    token_rule("utm_source spam", "block", r"[?&]utm_source=spam(?:&|#|$)"),
    token_rule("wp login php", "block"),
    token_rule("cgi bin", "block"),
    token_rule("exe", "block", r"\.exe(?:[?#]|$)"),
    token_rule("adult education", "allow"),
    token_rule("wiki", "allow", r"^https?://[^/]*/wiki/"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, u.substr(F.instr(u, "://") + F.lit(3), F.length(u))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("rule_id"), F.lit(r.regex).alias("regex"), F.lit(r.verdict).alias("rule_verdict"),
                     F.lit(r.on).alias("rule_on"), F.lit(r.label).cast("string").alias("label"),
                     F.array(*[F.lit(t) for t in sorted(set(r.tokens)) or [""]]).alias("tokens"))
            for i, r in enumerate(rules)]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def judge_urls(urls: DataFrame, url: str, rules: tuple[Rule, ...]) -> DataFrame:
    """One row for each distinct non-null value of column ``url``: ``url``, ``label`` (longest host
    rule that fits, or null), ``label_verdict``, ``n_block``, ``n_allow`` (method rules that match).
    Urls without a candidate rule that matches are absent. Empty input: empty result."""
    spark = urls.sparkSession
    small = len(rules) <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda x: x)
    table = rule_table(spark, rules)
    distinct = urls.where(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
    host, path = host_and_path(F.col("url"))
    # a rule without literal tokens is filed under the empty token, which every url holds
    found = F.array_distinct(F.regexp_extract_all(F.col("folded"), F.lit(f"({TOKEN})"), 1))
    tokens = (distinct.withColumn("folded", ascii_lower(F.col("url")))
              .select("url", "folded", F.explode(F.array_append(found, F.lit(""))).alias("token")))
    keyed = table.select("rule_id", F.explode("tokens").alias("token"))
    seen = tokens.select("token").join(hint(keyed.select("token").distinct()), "token").groupBy("token").count()
    index = (keyed.join(seen, "token", "left")
             .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("rarest"))
             .join(table, "rule_id").select(F.col("rarest.token").alias("token"), "regex", "rule_verdict", "rule_on", "label"))
    target = F.when(F.col("rule_on") == "site", F.concat(host, path)).otherwise(F.col("folded"))
    hits = tokens.join(hint(index), "token").where(F.regexp_like(target, F.col("regex")))
    method = F.col("label").isNull()
    return hits.groupBy("url").agg(
        F.max(F.when(~method, F.struct(F.length("label"), F.col("label"), F.col("rule_verdict")))).alias("best"),
        F.count(F.when(method & (F.col("rule_verdict") == "block"), 1)).alias("n_block"),
        F.count(F.when(method & (F.col("rule_verdict") == "allow"), 1)).alias("n_allow"),
    ).select("url", F.col("best.label").alias("label"), F.col("best.rule_verdict").alias("label_verdict"), "n_block", "n_allow")


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url",
                rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """Judge every row of ``pages``: ``key``, host, path, rule, verdict, n_block, n_allow.

    ``rule`` is the longest host rule that fits and ``verdict`` its verdict; without one the
    verdict is ``block`` if a block pattern and no allow pattern matches, else ``allow``.
    Null or malformed urls (no ``://``): host and path empty, patterns still run on the text (a
    null url matches none, so it is allowed). Repeated rows are each judged; an empty table gives
    an empty result; columns other than ``key`` and ``url`` are ignored."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    judged = judge_urls(rows, "url", rules)
    method = F.when((F.coalesce("n_block", F.lit(0)) > 0) & (F.coalesce("n_allow", F.lit(0)) == 0), "block").otherwise("allow")
    return rows.join(judged, "url", "left").select(
        F.col("page_id").alias(key), host.alias("host"), path.alias("path"), F.col("label").alias("rule"),
        F.coalesce("label_verdict", method).alias("verdict"),
        F.coalesce("n_block", F.lit(0)).alias("n_block"), F.coalesce("n_allow", F.lit(0)).alias("n_allow"))
