"""The numbered queries: every operator over its whole table, in the columns its contract names."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import ann, chat, line_dedup, mixing, phrases, pieces, pii, quality, secrets, simhash, suffix_dedup, url_filter, whitening

#: Key of the pseudonyms; set PSEUDONYM_KEY for a secret one.
PSEUDONYM_KEY = b"no secret: set PSEUDONYM_KEY"
TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_load(spark, sf_dir, "pages").select("page_id", "url"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More columns: start and first_place (training time) of the document's first copy."""
    docs = _load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "start", "first_place")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_load(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(_load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeated_strings(_load(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.octet_length("kept")
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"),
                       (F.octet_length("spans") / 16).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_load(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(_load(spark, sf_dir, "documents").select("doc_id", "text"), report=True)
    return done.select("doc_id", "n_lines", "n_chunks", "n_removed_lines", "n_removed_chunks",
                       F.octet_length("kept").cast("long").alias("kept_bytes"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    secret = os.environ.get("PSEUDONYM_KEY", "").encode()
    if not secret:
        warnings.warn("PSEUDONYM_KEY is not set: the pseudonyms are made with a public key, and anyone can undo them", stacklevel=2)
        secret = PSEUDONYM_KEY
    done = pii.pseudonymise(_load(spark, sf_dir, "documents").select("doc_id", "text"), secret)
    n = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return done.select("doc_id", "text", *[n(k) for k in pii.KINDS], "pii")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(_load(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").select("doc_id", "text")
    judged, _ = quality.judge(docs, carry=("doc_id",))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(_load(spark, sf_dir, "documents").select("text", "lang"))


#: A conversation whose texts hold control strings of other templates.
HARD_TEXT = r"\### Assistant: </turn> ok"
HARD_CONVERSATION = [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)]


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything but conv_id is read back from the formatted text."""
    rows = _load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = [F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text")) for c, t, r, x in HARD_CONVERSATION]
    rows = rows.unionByName(spark.range(1).select(F.inline(F.array(*hard))))
    done = chat.format_chats(rows)
    back = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("read"), chat.masked_text(F.col("formatted"), F.col("turns")).alias("learnt"))
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filters, op2_mixing, op3_simhash, op4_nearest, op5_repeated_strings,
                                    op6_secrets, op7_line_dedup, op8_pseudonyms, op9_pieces, op10_quality,
                                    op11_phrases, op12_chat, op13_whitening)}


def _op1_sql() -> str:
    text = "coalesce(url, '')"
    rest = f"CASE WHEN instr({text}, '://') > 0 THEN substr({text}, instr({text}, '://') + 3) ELSE '' END"
    lower = lambda x: f"translate({x}, '{url_filter.UPPER}', '{url_filter.LOWER}')"
    hosts = sorted((r for r in url_filter.HOST_RULES), key=lambda r: -len(r.label))
    def fits(label: str) -> str:
        host, _, path = label.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"
    case = lambda value, rest: "CASE " + " ".join(f"WHEN {fits(r.label)} THEN '{value(r)}'" for r in hosts) + f" ELSE {rest} END"
    hits = lambda verdict: " + ".join(f"CAST(regexp_matches(folded, '{r.regex}') AS BIGINT)" for r in url_filter.PATTERN_RULES if r.verdict == verdict)
    return f"""
WITH u AS (SELECT page_id, url, {rest} AS rest, {lower(text)} AS folded FROM pages),
h AS (SELECT page_id, folded, {lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT *, {hits('block')} AS n_block, {hits('allow')} AS n_allow FROM h)
SELECT page_id, host, path, {case(lambda r: r.label, 'NULL')} AS rule,
       {case(lambda r: r.verdict, "CASE WHEN n_block > 0 AND n_allow = 0 THEN 'block' ELSE 'allow' END")} AS verdict, n_block, n_allow
FROM m"""


def _op2_sql() -> str:
    w = mixing.WEIGHTS
    weight = "CASE (i - 1) % 3 " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(w)) + " END"
    r = mixing.MAX_REPEATS
    taken = " + ".join(f"greatest(0, least(words, goal - gstart - {e} * source_size))" for e in range(r))
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
b AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM s),
c AS (SELECT *, {weight} AS w FROM b),
o AS (SELECT *, {r} * source_size AS cap,
        (sum(source_size) OVER () - coalesce(sum({r} * source_size) OVER before, 0)) AS left_over,
        (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS share
      FROM c WINDOW before AS (ORDER BY {r} * source_size / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CAST(left_over AS DOUBLE) / CAST(share AS DOUBLE) AS level FROM o),
f AS (SELECT (SELECT level FROM l WHERE cap > level * w ORDER BY cap / w, i LIMIT 1) AS level),
t AS (SELECT l.source, l.source_size, l.i, CASE WHEN f.level IS NULL OR (l.cap <= f.level * l.w AND l.cap <= l.level * l.w) THEN CAST(l.cap AS DOUBLE) ELSE f.level * l.w END AS target FROM l, f),
h AS (SELECT doc_id, source, size, count(*) AS n FROM d GROUP BY doc_id, source, size),
g AS (SELECT *, size * n AS words, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS rank FROM h),
p AS (SELECT g.*, t.source_size, t.target, t.i, CAST(floor(t.target) AS BIGINT) AS goal,
        coalesce(sum(words) OVER (PARTITION BY g.source ORDER BY g.rank, g.doc_id NULLS FIRST, g.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gstart
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, {taken} AS total FROM p),
e AS (SELECT *, unnest(range(n)) AS k FROM q),
z AS (SELECT *, total // n + CASE WHEN k < total % n THEN 1 ELSE 0 END AS mine, gstart + k * size AS begins, CASE WHEN i % 2 = 1 THEN 0.5 ELSE -0.5 END AS tilt FROM e)
SELECT doc_id, size, source_size, target, CAST(mine AS BIGINT) AS taken, CAST(begins AS BIGINT) AS start,
       CASE WHEN mine > 0 THEN (-(1.0 - tilt) + sqrt((1.0 - tilt) * (1.0 - tilt) + 4.0 * CAST(tilt AS DOUBLE) * least(1.0, CAST(begins AS DOUBLE) / greatest(target, 1.0)))) / (2.0 * tilt) END AS first_place
FROM z"""


def _op11_sql() -> str:
    k = phrases.LONGEST
    joined = lambda n: " || ' ' || ".join(["w", *[f"w{j}" for j in range(1, n)]])
    leads = ", ".join(f"lead(word, {j}) OVER piece AS w{j}" for j in range(1, k))
    grams = " UNION ALL ".join(f"SELECT lang, {n} AS words, {joined(n)} AS phrase FROM g WHERE w{n - 1} IS NOT NULL" for n in range(2, k + 1))
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS doc, coalesce(lang, '{phrases.NO_LANG}') AS lang,
             translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS t FROM documents),
p AS (SELECT doc, lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]'), 1) AS i FROM d),
l AS (SELECT doc, lang, i, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
o AS (SELECT doc, lang, i, unnest(ws) AS word, generate_subscripts(ws, 1) AS nr FROM l),
g AS (SELECT lang, word AS w, {leads} FROM o WINDOW piece AS (PARTITION BY doc, i ORDER BY nr)),
f AS (SELECT lang, 1 AS words, w AS phrase, CAST(count(*) AS HUGEINT) AS n FROM g GROUP BY lang, w
      UNION ALL SELECT lang, words, phrase, CAST(count(*) AS HUGEINT) FROM ({grams}) GROUP BY lang, words, phrase),
n AS (SELECT lang, CAST(count(*) AS HUGEINT) AS total FROM g GROUP BY lang),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND n >= {phrases.THRESHOLD}),
s AS (SELECT lang, a, unnest(list_transform(range(1, words - size + 2), lambda b: array_to_string(w[b:b + size - 1], ' '))) AS phrase
      FROM (SELECT *, unnest(range(2, words)) AS size FROM c)),
m AS (SELECT lang, phrase, max(a) AS longer FROM s GROUP BY lang, phrase),
x AS (SELECT c.*, unnest(range(1, words)) AS k FROM c LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {phrases.ABSORB_PERCENT} * a),
y AS (SELECT x.lang, x.phrase, x.a, x.k, u.n AS l, v.n AS r, total FROM x
      JOIN f u ON u.lang = x.lang AND u.phrase = array_to_string(x.w[1:x.k], ' ')
      JOIN f v ON v.lang = x.lang AND v.phrase = array_to_string(x.w[x.k + 1:], ' ') JOIN n ON n.lang = x.lang),
z AS (SELECT *, ({phrases.PER_MILLE} * a * total) // (l * r) AS score FROM y),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER best AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(total AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER best <= {phrases.BEST}"""


def _op12_sql() -> str:
    hard = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in HARD_CONVERSATION)
    escaped = lambda c: f"regexp_replace({c}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    marks = len(chat.TURN) + len(chat.SAYS) + len(chat.END)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES {hard})),
s AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
        sum({marks} + length({escaped('role')}) + length({escaped('text')})) AS chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM s"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": _op1_sql(), "op2_mixing": _op2_sql(), "op11_phrases": _op11_sql(), "op12_chat": _op12_sql()}
