"""Listing-page extraction (A8, A9, E4, F20, D9, I3–I5) with built-in regular
expression functions only: no HTML parser, no Python per row.

A page is a row ``(page_id, url, html)``. Item links and prices are pulled
out as arrays, paired by position, and repeated ids resolved last-wins.
All of it is row-local except the final last-wins ``groupBy``, which is a
partial aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.functions.scalar import CURRENCIES, first_digit_run, price_after_currency

# an attribute in either kind of quotes; \\b keeps other tags that begin with "a" out
HREF_PATTERN = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
LINK_PATTERN = r"(?is)<a\b[^>]*>(.*?)</a>"
SPAN_PATTERN = r"(?is)<span\b[^>]*>(.*?)</span>"


def _text(c: F.Column) -> F.Column:
    """An element's text: tags removed, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))


def item_links(html_col: str, prefix: str) -> F.Column:
    """All hrefs that start with ``prefix`` (D9), in page order."""
    quoted = F.regexp_extract_all(F.col(html_col), F.lit(HREF_PATTERN), 0)
    hrefs = F.transform(quoted, lambda h: F.concat(F.regexp_extract(h, HREF_PATTERN, 1), F.regexp_extract(h, HREF_PATTERN, 2)))
    return F.filter(hrefs, lambda h: h.startswith(prefix))


def price_texts(html_col: str) -> F.Column:
    """A slot for every span that names a currency, in page order (I3, I5):
    its amount, or null where it names none ("CHF on request"). Spans of
    running text without a currency and text outside spans give no slot."""
    cur = "|".join(CURRENCIES)
    spans = F.transform(F.regexp_extract_all(F.col(html_col), F.lit(SPAN_PATTERN), 1), _text)
    return F.transform(F.filter(spans, lambda t: t.rlike(rf"\b(?:{cur})\b")), lambda t: price_after_currency(t))


def last_page(html_col: str) -> F.Column:
    """Number of the last result page (A9): the last link whose text (nested
    tags and padding aside) is a number of 1–3 digits; 1 when there is none."""
    texts = F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK_PATTERN), 1), _text)
    digits = F.filter(texts, lambda t: t.rlike(r"^[0-9]{1,3}$"))
    return F.coalesce(F.try_element_at(digits, F.lit(-1)).cast("int"), F.lit(1))


def page_listings(pages: DataFrame, prefix: str, page_key: str = "page_id", html_col: str = "html",
                  rent_or_buy: str | None = None) -> DataFrame:
    """Listing rows out of result pages (A8): id = first digit run of an item
    link (I4), price = the amount at the same position (E4). Ids without a
    price at their position are left out and counted by
    :func:`unpaired_counts`; a repeated id keeps the *last* price and its
    first position (F20). Returns (id, price, page_id, pos)."""
    d = pages.select(F.col(page_key), item_links(html_col, prefix).alias("__ids"),
                     price_texts(html_col).alias("__prices"))
    z = d.select(page_key, F.posexplode(F.arrays_zip(F.col("__ids").alias("link"),
                                                     F.col("__prices").alias("price"))).alias("pos", "z"))
    z = z.where(F.col("z.link").isNotNull() & F.col("z.price").isNotNull())
    z = z.select(page_key, "pos", first_digit_run("z.link").alias("id"), F.col("z.price").alias("price")).where(F.col("id").isNotNull())
    order = F.struct(F.col(page_key), F.col("pos"))
    out = z.groupBy("id").agg(F.max_by("price", order).alias("price"), F.min(order).alias("__first"))
    out = out.select("id", "price", F.col("__first")[page_key].alias(page_key), F.col("__first.pos").alias("pos"))
    if rent_or_buy is not None:
        out = out.withColumn("rentOrBuy", F.lit(rent_or_buy))
    return out


def unpaired_counts(pages: DataFrame, prefix: str, page_key: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page: item links and price slots found, slots without an amount,
    and how many links or slots have no partner at their position."""
    prices = price_texts(html_col)
    d = pages.select(page_key, F.size(item_links(html_col, prefix)).alias("n_links"), F.size(prices).alias("n_prices"),
                     F.size(F.filter(prices, lambda p: p.isNull())).alias("n_unpriced"))
    return d.withColumn("unpaired", F.abs(F.col("n_links") - F.col("n_prices")))


def page_links(pages: DataFrame, prefix: str = "/", page_key: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per link with the prefix: (page_id, pos, href, first digit run)."""
    d = pages.select(page_key, F.posexplode(item_links(html_col, prefix)).alias("pos", "href"))
    return d.withColumn("digits", first_digit_run("href"))
