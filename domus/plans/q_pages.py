"""Result-page extraction queries.

The driver's ``pages`` hold real links but no prices, so listing pages are
also *built* from ``orders`` (one page per order, in the query): item 1 at
the order's price in ``CHF 1,234.—`` form, item 2 at price + 500 in
``EUR 1234`` form (no suffix: every digit must survive), and a third link
that is either unpriced (status F: fewer prices than ids) or a repeat of
item 1 at price + 1 (status P: the last price wins). The oracle is the SQL
of the source rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.plans.registry import load, query
from domus.sources.pages import last_page, page_links, page_listings, unpaired_counts


def built_pages(spark, sf):
    # narrow rows are dealt over the cores before they grow into pages
    o = load(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)
    k = F.col("o_orderkey")
    p = F.round("o_totalprice").cast("bigint")

    def item(idx, price_html):
        return F.concat(F.lit('<div class="item"><a href="/buy/flat/'), (k * 10 + idx).cast("string"),
                        F.lit('">Flat</a>'), price_html, F.lit("</div>"))
    chf = F.concat(F.lit("<span>CHF "), F.format_number(p, 0), F.lit(".—</span>"))
    eur = F.concat(F.lit("<span>EUR "), (p + 500).cast("string"), F.lit("</span>"))
    rep = F.concat(F.lit("<span>CHF "), F.format_number(p + 1, 0), F.lit(".—</span>"))
    third = (F.when(F.col("o_orderstatus") == "F", item(3, F.lit("<span>on request</span>")))
             .when(F.col("o_orderstatus") == "P", F.concat(F.lit('<div class="item"><a href="/buy/flat/'),
                                                           (k * 10 + 1).cast("string"), F.lit('">Again</a>'), rep,
                                                           F.lit("</div>")))
             .otherwise(F.lit("")))
    nav = F.concat(F.lit('<nav><a href="?page=1">1</a><a href="?page=2">2</a>'),
                   F.when(k % 4 == 0, F.lit('<a href="?page=12">12</a>')).otherwise(F.lit("")),
                   F.when(k % 3 == 0, F.lit('<a href="?page=next">next</a>')).otherwise(F.lit("")),
                   F.lit("</nav>"))
    html = F.concat(F.lit("<html><body>"), F.when(k % 5 == 0, F.lit("")).otherwise(nav),
                    item(1, chf), item(2, eur), third, F.lit("</body></html>"))
    return o.select(k.alias("page_id"), F.concat(F.lit("https://example.com/buy?p="), k.cast("string")).alias("url"),
                    html.alias("html"))


@query("page_listings", ids="A8 E4 F20 D9 I3 I4 I5", bench=True, sql="""
SELECT CAST(o_orderkey * 10 + 1 AS VARCHAR) AS id,
       CAST(round(o_totalprice) AS BIGINT) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS price,
       o_orderkey AS page_id, 0 AS pos FROM orders
UNION ALL
SELECT CAST(o_orderkey * 10 + 2 AS VARCHAR), CAST(round(o_totalprice) AS BIGINT) + 500, o_orderkey, 1 FROM orders""")
def page_listings_q(spark, sf):
    return page_listings(built_pages(spark, sf), "/buy/")


@query("page_last", ids="A9", sql="""
SELECT o_orderkey AS page_id,
       CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 4 = 0 THEN 12 ELSE 2 END AS last_page FROM orders""")
def page_last_q(spark, sf):
    return built_pages(spark, sf).select("page_id", last_page("html").alias("last_page"))


@query("page_last_web", ids="A9", sql="""
SELECT page_id, coalesce(CAST(list_filter(regexp_extract_all(html, '<a[^>]*>([^<]{1,3})</a>', 1),
                                          lambda t: regexp_full_match(t, '[0-9]+'))[-1] AS INTEGER), 1) AS last_page
FROM pages""")
def page_last_web_q(spark, sf):
    return load(spark, sf, "pages").select("page_id", last_page("html").alias("last_page"))


@query("page_links", ids="D9 I4", sql="""
WITH l AS (SELECT page_id, list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1),
                                       lambda h: starts_with(h, '/')) AS hrefs FROM pages),
u AS (SELECT page_id, CAST(unnest(generate_series(0, len(hrefs) - 1)) AS INTEGER) AS pos, unnest(hrefs) AS href FROM l)
SELECT page_id, pos, href, nullif(regexp_extract(href, '(\\d+)', 1), '') AS digits FROM u""")
def page_links_q(spark, sf):
    return page_links(load(spark, sf, "pages"), "/")


def odd_pages(spark, sf):
    """Pages with an unpriced item in the middle, both kinds of quotes,
    amounts with spaces, and nested or padded page links."""
    o = load(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)
    k, p = F.col("o_orderkey"), F.round("o_totalprice").cast("bigint")
    spaced = F.replace(F.format_number(p, 0), F.lit(","), F.lit(" "))
    item = lambda n: (k * 10 + n).cast("string")
    html = F.concat(F.lit("<abbr>7</abbr><a href='/buy/a/"), item(1), F.lit("'>A</a><span class=\"p\">CHF "), spaced,
                    F.lit('.—</span><p>from CHF 1 per day</p><a href="/buy/b/'), item(2),
                    F.lit('">B</a><span>CHF on request</span><span>new</span><a href=\'/buy/c/'), item(3),
                    F.lit("'>C</a><span><b>EUR</b> "), (p + 7).cast("string"), F.lit("</span>"),
                    F.when(k % 2 == 0, F.lit('<a class="n"><span> 2 </span></a><a> 31 </a>')).otherwise(F.lit("<a>next</a>")))
    return o.select(k.alias("page_id"), html.alias("html"))


@query("page_listings_odd", ids="A8 E4 I5", sql="""
SELECT CAST(o_orderkey * 10 + 1 AS VARCHAR) AS id, CAST(round(o_totalprice) AS BIGINT) AS price, o_orderkey AS page_id, 0 AS pos FROM orders
UNION ALL
SELECT CAST(o_orderkey * 10 + 3 AS VARCHAR), CAST(round(o_totalprice) AS BIGINT) + 7, o_orderkey, 2 FROM orders""")
def page_listings_odd_q(spark, sf):
    return page_listings(odd_pages(spark, sf), "/buy/")


@query("page_unpaired", ids="A8 E4", sql="""
SELECT o_orderkey AS page_id, 3 AS n_links, 3 AS n_prices, 1 AS n_unpriced, 0 AS unpaired FROM orders""")
def page_unpaired_q(spark, sf):
    return unpaired_counts(odd_pages(spark, sf), "/buy/")


@query("page_last_odd", ids="A9", sql="""
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN 31 ELSE 1 END AS last_page FROM orders""")
def page_last_odd_q(spark, sf):
    return odd_pages(spark, sf).select("page_id", last_page("html").alias("last_page"))
