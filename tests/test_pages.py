"""Result-page extraction on the cases of FIXTURES §6."""

from domus.sources.pages import last_page, page_links, page_listings, unpaired_counts

PAGES = [
    (1, "u1", '<nav><a href="?p=1">1</a><a href="?p=2">2</a><a href="?p=12">12</a><a href="?n">next</a></nav>'
              '<a href="/buy/flat/1234">x</a><span>CHF 570,000.—</span>'
              '<a href="/buy/house/99">y</a><span>EUR 1250</span>'),
    (2, "u2", '<a href="/buy/flat/5">a</a><span>CHF 100.—</span><a href="/buy/flat/5">b</a><span>CHF 101.—</span>'
              '<a href="/buy/flat/6">c</a>'),
    (3, "u3", '<a href="/rent/flat/7">r</a><span>CHF 570,000</span><a>abc</a>'),
]


def test_listings(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r["id"]: (r["price"], r["page_id"], r["pos"]) for r in page_listings(df, "/buy/").collect()}
    assert got == {"1234": (570000, 1, 0), "99": (1250, 1, 1), "5": (101, 2, 0)}
    rent = {r["id"]: r["price"] for r in page_listings(df, "/rent/").collect()}
    assert rent == {"7": 570000}  # no ".—" suffix: every digit kept
    un = {r["page_id"]: r["unpaired"] for r in unpaired_counts(df, "/buy/").collect()}
    assert un[2] == 1


def test_last_page(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r["page_id"]: r["lp"] for r in df.select("page_id", last_page("html").alias("lp")).collect()}
    assert got == {1: 12, 2: 1, 3: 1}


def test_links(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = page_links(df, "/buy/").where("page_id = 2").orderBy("pos").collect()
    assert [r["digits"] for r in rows] == ["5", "5", "6"]


def test_price_after_currency(spark):
    from domus.functions.scalar import price_after_currency
    df = spark.createDataFrame([("CHF 570,000.—",), ("CHF 570,000",), ("EUR 1'250",), ("on request",)], "t string")
    assert [r[0] for r in df.select(price_after_currency("t")).collect()] == [570000, 570000, 1250, None]


def test_odd_slots(spark):
    rows = [(2**45, '<a href="/buy/1">a</a><span>CHF on request</span><a href=\'/buy/2\'>b</a><span>CHF 1 234 000.—</span>'),
            (2**45 + 1, '<abbr>9</abbr><a><span>2</span></a><a class="x"> 7 </a><span>EUR 5 20</span><p>CHF 3</p>')]
    df = spark.createDataFrame(rows, "page_id long, html string")
    assert {r["id"]: (r["price"], r["page_id"], r["pos"]) for r in page_listings(df, "/buy/").collect()} == {"2": (1234000, 2**45, 1)}
    assert [r[0] for r in df.orderBy("page_id").select(last_page("html")).collect()] == [1, 7]
    un = [tuple(r)[1:] for r in unpaired_counts(df, "/buy/").orderBy("page_id").collect()]
    assert un == [(2, 2, 1, 0), (0, 1, 0, 1)]
