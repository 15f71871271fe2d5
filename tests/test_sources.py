"""Landed XML fixtures for the feed, paper and sitemap scans, and the registry."""

import datetime as dt

from pyspark.sql import functions as F

from gleaner.sources import feeds, registry, sitemap
from gleaner.spec import SourceSpec

AS_OF = dt.datetime(2026, 3, 8, 12, 0)

RSS = """<?xml version="1.0"?>
<rss version="2.0"><channel><title> Example Feed </title>
<item><title> First post </title><link>https://ex.com/a/1</link><pubDate>Tue, 03 Mar 2026 23:30:00 -0500</pubDate>
<description>Summary one</description></item>
<item><title>No link</title><pubDate>Tue, 03 Mar 2026 10:00:00 GMT</pubDate></item>
<item><title>Undated</title><link>https://ex.com/a/2</link><description>kept</description></item>
<item><title>Old</title><link>https://ex.com/a/3</link><pubDate>Mon, 02 Feb 2026 10:00:00 GMT</pubDate></item>
<item><title>First post again</title><link>https://ex.com/a/1</link><pubDate>Wed, 04 Mar 2026 10:00:00 GMT</pubDate></item>
</channel></rss>"""

ATOM = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>1</id><title>A multi
line title</title><link href="https://arxiv.org/abs/1" rel="alternate"/><link href="https://arxiv.org/pdf/1" rel="related"/>
<published>2026-03-07T23:00:00Z</published><summary>Line one
line two</summary></entry>
<entry><id>2</id><title>Old paper</title><link href="https://arxiv.org/abs/2" rel="alternate"/>
<published>2026-01-01T00:00:00Z</published><summary>x</summary></entry>
</feed>"""

SITEMAP = """<?xml version="1.0"?>
<urlset>
<url><lastmod>2026-03-05</lastmod></url>
<url><loc>https://ex.com/news/big-model_release/</loc><lastmod>2026-03-05</lastmod></url>
<url><loc>https://ex.com/news/2026/03/06/dated-by-url</loc></url>
<url><loc>https://ex.com/news/undated</loc></url>
<url><loc>https://ex.com/blog/other-path</loc><lastmod>2026-03-05</lastmod></url>
<url><loc>https://ex.com/news/too-old</loc><lastmod>2026-01-05</lastmod></url>
</urlset>"""


def _write(tmp_path, name, body):
    p = tmp_path / name
    p.write_text(body)
    return str(p)


def test_rss(spark, tmp_path):
    path = _write(tmp_path, "feed.xml", RSS)
    df = feeds.scan_rss(spark, path, label=None, url="https://ex.com/feed", as_of=AS_OF, window_days=7)
    rows = df.orderBy("item_ord").collect()
    assert [(r.url, r.title) for r in rows] == [("https://ex.com/a/1", "First post"), ("https://ex.com/a/2", "Undated"),
                                               ("https://ex.com/a/1", "First post again")]
    assert rows[0].publish_date == dt.date(2026, 3, 4)        # shifted to UTC
    assert rows[1].publish_date is None and rows[1].excerpt == "kept"
    assert rows[0].source == "Example Feed"                   # channel title when unlabelled


def test_atom(spark, tmp_path):
    path = _write(tmp_path, "atom.xml", ATOM)
    rows = feeds.scan_atom(spark, path, query="cat:cs.CL", label=None, as_of=AS_OF, window_days=7).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.url, r.title, r.source) == ("https://arxiv.org/abs/1", "A multi line title", "arXiv:cat:cs.CL")
    assert r.publish_date == dt.date(2026, 3, 7) and r.excerpt == "Line one line two"


def test_sitemap(spark, tmp_path):
    path = _write(tmp_path, "sitemap.xml", SITEMAP)
    rows = sitemap.scan_sitemap(spark, path, label="sm", url=None, path_filter="/news/", as_of=AS_OF,
                                window_days=7).orderBy("item_ord").collect()
    assert [(r.url, r.title, str(r.publish_date)) for r in rows] == [
        ("https://ex.com/news/big-model_release/", "Big Model Release", "2026-03-05"),
        ("https://ex.com/news/2026/03/06/dated-by-url", "Dated By Url", "2026-03-06")]


def test_registry_isolates_failures(spark, tmp_path):
    good = _write(tmp_path, "feed.xml", RSS)
    specs = [SourceSpec(type="rss", url=good, label="good"), SourceSpec(type="nope", label="unknown"),
             SourceSpec(type="sitemap", url=str(tmp_path / "missing.xml"), label="missing")]
    df = registry.scan_all(spark, specs, AS_OF, 7, landed=lambda s: s.url or "")
    rows = df.groupBy("source", "source_ord").count().collect()
    assert [(r.source, r.source_ord, r["count"]) for r in rows] == [("good", 0, 3)]
    skipped = registry.scan_all(spark, specs, AS_OF, 7, landed=lambda s: s.url or "", disabled={"good"})
    assert skipped.count() == 0


def test_resolve_and_article_predicate(spark):
    from gleaner.sources.pages import is_likely_article, resolve
    base = "https://ex.com/blog/list"
    cases = [("https://other.org/a/b", "https://other.org/a/b"), ("//cdn.ex.com/x/y", "https://cdn.ex.com/x/y"),
             ("/news/2026/story", "https://ex.com/news/2026/story"), ("#top", "https://ex.com/blog/list#top"),
             ("?page=2", "https://ex.com/blog/list?page=2"), ("post-1", "https://ex.com/blog/post-1")]
    df = spark.createDataFrame([(base, h) for h, _ in cases], "b string, h string")
    assert [r.u for r in df.select(resolve(F.col("b"), F.col("h")).alias("u")).collect()] == [u for _, u in cases]
    rows = [("https://ex.com/news/a-story", "A long enough story title"),   # article
            ("https://ex.com/news/a-story", "About"),                       # navigation word
            ("https://ex.com/pricing", "A long enough story title"),       # one path segment
            ("https://ex.com/blog/list/", "A long enough story title"),    # the page itself
            ("https://ex.com/blog/list#x", "A long enough story title")]   # anchor into the page
    df = spark.createDataFrame([(base, h, t) for h, t in rows], "b string, h string, t string")
    got = [r.ok for r in df.select(is_likely_article("h", "t", "b").alias("ok")).collect()]
    assert got == [True, False, False, False, False]


def test_url_list_missing_page(spark):
    from gleaner.sources.pages import scan_urls
    pages = spark.createDataFrame([(1, "https://ex.com/a/b", "<html><head><title>T &amp; U</title></head>"
                                       "<body><time datetime='2026-03-01'></time></body></html>")],
                                  "page_id long, url string, html string")
    urls = spark.createDataFrame([(0, "https://ex.com/a/b"), (1, "https://ex.com/2026/03/02/gone")],
                                 "url_ord long, url string")
    rows = {r.url_ord: r for r in scan_urls(urls, pages).collect()}
    assert (rows[0].title, str(rows[0].publish_date)) == ("T & U", "2026-03-01")
    assert (rows[1].title, str(rows[1].publish_date), rows[1].raw_html) == (
        "https://ex.com/2026/03/02/gone", "2026-03-02", None)


def test_listing_goes_on_over_numbered_pages(spark, tmp_path):
    url = "https://ex.com/all/list"
    card = '<article><a href="../news/2026/{0}">Long enough title {0}</a><time datetime="2026-03-05"></time></article>'
    pages = [(-1, url, card.format(1) + card.format(2)), (-2, f"{url}?page=10", card.format(5)), (-3, f"{url}?page=2", card.format(3) + card.format(4)),
             (-4, f"{url}?page=x", card.format(6)), (-5, f"{url}s", card.format(7)), (8, "https://ex.com/news/2026/1", card.format(8)), (9, None, "")]
    path = str(tmp_path / "listing")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(path)
    got = registry.scan_source(spark, SourceSpec(type="html_list", label="listing", url=url), AS_OF, 7, 0, lambda s: path).orderBy("item_ord").collect()
    assert [r.url for r in got] == [f"https://ex.com/news/2026/{i}" for i in range(1, 6)]
    assert len({r.item_ord for r in got}) == 5


def test_landed_listing_pages_are_bounded(spark):
    """No row of the landed listing grows with the table."""
    from gleaner.plans import more_queries as M
    from gleaner.sources import adapters as A
    sf = "/root/testdata/sf0.1"
    landed = spark.read.parquet(M._land(spark, sf)["listing"]).where(F.startswith("url", F.lit(M.LANDED[4].url)))
    cards = [r.n for r in landed.select(F.size(F.split("html", "<article>")).alias("n")).collect()]
    assert sum(n - 1 for n in cards) == A.table(spark, sf, "pages").count()
    assert len(cards) > 1 and max(cards) - 1 <= A.LISTING_CHUNK


def test_dated_links_do_not_meet_in_one_task(spark):
    from gleaner.sources.pages import scan_listing
    card = '<article><a href="/news/2026/{0}">Long enough title {0}</a><time datetime="2026-03-05"></time></article>'
    listings = spark.createDataFrame([("https://ex.com/all/list", "".join(card.format(i) for i in range(200)))], "listing_url string, html string")
    pages = spark.createDataFrame([(1, "https://ex.com/a", "")], "page_id long, url string, html string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = [r["count"] for r in scan_listing(listings, pages, AS_OF, 7).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 200 and max(sizes) < 100
