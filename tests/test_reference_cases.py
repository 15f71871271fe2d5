"""Expected values worked out by hand from the rules, not from the engine's
patterns: listing layouts, link resolution, nested markup, dates, URLs, names,
and the shape of skewed joins."""

import datetime as dt

from conftest import one_col
from pyspark.sql import functions as F

from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.functions import text as T
from gleaner.functions import url as U
from gleaner.functions.common import strip
from gleaner.operators import blocks, health, report
from gleaner.operators.dedup import tag_duplicates
from gleaner.sources import feeds, pages, registry
from gleaner.spec import SourceSpec

AS_OF = dt.datetime(2026, 3, 8, 12, 0)

LISTING = """<html><body><nav><a href="/blog/nav-link-long">Navigation link text</a></nav>
<article><h3><a href="/blog/a">Heading link one</a></h3><time datetime="2026-03-02">x</time></article>
<article><h3><a href="/blog/b">Heading link two</a></h3><p>March 3, 2026</p></article>
<ul><li><time datetime="2026-03-04"></time><a href="../blog/c">List item link</a></li><li><a href="/blog/d">Undated list item</a></li></ul>
<table><tr><td><a href="./x/../e">Table row link</a></td><td>2026-03-05</td></tr><tr><td><a href="f">Second table row</a></td><td>Mar 6, 2026</td></tr></table>
<div class="grid"><div class="card"><div><a href="/blog/g">Card number one</a></div><p>2026-03-07</p></div>
<div class="card"><div><a href="/blog/h">Card number two</a></div><p>undated</p></div></div></body></html>"""


def test_listing_layouts(spark):
    df = spark.createDataFrame([("https://ex.com/list/all", LISTING)], "listing_url string, html string")
    got = {r.href: r.ctx_date and r.ctx_date.isoformat() for r in pages.extract_links(df).collect()}
    assert got == {"https://ex.com/blog/a": "2026-03-02", "https://ex.com/blog/b": "2026-03-03", "https://ex.com/blog/c": "2026-03-04",
                   "https://ex.com/blog/d": "2026-03-04", "https://ex.com/list/e": "2026-03-05", "https://ex.com/list/f": "2026-03-06",
                   "https://ex.com/blog/g": "2026-03-07", "https://ex.com/blog/h": None}


def test_dot_segments(spark):
    cases = [("../blog/x", "https://ex.com/blog/x"), ("../../../x/y", "https://ex.com/x/y"), ("./a/./b", "https://ex.com/list/a/b"),
             ("a/b/../c?q=../z", "https://ex.com/list/a/c?q=../z"), ("/a/../b/..", "https://ex.com/"), ("..", "https://ex.com/"), (".", "https://ex.com/list/")]
    df = spark.createDataFrame([("https://ex.com/list/all", h) for h, _ in cases], "b string, h string")
    assert [r.u for r in df.select(pages.resolve(F.col("b"), F.col("h")).alias("u")).collect()] == [u for _, u in cases]


def test_scan_listing_has_no_caps_and_takes_limits(spark):
    many = "".join(f'<li><a href="/blog/{i}">Link text number {i}</a></li>' for i in range(120))
    lst = spark.createDataFrame([("https://ex.com/list/all", many)], "listing_url string, html string")
    pg = spark.createDataFrame([(i, f"https://ex.com/blog/{i}", '<time datetime="2026-03-05"></time>') for i in range(60)], "page_id long, url string, html string")
    rows = pages.scan_listing(lst, pg, AS_OF, 7, label="L", source_ord=4).collect()
    assert len(rows) == 120 and sum(r.date_method == "page" for r in rows) == 60
    assert all((r.source, r.source_ord, r.fetched_at) == ("L", 4, AS_OF) for r in rows)
    few = pages.scan_listing(lst, pg, AS_OF, 7, max_links=30, max_lookups=15).collect()
    assert len(few) == 30 and sum(r.date_method == "page" for r in few) == 15


def test_main_text_of_nested_divs(spark):
    page = ('<body><div class="post-content"><div class="byline">By A</div><p>The first paragraph is long enough.</p>'
            "<div><p>The second paragraph is long as well.</p></div></div></body>")
    assert one_col(spark, [page], H.main_text) == ["The first paragraph is long enough.\n\nThe second paragraph is long as well."]
    long = "<article><p>" + "word " * 2000 + "end</p></article>"
    assert one_col(spark, [long], H.main_text)[0].endswith("word end")


def test_visible_dates_take_each_element_in_turn(spark):
    pages_ = ['<span class="date" data-date="2026-03-01">March 5, 2026</span>', '<span class="date">2026-03-02</span><i data-date="2026-03-09"></i>',
              '<div class="meta"><span class="date">2026-03-03</span> by A</div>', '<b data-date="none">2026-03-04</b>',
              "<article><p>" + "prose " * 900 + " seen on 2026-03-06 there</p></article>"]
    assert [d.isoformat() for d in one_col(spark, pages_, D.from_visible_text)] == ["2026-03-01", "2026-03-02", "2026-03-03", "2026-03-04", "2026-03-06"]


def test_url_without_authority_and_strip(spark):
    assert one_col(spark, ["x/y", "mailto:a@b.c", "HTTPS://Ex.com/a/"], U.normalize_url) == ["x/y", "mailto:a@b.c", "https://ex.com/a"]
    assert one_col(spark, ["　 a b \n"], strip) == ["a b"]


def test_natural_order_of_long_numbers(spark):
    names = ["p" + "9" * 40, "p" + "1" + "0" * 40, "p2", "p10", "P010", "p", "q1"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(T.natural_key("n"), "n").collect()]
    assert got == ["p", "p2", "P010", "p10", "p" + "9" * 40, "p1" + "0" * 40, "q1"]
    assert one_col(spark, ["s" + "0" * 50 + "12", "0", "none"], blocks.slide_caption) == ["Slide 12", "Slide 0", "none"]
    files = spark.createDataFrame([(n,) for n in ("a.PNG", "b.pdf", "c.webp", "dpng")], "n string")
    assert sorted(r.n for r in blocks.image_files(files, "n").collect()) == ["a.PNG", "c.webp"]


ATOM_FEED = """<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>An Atom feed</title>
<entry><title> One </title><link href="https://ex.com/1" rel="alternate"/><updated>2026-03-07T10:00:00Z</updated><content type="html">Body one</content></entry>
<entry><title>Old</title><link href="https://ex.com/2"/><published>2026-01-07T10:00:00Z</published><summary>s</summary></entry></feed>"""


def test_atom_feed_under_type_rss_and_many_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.xml").write_text(ATOM_FEED.replace("ex.com/", f"ex.com/{i}/"))
    df = feeds.scan_rss(spark, str(tmp_path), label=None, url="u", as_of=AS_OF, window_days=7)
    rows = df.collect()
    assert sorted((r.url, r.title, r.excerpt, r.source) for r in rows) == [(f"https://ex.com/{i}/1", "One", "Body one", "An Atom feed") for i in range(3)]
    tagged = tag_duplicates(df.withColumn("url_hash", U.url_hash("url")).repartition(3), None)      # any position fits
    assert tagged.where("dup IS NULL").count() == 3


def test_registry_scans_lists_and_urls(spark, tmp_path):
    site = "https://ex.com/list/all"
    spark.createDataFrame([(0, site, LISTING), (1, "https://ex.com/blog/d", "<meta name='date' content='2026-03-06'>")],
                          "page_id long, url string, html string").write.parquet(str(tmp_path / "pages"))
    specs = [SourceSpec(type="html_list", url=site, label="list"), SourceSpec(type="manual_urls", urls=["https://ex.com/blog/d", "https://ex.com/2026/03/05/x"])]
    rows = registry.scan_all(spark, specs, AS_OF, 7, landed=lambda s: str(tmp_path / "pages")).collect()
    by = {(r.source, r.url): str(r.publish_date) for r in rows}
    assert len(rows) == 10 and by[("list", "https://ex.com/blog/d")] == "2026-03-04" and by[("list", "https://ex.com/blog/h")] == "2026-03-08"
    assert by[("manual", "https://ex.com/2026/03/05/x")] == "2026-03-05" and by[("manual", "https://ex.com/blog/d")] == "2026-03-06"


def _largest_share(df, payload):
    """Rows of the largest task after a join, as a multiple of the mean."""
    rows = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(payload)).collect()
    sizes = [r["n"] for r in rows]
    return max(sizes) / (sum(sizes) / len(sizes)), len(sizes)


def test_hot_keys_are_split(spark):
    """Half of all rows on one hash or source, broadcasts off: AQE splits the
    hot partition, since the facts are read from storage."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        items = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("url_hash"),
            F.lit(0).alias("source_ord"), F.col("id").alias("item_ord"), F.sha2(F.col("id").cast("string"), 512).alias("pad"))
        share, tasks = _largest_share(tag_duplicates(items, None), "pad")
        assert tasks > 8 and share < 3, (share, tasks)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_report_kinds_and_disabled_sources(spark):
    assert report.KINDS == {"weekly_intel": "weekly", "investment_memo": "memo", "company_dossier": "memo"}
    sources = spark.createDataFrame([("a", 0), ("b", 1)], "label string, source_ord int")
    counts = spark.createDataFrame([("a", 3)], "source string, n long")
    rows = health.fetch_outcomes(counts, sources.where("label <> 'b'"), "t", AS_OF).collect()
    assert [(r.source_id, r.success, r.item_count) for r in rows] == [("a", True, 3)]
