import datetime as dt

from conftest import one_col

from gleaner.functions import dates as D

d = dt.date


def test_parse_date_formats(spark):
    vals = ["2026-02-28T23:30:00+08:00", "Feb 28, 2026", "Feb 28 2026", "Feb. 28, 2026",
            "February 28, 2026", "28 Feb 2026", "2026/2/28", "2/28/2026", "2026-02-28 and more",
            "Sept 3, 2026", "", None, "2026-02-28.", " 2026-2-8 ", "2026-02-31", "feb 28, 2026",
            "28 February 2026", "2026-02-28 10:00:00"]
    got = one_col(spark, vals, D.parse_date)
    exp = [d(2026, 2, 28)] * 9 + [None, None, None, d(2026, 2, 28), d(2026, 2, 8), None,
                                   d(2026, 2, 28), d(2026, 2, 28), d(2026, 2, 28)]
    assert got == exp


def test_feed_date_utc(spark):
    vals = ["Tue, 03 Mar 2026 23:30:00 -0500", "Tue, 03 Mar 2026 10:00:00 GMT",
            "2026-03-03T23:30:00-05:00", "2026-03-03T10:00:00Z", "2026-03-03", "junk", None]
    got = one_col(spark, vals, D.feed_date)
    assert got == [d(2026, 3, 4), d(2026, 3, 3), d(2026, 3, 4), d(2026, 3, 3), d(2026, 3, 3), None, None]


def _page(meta=True, jsonld=True, time=True, visible=True):
    parts = ["<html><head>"]
    if meta:
        parts.append('<meta property="article:published_time" content="2026-01-01T08:00:00Z">')
    if jsonld:
        parts.append('<script type="application/ld+json">{"@type":"NewsArticle","datePublished":"2026-01-02"}</script>')
    parts.append("</head><body><article><h1>T</h1>")
    if time:
        parts.append('<time datetime="2026-01-03">Jan 3</time>')
    if visible:
        parts.append("<p>Posted on January 4, 2026 by someone</p>")
    parts.append("</article></body></html>")
    return "".join(parts)


def test_html_cascade_order(spark):
    vals = [_page(), _page(meta=False), _page(meta=False, jsonld=False),
            _page(meta=False, jsonld=False, time=False),
            _page(meta=False, jsonld=False, time=False, visible=False)]
    got = one_col(spark, vals, D.from_html)
    assert got == [d(2026, 1, 1), d(2026, 1, 2), d(2026, 1, 3), d(2026, 1, 4), None]


def test_meta_name_and_graph(spark):
    vals = ['<meta name="Sailthru.Date" content="2026-05-06 10:00:00">',
            '<script type="application/ld+json">[{"@graph":[{"x":1},{"dateCreated":"May 7, 2026"}]}]</script>',
            '<div class="post-meta">March 9, 2026</div>',
            '<span data-date="2026-03-10"></span>']
    got = one_col(spark, vals, D.from_html)
    assert got == [d(2026, 5, 6), d(2026, 5, 7), d(2026, 3, 9), d(2026, 3, 10)]


def test_resolve_date_and_method(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("<p>x</p>", "https://a.com/2026/01/05/x", "2026-01-06"),
                                ("<p>x</p>", "https://a.com/x", "Jan 7, 2026"),
                                (None, "https://a.com/x", None)], "h string, u string, r string")
    rows = df.select(D.resolve_date("h", "u", "r").alias("d"),
                     D.resolve_with_method("h", "u", "r")["method"].alias("m")).collect()
    assert [(r.d, r.m) for r in rows] == [(d(2026, 1, 5), "url"), (d(2026, 1, 7), "hint"), (None, "none")]


def test_jsonld_shapes(spark):
    """One object, a list, a graph, broken JSON, odd values, several scripts."""
    def page(*scripts):
        return "<html>" + "".join(f'<script type="application/ld+json">{s}</script>' for s in scripts) + "</html>"
    cases = [
        (page('{"datePublished": "2026-03-01", "dateModified": "2026-03-09"}'), "2026-03-01"),
        (page('  [{"x": 1}, {"dateCreated": "2026-03-02T10:00:00Z"}]\n'), "2026-03-02"),
        (page('{"@graph": [{"@type": "WebPage"}, {"nested": {"datePublished": "2026-01-01"}}, {"dateCreated": "2026-03-03"}]}'), "2026-03-03"),
        (page('{"@graph": {"datePublished": "2026-03-04"}}'), None),
        (page('{"datePublished": "2026-03-05", broken'), None),
        (page('{"datePublished": not json}', '{"dateModified": "March 6, 2026"}'), "2026-03-06"),
        (page('{"datePublished": null, "dateCreated": 7, "dateModified": {"y": 1}}'), None),
        (page('"2026-03-08"', "[]", "", "[1, null, [2]]", '{"datePublished": "2026-03-09"}'), "2026-03-09"),
        (page('[{"@graph": [{"datePublished": "2026-03-10"}]}]'), "2026-03-10"),
        (None, None),
    ]
    got = one_col(spark, [h for h, _ in cases], D.from_jsonld)
    assert [d and d.isoformat() for d in got] == [w for _, w in cases]
