"""Element extents, main text, visible dates and link contexts; every
expected value is worked out by hand."""

import random
import re
from html.parser import HTMLParser

import pytest

from gleaner.operators import markup as M
from gleaner.sources import pages

LONG = "a paragraph of more than twenty characters"


def _pages(spark, htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string").repartition(3)


def _main(spark, htmls):
    return [r.main_text for r in M.main_texts(_pages(spark, htmls)).orderBy("page_id").collect()]


def test_main_text_by_true_extents(spark):
    cases = [
        ("<article>A<article>B</article>C</article>", "A\nB\nC"),
        ("<body><nav>n<nav>m</nav>k</nav><aside><div>x</div></aside>Text</body>", "Text"),
        (f"<main><div><p>{LONG} 1</p></div></main><p>{LONG} 2</p>", f"{LONG} 1"),
        (f"<div class='post-content'><div>by</div><p>{LONG} 1</p><div><p>{LONG} <b>2</b></p></div></div><p>{LONG} 3</p>", f"{LONG} 1\n\n{LONG}2"),
        (f"<article><p>{LONG} 1<p>{LONG} 2</article><p>{LONG} 3", f"{LONG} 1\n\n{LONG} 2"),
        (f"<header><article><p>{LONG}</p></article></header><main><p>{LONG} main</p></main>", f"{LONG} main"),
        ("</div></p>stray<b>closing</b></i>tags", "stray\nclosing\ntags"),
        ("<body>a<!-- <p>no</p> -->b<script>if (a < b) { '<p>' }</script>c<style>p > a {}</style></body>", "a\nb\nc"),
        ('<body><img alt="x > y"><br/>one<input value=\'a>b\'>two &amp; three</body>', "one\ntwo & three"),
        (None, None), ("", ""), ("no tags < at all", "no tags\n<\nat all"),
        ("<footer>only noise</footer>", ""),
        ("<article>" + "<div>" * 400 + "deep" + "</div>" * 400 + "</article>", "deep"),
        (f"<body><p>{LONG}</p></body>", LONG), (f"<body><p>{LONG}</p></body>", LONG),
    ]
    assert _main(spark, [h for h, _ in cases]) == [w for _, w in cases]
    long = "<article><p>" + "word " * 40_000 + "end</p></article>"
    assert _main(spark, [long])[0].endswith("word end")
    assert M.main_texts(_pages(spark, ["<p>x</p>"]).limit(0)).collect() == []


def test_extra_columns_are_kept(spark):
    df = spark.createDataFrame([("k", "<p>x</p>", 1, "own", 2)], "page_id string, html string, i int, found_text string, page_h1 int")
    with pytest.raises(Exception):
        M.main_texts(df).collect()                    # the page key's own names are taken
    got = M.main_texts(df.drop("page_h1").withColumnRenamed("found_text", "text")).collect()
    assert [(r.page_id, r.i, r.text, r.main_text) for r in got] == [("k", 1, "own", "x")]


class _Tree(HTMLParser):
    """Extents by a stack, for markup in which every element is closed."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.at, self.stack, self.out = 0, [], []

    def handle_starttag(self, tag, attrs):
        self.at += 1
        self.stack.append((tag, self.at))

    def handle_endtag(self, tag):
        self.at += 1
        name, start = self.stack.pop()
        assert name == tag
        self.out.append((name, start, self.at, len(self.stack) + 1))

    def handle_data(self, data):
        self.at += 1


def test_extents_equal_a_stack(spark):
    rnd = random.Random(4)

    def grow(depth):
        parts = []
        for _ in range(rnd.randrange(0, 4)):
            name = rnd.choice(["div", "p", "b", "li", "article"])
            parts.append(rnd.choice(["", f"t{rnd.randrange(99)}"]))
            parts.append(f"<{name}>{grow(depth + 1)}</{name}>" if depth < 6 else "x")
        return "".join(parts)
    htmls = [f"<html>{grow(0)}{i}</html>" for i in range(60)]
    df = _pages(spark, htmls)
    keys = {(r[1], r[2]): r[0] for r in df.select("page_id", *M.page_key("html")).collect()}
    got = {}
    for r in M.elements(M.tokens(df)).collect():
        got.setdefault(keys[r["page_h1"], r["page_h2"]], []).append((r["name"], r["start"], r["end"], r["depth"]))
    for i, h in enumerate(htmls):
        tree = _Tree()
        tree.feed(h)
        tree.close()
        assert sorted(got[i]) == sorted(tree.out), h


def test_visible_dates(spark):
    cases = [
        ('<span class="date" data-date="2026-03-01">March 5, 2026</span>', "2026-03-01"),
        ('<span class="date">2026-03-02</span><i data-date="2026-03-09"></i>', "2026-03-02"),
        ('<div class="meta"><div>by</div><span class="date">2026-03-03</span> A</div>', "2026-03-03"),
        ('<div class="post-meta"><div>March 3,</div> <div>2026</div></div>', "2026-03-03"),
        ('<b data-date="none">2026-03-04</b>', "2026-03-04"),
        ("<article>x<article>y</article>" + "prose " * 900 + " seen on 2026-03-06 there</article><p>2026-03-07</p>", "2026-03-06"),
        ("<p class='meta'>none</p>", None), (None, None), ("", None),
    ]
    got = M.visible_dates(_pages(spark, [h for h, _ in cases])).orderBy("page_id").collect()
    assert [r.visible_date and r.visible_date.isoformat() for r in got] == [w for _, w in cases]


CARDS = """<div class="grid">
<div class="card"><div class="in"><div><h3><a href="/blog/a">Deeply nested card one</a></h3></div></div><time datetime="2026-03-01"></time></div>
<div class="card"><div><a href="/blog/b">Card with a dated parent</a><div><span>2026-03-02</span></div></div><time datetime="2026-03-09"></time></div>
<div class="card"><div><a href="/blog/c">Card of a dated grandparent</a></div><div><div><time>March 3, 2026</time></div></div></div>
<div class="card"><p><a href="/blog/d">An unclosed paragraph link</a><p>2026-03-04</div>
</div><a href="/blog/e">Right under the page itself</a>
<section><span><a href="/blog/f">Time that does not parse</a> on 2026-03-06</span><time datetime="soon">later</time></section>
<section><b><a href="/blog/g">Date beyond two hundred characters</a></b><p>""" + "filler words " * 30 + """2026-03-07</p></section>"""


def test_context_is_parent_then_grandparent(spark):
    df = spark.createDataFrame([("https://ex.com/list/all", CARDS), ("https://ex.com/list/no", None)], "listing_url string, html string")
    rows = sorted(pages.extract_links(df).collect(), key=lambda r: r.link_pos)
    got = {r.href[-1]: r.ctx_date and r.ctx_date.isoformat() for r in rows}
    # e: its parent is the page, whose first <time> is card one's
    assert got == {"a": None, "b": "2026-03-02", "c": "2026-03-03", "d": "2026-03-04", "e": "2026-03-01", "f": "2026-03-06", "g": None}
    assert [r.link_pos for r in rows] == list(range(1, 8))


def test_interval_join_returns_strict_containment(spark):
    rnd = random.Random(2)
    extents = [(1, 1, a, a + rnd.randrange(1, 3000)) for a in (rnd.randrange(5000) for _ in range(40))]
    places = [(1, 1, rnd.randrange(6000)) for _ in range(200)] + [(1, 2, 7)]
    got = M.containing(spark.createDataFrame(extents, "page_h1 long, page_h2 long, start int, end int"),
                       spark.createDataFrame(places, "page_h1 long, page_h2 long, i int")).collect()
    want = sorted((s, e, i) for _, _, s, e in extents for _, k, i in places if k == 1 and s < i < e)
    assert sorted((r["start"], r["end"], r["i"]) for r in got) == want


def test_tasks_follow_the_characters_of_html_not_the_session(spark, monkeypatch):
    """With one shuffle partition a page set still takes as many tasks as its html asks for."""
    monkeypatch.setattr(M, "TASK_CHARS", 2000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = M.tokens(_pages(spark, [f"<ul>{'<li>x</li>' * 60}{i}</ul>" for i in range(40)]))
        assert stream.rdd.getNumPartitions() >= 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_windows_of_a_page_neither_read_the_rest_again_nor_leave_its_task(spark):
    """No frame up to a page's last row (read again for every row), and one exchange from the pages to their nodes."""
    found = M.nodes(M.tokens(_pages(spark, ["<ul><li><p>a<p>b</li></ul>", "<b>x"])), ["nav"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan and plan.count("Exchange") == 1
    rows = {(r["name"], r["start"], r["end"], r["depth"]) for r in found.collect()}
    assert rows == {("ul", 1, 8, 1), ("li", 2, 7, 2), ("p", 3, 5, 3), ("p", 5, 7, 3), ("", 4, None, 3), ("", 6, None, 3), ("b", 1, 3, 1), ("", 2, None, 1)}


def test_first_links_have_the_same_places_and_dates(spark):
    """max_links drops later links and changes nothing of the first; a link of two pages of a listing keeps its first date."""
    df = spark.createDataFrame([("https://ex.com/list/all", CARDS), ("https://ex.com/list/two", '<p><a href="/blog/a">The same link twice</a><i>2026-03-09</i></p>'),
                                ("https://ex.com/list/two", '<p><a href="/blog/a">The same link twice</a><i>2026-03-05</i></p>')], "listing_url string, html string")
    every = [tuple(r) for r in pages.extract_links(df).collect()]
    assert sorted(tuple(r) for r in pages.extract_links(df, 3).collect()) == sorted(r for r in every if r[1] <= 3)
    assert [(r[1], str(r[4])) for r in every if r[0].endswith("two")] == [(1, "2026-03-05")]


@pytest.fixture
def dealt(spark, monkeypatch):
    """Tasks that wrote nodes, asked of small tasks in a session with a single shuffle partition."""
    real, seen = M.shared_table, []

    def shared(df, label):
        if label == "html-nodes":
            seen.append(df.rdd.getNumPartitions())
        return real(df, label)
    monkeypatch.setattr(M, "shared_table", shared)
    monkeypatch.setattr(M, "TASK_CHARS", 1000, raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield seen
    spark.conf.set("spark.sql.shuffle.partitions", before)


MANY = [f"<main><p>{LONG} {i}</p>{'<b>x</b>' * 50}</main>" for i in range(30)]


def test_main_text_is_dealt_by_characters(spark, dealt):
    assert sorted(_main(spark, MANY)) == sorted(f"{LONG} {i}" for i in range(30)) and min(dealt) >= 10


def test_page_excerpt_is_dealt_by_characters(spark, dealt, tmp_path):
    """A described page keeps its description; the others' main text takes the tasks its html asks for."""
    from gleaner.plans.catalog import page_excerpt
    htmls = [*MANY, "<meta name='description' content='said'><p>x</p>"]
    spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [r.excerpt for r in page_excerpt(spark, str(tmp_path)).orderBy("page_id").collect()]
    assert got == [f"{LONG} {i}" for i in range(30)] + ["said"] and min(dealt) >= 10


def _by_session(df):
    """Exchanges by page that the session's count of shuffle partitions deals."""
    return len(re.findall(r"hashpartitioning\(page_h1#\w+, page_h2#\w+, 3\)", df._jdf.queryExecution().executedPlan().toString()))


def test_texts_meet_their_root_in_tasks_dealt_by_characters(spark, dealt):
    """No text of a page is sorted in a task whose size the session's count decides: F2 to F5."""
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert _by_session(M.main_texts(_pages(spark, MANY))) == 0
    clean, tasks = M.page_nodes(_pages(spark, MANY), "html")
    assert tasks >= 10
    dates = M.visible_dates(_pages(spark, MANY))
    plan = dates._jdf.queryExecution().executedPlan().toString()
    texts = [x for x in re.findall(r"Exchange hashpartitioning\(page_h1#\w+, page_h2#\w+, (\d+)\)[^\n]*\n[^\n]*Project \[page_h1#\w+, page_h2#\w+, start#\w+ AS i#\w+, text", plan)]
    assert texts and "3" not in texts
    assert [r.main_text for r in M.main_texts(_pages(spark, MANY)).orderBy("page_id").collect()] == [f"{LONG} {i}" for i in range(30)]


def test_url_list_dates_are_dealt_by_characters(spark, dealt):
    """A URL list's visible dates take the tasks its pages' html asks for."""
    htmls = [f"<main><span class='date'>2026-03-{i % 28 + 1:02d}</span>{'<b>x</b>' * 50}{i}</main>" for i in range(30)]
    df = spark.createDataFrame([(i, f"https://ex.com/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string").repartition(3)
    got = pages.scan_urls(df.select(df.page_id.alias("url_ord"), "url"), df).orderBy("url_ord").collect()
    assert [str(r.publish_date) for r in got] == [f"2026-03-{i % 28 + 1:02d}" for i in range(30)] and min(dealt) >= 10


def test_listing_links_are_dealt_by_characters(spark, dealt):
    """Listing pages of a source take the tasks their html asks for."""
    htmls = [f"<ul><li><a href='/blog/2026/{i}'>Long enough title {i}</a><time>2026-03-01</time>{'<b>x</b>' * 50}</li></ul>" for i in range(30)]
    df = spark.createDataFrame([(f"https://ex.com/list/{i}", h) for i, h in enumerate(htmls)], "listing_url string, html string").repartition(3)
    got = pages.extract_links(df).collect()
    assert sorted(r.href for r in got) == sorted(f"https://ex.com/blog/2026/{i}" for i in range(30)) and min(dealt) >= 10
    assert {str(r.ctx_date) for r in got} == {"2026-03-01"}
