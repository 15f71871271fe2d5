"""Main text by minimum cut, and the pipeline stage by stage."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import html_extract as H
from gleaner.llm.common import materialise

SF = "/root/testdata/sf0.001"


def test_min_cut_is_minimal():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randrange(1, 8)
        up, down = [[rnd.random() * 3 for _ in range(n)] for _ in range(2)]
        edges = [(a, b, rnd.random() * 2) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.5]
        def cost(side):
            return (sum(d if s else u for s, u, d in zip(side, up, down)) + sum(c for a, b, c in edges if side[a] != side[b]))
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(H.min_cut(list(up), list(down), edges)) == pytest.approx(best)


PAGE = """<!doctype html><html><head><title>T</title><style>p{x}</style><script>if (a < b) "<p>no</p>"</script></head>
<body class="post"><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b">Blog</a></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please accept them, now.</p></div>
<div id="content"><article><h1>Real &amp; title</h1><p>First <b>para</b>graph&nbsp;here.
   Second&#32;line.</p><div class="ad-box">Buy this, now!</div><p>Tiny.<p>An <a href="x">inline link</a> inside a long sentence, which goes on.
<form><label>Mail</label><input><p>Subscribe to our letter.</p></form><blockquote>Quoted words.</blockquote>
<section class="comments"><h2>Comments</h2><article class="comment"><p>I like it, very much indeed.</p></article></section></article></div>
<aside><div class="body"><p>Related stories you may like.</p></div></aside><footer><p>&copy; 2024 Owner.</p></footer><!-- <p>gone</p> --></body></html>"""
TEXT = ("Real & title First paragraph here. Second line. Tiny. An inline link inside a long sentence, which goes on. Quoted words.")


def test_page_with_everything():
    assert H.main_text(PAGE, H.START) == TEXT


def test_blocks_of_odd_markup():
    texts = [b.text for b in H.blocks_of("a<br>b<p>c < d</p></div><b>e<i>f</b> g</i><td>h</table><p x='>'>i</p><unclosed")]
    assert texts == ["a", "b", "c < d", "ef g", "h", "i", "<unclosed"]
    assert H.blocks_of("") == [] and H.blocks_of("<p> &nbsp; </p>") == [] and H.blocks_of("<script>x") == []


BODY = "<article><p>The long article text, with a sentence or two. It goes on.</p></article>"
SEEN = "The long article text, with a sentence or two. It goes on."


def test_hidden_elements_end_as_shown_ones_do():
    for page in ('<ul><li style="display:none">x<li>y</ul>' + BODY, "<nav><p hidden>a<p>b</p></nav>" + BODY, "<div hidden><div>a</div>b</div>" + BODY,
                 '<p>' + BODY.replace("long", '<span hidden>not <b>shown</b></span>long'), "<head><title>t</title><link rel=x><body>" + BODY,
                 "<div><button>press<button>me</div>" + BODY, "<select><option>1<option>2</select>" + BODY, "<table><tr hidden><td>a<tr><td></table>" + BODY):
        assert H.main_text(page, H.START) == SEEN, page


def test_one_word_of_a_class_name_does_not_decide():
    text = "A paragraph of the text, long enough to be one. It has two sentences, even."
    for open_, shut in (('<div class="widget-area content">', "</div>"), ('<div class="social-science">', "</div>"), ('<article class="comment-on-politics">', "</article>")):
        assert H.main_text(f"<nav>Menu</nav>{open_}<p>{text}</p>{shut}<div class='site-footer'>{text}</div>", H.START) == text, open_
    assert H.main_text(f"<p>{text}</p><p>Copyright 2024 Owner. All rights reserved</p>", H.START) == text
    assert H.main_text(f"<article><p>{text}</p></article><section><article class='comment'><p>{text} no</p></article></section>", H.START) == text


def test_the_fit_does_not_see_its_label():
    rnd = np.random.default_rng(5)
    blocks = [H.Block(t, (0,), cue, link, False, False) for cue, t, link in
              [(1, "A long sentence, with commas, and an end. And another one, too.", 0.05), (-1, "Home", 1.0), (1, "Short but real.", 0.0), (-1, "Buy now", 0.7)] * 30]
    x, y = np.array([H.features(b) for b in blocks]) + 0, np.array([float(b.cue > 0) for b in blocks])
    w = H.fit(x, y)
    assert (w[list(H.CUES)] == H.START[list(H.CUES)]).all() and abs(w - H.START).max() > 0.3
    flipped = x.copy()
    flipped[:, H.CUES] = rnd.random((len(x), 2))
    assert np.allclose(H.fit(flipped, y), w)


def test_extract_rows_and_edges(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = H.train(pages)
    rows = {r["page_id"]: r for r in H.extract(pages, weights).collect()}
    import html
    for p in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())
        assert rows[p["page_id"]]["text"] == want and rows[p["page_id"]]["n_chars"] == len(want)
    odd = spark.createDataFrame([(1, "u", None, 0), (1, "u", None, 0), (None, None, "", 1), (2, "u", "<p>" * 20_000 + "x", 1), (3, "u", PAGE, 1)],
                                "page_id long, url string, html string, n_chars int")
    got = sorted((r["page_id"] or 0, r["text"]) for r in H.extract(odd, H.train(odd)).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and [g[1] for g in got[:3]] == ["", "", ""] and got[4][1] == TEXT
    assert H.extract(odd.limit(0), H.train(odd.limit(0))).collect() == []


LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_stages_against_brute_force(spark):
    """Each stage over all its predecessor kept, from the real table with a
    few odd rows; decisions checked by plain Python."""
    real = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "src1", None), (9002, "123 ...", None, None, 7), (9003, "", "en", "src2", 0), (None, "The house of the nation is here", "en", None, 5)],
                                real.schema)
    docs = real.unionByName(odd)
    names = dict(corpus_pipeline.STAGES)
    told = names["language ID"](spark, docs, SF)
    assert told.columns == docs.columns and sorted(-1 if r[0] is None else r[0] for r in told.select("doc_id").collect()) == sorted([-1] + [r[0] for r in real.select("doc_id").collect()])
    kept = names["n-gram Jaccard join"](spark, told, SF)
    sets = {r["doc_id"]: _shingles(r["text"]) for r in told.collect() if r["doc_id"] is not None}
    up = {i: i for i in sets}

    def find(x):
        return x if up[x] == x else find(up[x])
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            up[max(find(a), find(b))] = min(find(a), find(b))
    assert sorted(-1 if r[0] is None else r[0] for r in kept.select("doc_id").collect()) == sorted([-1] + [i for i in sets if up[i] == i])
    clean = names["benchmark decontamination"](spark, kept, SF)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in kept.collect() if any(t in r["text"] for t in items)}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in kept.collect()} - holds and holds
    mixed = names["mixing sources"](spark, clean, SF)
    assert mixed.columns == docs.columns
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) <= 3 and times == collections.Counter(r["doc_id"] for r in names["mixing sources"](spark, clean, SF).collect())
    last = names["sharding"](spark, mixed, SF).collect()
    assert collections.Counter(r["doc_id"] for r in last) == times
    sizes = collections.Counter(r["shard"] for r in last)
    assert max(sizes.values()) - min(sizes.values()) <= 1


CLASHES = ["lang_pred", "score", "leaked", "item_id", "n_items", "id", "s", "times", "take_h", "_h", "_copy", "copy", "row_h", "tag", "gone_id",
           "component_id", "node", "size", "shard", "kept__0"]


def test_stages_keep_extra_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs = materialise(docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]), "clashes")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHES), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 40


def test_near_copies_stage_judges_rows_of_an_id_by_their_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 2), (2, a + " more", "en", "s", 3), (7, b + " more", "en", "s", 4), (None, a, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF)
    assert sorted(r["n_chars"] for r in kept.collect()) == [2, 3, 5]


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_run_is_registered(spark):
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in entry.queries()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 50
