"""HTML pages as data: tags, element extents and what lies inside them.

A page becomes one row per token (tag, comment or text).  Elements are found
by bracket matching: +1 for an opening and -1 for a closing tag, summed in
order per tag name, give every tag its level; an opening tag ends at the next
closing tag of its name and level.  Closing tags without an opening one are
ignored.  An element that is never closed ends where the element around it
does (a ``<p>`` at the next ``<p>`` if that comes first).  A second sum over
all extents gives each element's depth, which makes the parent of a place the
enclosing element one level up.

What lies in an element is an interval join of places and extents, by page
and by stretches of ``STRETCH`` tokens: its work is the pairs it returns, not
elements times places.

Pages are known by two hashes of their html, so pages that repeat are worked
off once and a page that is a third of the table is no hot key; null html has
no tokens.  Every window is of one page.  Script, style and comments hold no
text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import col, strip
from ..functions.dates import RX_DATA_DATE, first_parsed, text_candidates
from ..functions.html import NOISE_TAGS, cut, unescape
from ..session import shared_table

KEY = ["page_h1", "page_h2"]
STRETCH = 256
# Characters of html a task takes; pages of fewer are dealt over the cores, down to FEW_CHARS a task.
TASK_CHARS, FEW_CHARS = 4 << 20, 1 << 18
# Elements without content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
# Classes of the main text's and of a date's element.
CONTENT_CLASS = "content|article|post"
DATE_CLASS = "date|time|publish|posted|created|updated|meta"
DATE_ELEMENTS = ["span", "div", "p", "small", "li"]
# A tag with quoted values, a tag with an odd quote, a comment, text.
RX_TOKEN = r"""(?s)<!--.*?-->|<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|<[^<>]*+>|[^<]++|<"""
RX_NAME = r"^</?([A-Za-z][A-Za-z0-9:_-]*)"


def page_key(html: Column | str) -> list[Column]:
    """The columns by which a page's html is known."""
    h = col(html)
    return [F.xxhash64(h).alias(KEY[0]), F.xxhash64(F.crc32(h), F.length(h), h).alias(KEY[1])]


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag; NULL without it."""
    rx = rf"""(?is)[\t\n\f\r "']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, rx, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(rx), value)


def has_class(tag: Column, words: str) -> Column:
    """Some class of the tag holds one of the words, in any case."""
    return F.coalesce(attribute(tag, "class").rlike(f"(?i)({words})"), F.lit(False))


def distinct_pages(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, int]:
    """(page key, chars, html) of every distinct html, written once, and the
    number of tasks that work on it.  As tokens a page is many times its
    shuffled size, so tasks are dealt by characters of html, not left to the
    session's count of shuffle partitions or their bytes."""
    html = F.col(html_col)
    known = pages.where(html.isNotNull()).select(*page_key(html), html.alias("html")).groupBy(*KEY).agg(F.first("html").alias("html"))
    known = shared_table(known.select(*KEY, F.length("html").cast("long").alias("chars"), "html"), "html-pages")
    chars = known.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    cores = known.sparkSession.sparkContext.defaultParallelism
    return known, max(chars // TASK_CHARS, min(cores, chars // FEW_CHARS)) + 1


def tokens(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page key, size, i, token, name, sign) of every distinct html; i counts
    from 1 to size, the page itself starts at 0.  name is '' for text and
    comments; sign is 1 for an opening, -1 for a closing tag, else 0."""
    return _tokens(*distinct_pages(pages, html_col))


def _tokens(known: DataFrame, tasks: int) -> DataFrame:
    plain = F.col("html")
    for raw in ("script", "style"):
        plain = F.regexp_replace(plain, rf"(?is)<{raw}\b[^>]*>.*?</{raw}\s*>", "<!---->")
    split = known.repartition(tasks, *KEY).select(*KEY, F.regexp_extract_all(plain, F.lit(RX_TOKEN), 0).alias("all"))
    found = split.select(*KEY, F.size("all").alias("size"), F.posexplode("all").alias("place", "token"))
    named = found.select(*KEY, "size", (F.col("place") + 1).alias("i"), "token", F.lower(F.regexp_extract("token", RX_NAME, 1)).alias("name"))
    sign = (F.when((F.col("name") == "") | F.col("name").isin(VOID), 0).when(F.startswith("token", F.lit("</")), -1)
            .when(F.endswith("token", F.lit("/>")), 0).otherwise(1))
    return named.withColumn("sign", sign)


def _matched(stream: DataFrame) -> DataFrame:
    """(page key, size, i, token, name, sign, closed, end): the tags that open
    or close an element, an opening one with the place where it ends, and the
    texts between tags (name '', sign 0), stripped; none is empty.  All
    windows deal by the page key, so rows stay in the task of their page."""
    opens, shuts = F.col("sign") == 1, F.col("sign") == -1
    said = ~F.startswith("token", F.lit("<")) | (F.col("token") == "<")
    rows = stream.withColumn("token", F.when(said, strip(unescape("token"))).otherwise(F.col("token"))).where((F.col("sign") != 0) | (said & (F.col("token") != "")))
    by_name = Window.partitionBy(*KEY, "name").orderBy("i")
    rows = rows.withColumn("sum", F.sum("sign").over(by_name))
    rows = rows.withColumn("level", F.col("sum") - F.least(F.min("sum").over(by_name), F.lit(0)))
    rows = (rows.withColumn("before", F.lag("level", 1, 0).over(by_name)).where(~shuts | (F.col("before") > 0))
            .withColumn("level", F.when(shuts, F.col("before")).otherwise(F.col("level")))
            .withColumn("sibling", F.when(F.col("name") == "p", F.lead(F.when(opens, F.col("i"))).over(by_name))))
    pair = Window.partitionBy(*KEY, "name", "level").orderBy("i")
    rows = rows.withColumn("match", F.when(opens, F.when(F.lead("sign").over(pair) == -1, F.lead("i").over(pair))))

    # elements that are never closed end with the closed element around them
    closed = F.col("match").isNotNull() | shuts
    around = F.sum(F.when(closed, F.col("sign")).otherwise(0)).over(Window.partitionBy(*KEY).orderBy("i"))
    rows = rows.withColumn("closed", closed).withColumn("around", F.when(shuts, around + 1).otherwise(around))
    # read from the end: a frame up to the last row would be read again for every row
    later = Window.partitionBy(*KEY, "around").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, -1)
    up = F.min(F.when(shuts, F.col("i"))).over(later)
    end = F.coalesce("match", F.least(F.coalesce(up, F.col("size") + 1), F.coalesce("sibling", F.col("size") + 1)))
    return rows.withColumn("end", F.when(opens, end)).select(*KEY, "size", "i", "token", "name", "sign", "closed", "end")


def nodes(stream: DataFrame, noise: list[str] | None = None) -> DataFrame:
    """(page key, size, name, start, end, tag, text, depth, noisy): all
    elements and texts (name ''), depth the number of elements around them
    (an element counts itself), noisy the number of ``noise`` elements.
    An opening tag is the start of its element, its closing tag the end; only
    an element that is never closed takes a row more for its end."""
    rows = _matched(stream)
    lost = (F.col("sign") == 1) & ~F.col("closed")
    rows = rows.withColumn("ends", F.explode(F.when(lost, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    by = F.when(F.col("ends"), -1).otherwise(F.col("sign"))
    noisy = F.when(F.col("name").isin(noise or []), F.col("by")).otherwise(0)
    # at one place: what ends there is over before anything starts
    order = Window.partitionBy(*KEY).orderBy("at", F.when(F.col("by") == -1, -1).otherwise(0)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("by", by).withColumn("at", F.when(F.col("ends"), F.col("end")).otherwise(F.col("i")))
    rows = rows.withColumn("depth", F.sum("by").over(order).cast("int")).withColumn("noisy", F.sum(noisy).over(order).cast("int"))
    text = F.col("name") == ""
    return (rows.where("by >= 0").select(*KEY, "size", "name", F.col("i").alias("start"), "end", F.when(~text, F.col("token")).alias("tag"),
                                         F.when(text, F.col("token")).alias("text"), "depth", "noisy"))


def page_nodes(pages: DataFrame, html_col: str, noise: list[str] | None = None) -> tuple[DataFrame, int]:
    """The nodes of every distinct html outside the noise elements, written
    once, and the number of tasks that work on them."""
    known, tasks = distinct_pages(pages, html_col)
    return shared_table(nodes(_tokens(known, tasks), noise).where("noisy = 0"), "html-nodes"), tasks


def elements(stream: DataFrame) -> DataFrame:
    """(page key, name, start, end, depth, tag) of all elements; the
    outermost have depth 1."""
    return nodes(stream).where("name <> ''").select(*KEY, "name", "start", "end", "depth", "tag")


def _dealt(rows: DataFrame, keys: list[str], tasks: int | None) -> DataFrame:
    return rows if tasks is None else rows.repartition(tasks, *keys)


def containing(around: DataFrame, places: DataFrame, at: str = "i", also: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Interval join: rows of ``around`` (start, end) with the rows of
    ``places`` strictly inside them; columns in ``also`` must be equal."""
    keys = [*KEY, *(also or []), "stretch"]
    left = around.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("start") / STRETCH), F.floor(F.col("end") / STRETCH))))
    right = places.withColumn("stretch", F.floor(F.col(at) / STRETCH))
    return _dealt(left, keys, tasks).join(_dealt(right, keys, tasks), keys).where((F.col("start") < F.col(at)) & (F.col(at) < F.col("end"))).drop("stretch")


def _joined(rows: DataFrame, keys: list[str], sep: str, out: str, tasks: int | None = None) -> DataFrame:
    """Texts of each group in page order, joined; without ``tasks``, rows stay
    in the task of their page where they are dealt by it already."""
    parts = F.sort_array(F.collect_list(F.struct("i", "text")))
    return _dealt(rows, keys, tasks).groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["text"]), sep).alias(out))


def roots(found: DataFrame, tasks: int, with_div: bool = True) -> DataFrame:
    """(page key, root struct(rank, start, end)): the first article, else
    main, else (``with_div``) div of a content class, else body; dealt by
    page."""
    rank = F.when(F.col("name") == "article", 1).when(F.col("name") == "main", 2).when(F.col("name") == "body", 4)
    if with_div:
        rank = F.coalesce(rank, F.when((F.col("name") == "div") & has_class(F.col("tag"), CONTENT_CLASS), 3))
    ranked = found.select(*KEY, F.struct(rank.alias("rank"), "start", "end").alias("root")).where("root.rank IS NOT NULL")
    return _dealt(ranked, KEY, tasks).groupBy(*KEY).agg(F.min("root").alias("root"))


def _in_root(rows: DataFrame, root: DataFrame, at: str, tasks: int) -> DataFrame:
    """Rows inside their page's root (all of them without one), dealt by page."""
    return (_dealt(rows, KEY, tasks).join(root, KEY, "left")
            .where(F.col("root").isNull() | ((F.col("root.start") < F.col(at)) & (F.col(at) < F.col("root.end")))).drop("root"))


def main_texts(pages: DataFrame, n: int | None = None, html_col: str = "html") -> DataFrame:
    """The pages without their html and with main_text: noise elements
    dropped whole; root = article, main, div of a content class, body or
    page; its paragraphs over 20 characters joined by blank lines, else all
    its texts by line; first n characters (all without n)."""
    clean, tasks = page_nodes(pages, html_col, NOISE_TAGS)
    root = roots(clean, tasks)
    text = _in_root(_texts_of(clean), root, "i", tasks)
    paragraphs = _in_root(clean.where("name = 'p'").select(*KEY, "start", "end"), root, "start", tasks)
    paras = _joined(containing(paragraphs, text, tasks=tasks), [*KEY, "start"], "", "text", tasks).where(F.char_length("text") > 20).withColumnRenamed("start", "i")
    by_para, by_line = _joined(paras, KEY, "\n\n", "of_paras", tasks), _joined(text, KEY, "\n", "of_lines")
    whole = F.regexp_replace(F.coalesce("of_paras", "of_lines"), "\n{3,}", "\n\n")
    result = by_line.join(by_para, KEY, "left").select(*KEY, cut(whole, n).alias("found_text"))
    return _back(pages, result, html_col, "found_text", "main_text", F.lit(""))


def _texts_of(found: DataFrame) -> DataFrame:
    return found.where("name = ''").select(*KEY, F.col("start").alias("i"), "text")


def _back(pages: DataFrame, result: DataFrame, html_col: str, found: str, name: str, default: Column) -> DataFrame:
    """One row per page, without its html, with what was found."""
    keyed = pages.select(*[c for c in pages.columns if c != html_col], *page_key(html_col), F.col(html_col).isNull().alias("no_html"))
    value = F.when(~F.col("no_html"), F.coalesce(F.col(found), default))
    return keyed.join(result, KEY, "left").withColumn("found_value", value).drop(*KEY, "no_html", found).withColumnRenamed("found_value", name)


def visible_dates(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages without their html and with visible_date: elements of a
    date's class in page order, then elements with data-date, each by its
    data-date and then its text; last the first date that a pattern finds in
    the text of article, main, body or page."""
    found, tasks = page_nodes(pages, html_col)
    text = _texts_of(found)
    data = attribute(F.col("tag"), "data-date")
    classed = F.col("name").isin(DATE_ELEMENTS) & has_class(F.col("tag"), DATE_CLASS)
    kinds = F.filter(F.array(F.when(classed, 0), F.when(data.isNotNull(), 1)), lambda x: x.isNotNull())
    holders = found.where(classed | data.isNotNull()).select(*KEY, F.explode(kinds).alias("kind"), "start", "end", F.nullif(data, F.lit("")).alias("data"))
    own = _joined(containing(holders.select(*KEY, "start", "end").distinct(), text, tasks=tasks), [*KEY, "start"], "", "inside", tasks)
    dated = (holders.join(own, [*KEY, "start"], "left").select(*KEY, "kind", "start", first_parsed(F.array("data", "inside")).alias("day"))
             .where("day IS NOT NULL").groupBy(*KEY).agg(F.min_by("day", F.struct("kind", "start")).alias("of_element")))
    body = _joined(_in_root(text, roots(found, tasks, with_div=False), "i", tasks), KEY, " ", "body").select(*KEY, first_parsed(text_candidates(_squeezed("body"))).alias("of_text"))
    result = dated.join(body, KEY, "full").select(*KEY, F.coalesce("of_element", "of_text").alias("found_day"))
    return _back(pages, result, html_col, "found_day", "visible_date", F.lit(None))


def _squeezed(c: str) -> Column:
    return F.regexp_replace(F.col(c), "[\t\n\x0B\f\r ]+", " ")


def _before(rows: DataFrame, at: str, bounds: DataFrame, bound: str) -> DataFrame:
    """Rows that lie before the last ``bound`` of their page."""
    last = bounds.groupBy(*KEY).agg(F.max(bound).alias("last"))
    return rows.join(last, KEY).where(F.col(at) < F.col("last")).drop("last")


def context_dates(anchors: DataFrame, found: DataFrame, text: DataFrame, tasks: int, chars: int = 200) -> DataFrame:
    """anchors (page key, size, start, depth) -> (page key, start, ctx_date): the
    date of the parent, else of the grandparent.  An element's date is that
    of its first ``<time>`` (datetime, then text), else the first date that a
    pattern finds in the first ``chars`` characters of its text.  The page
    itself is the parent of the outermost elements."""
    top = anchors.select(*KEY, "size").distinct().select(*KEY, F.lit(0).alias("start"), (F.col("size") + 1).alias("end"), F.lit(0).alias("depth"))
    around = found.select(*KEY, "start", "end", "depth").unionByName(top)
    asked = (anchors.select(*KEY, F.col("start").alias("i"), F.col("depth").alias("own"), F.explode(F.array(F.lit(1), F.lit(2))).alias("up"))
             .withColumn("depth", F.col("own") - F.col("up")).where("depth >= 0"))
    # only what starts before a page's last anchor can hold one
    near = containing(_before(around, "start", asked, "i"), asked, also=["depth"], tasks=tasks)
    near = shared_table(near.select(*KEY, "start", "end", "i", "up"), "link-ancestors")
    text, times = (_before(rows, at, near, "end") for rows, at in ((text, "i"), (found.where("name = 'time'"), "start")))
    ancestors = near.select(*KEY, "start", "end").distinct()

    clock = times.select(*KEY, F.col("start").alias("i"), F.col("end").alias("time_end"), attribute(F.col("tag"), "datetime").alias("datetime"))
    first = (containing(ancestors, clock, tasks=tasks).groupBy(*KEY, "start")
             .agg(F.min(F.struct(F.col("i").alias("at"), "time_end", "datetime")).alias("clock")))
    marks = times.select(*KEY, "start", "end")
    said = _joined(containing(marks, text, tasks=tasks), [*KEY, "start"], "", "said", tasks).withColumnRenamed("start", "at")
    words = _joined(containing(ancestors, text, tasks=tasks), [*KEY, "start"], " ", "words", tasks)
    known = (ancestors.join(first, [*KEY, "start"], "left").join(words, [*KEY, "start"], "left")
             .withColumn("at", F.coalesce("clock.at", F.lit(0))).join(said, [*KEY, "at"], "left"))
    shown = F.concat(F.array("clock.datetime", "said"), text_candidates(F.substring(_squeezed("words"), 1, chars)))
    dated = known.select(*KEY, "start", first_parsed(shown).alias("day"))
    by_up = near.join(dated, [*KEY, "start"]).where("day IS NOT NULL")
    return by_up.groupBy(*KEY, F.col("i").alias("start")).agg(F.min_by("day", "up").alias("ctx_date"))


def links(listings: DataFrame, noise: list[str], html_col: str = "html") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(listing's columns but html, page key, size, start, depth, href, text):
    every anchor with an href outside the noise elements, its texts joined;
    and what gives any of them the date near it (page key, start, ctx_date)."""
    kept, tasks = page_nodes(listings, html_col, noise)
    text = _texts_of(kept)
    href = attribute(F.col("tag"), "href")
    anchors = kept.where((F.col("name") == "a") & href.isNotNull()).select(*KEY, "size", "start", "end", "depth", href.alias("href"))
    said = _joined(containing(anchors.select(*KEY, "start", "end"), text, tasks=tasks), [*KEY, "start"], "", "text", tasks)
    out = anchors.drop("end").join(said, [*KEY, "start"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    rest = [c for c in listings.columns if c != html_col]

    def dates(wanted: DataFrame) -> DataFrame:
        return context_dates(wanted.select(*KEY, "size", "start", "depth").distinct(), kept, text, tasks)
    return listings.select(*rest, *page_key(html_col)).join(out, KEY), dates
