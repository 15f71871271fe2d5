"""Regex-based HTML extraction.

No DOM parser: pages are reduced with ordered ``regexp_replace`` passes
(comments, script/style, noise elements) and fields are taken with
``regexp_extract``.  Text of an element is its text nodes, each stripped,
concatenated (the DOM's ``get_text(strip=True)``); entities are decoded
for the common named forms.  The patterns are module constants so the SQL
oracle uses the very same ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import cached, col, strip

# Named entities decoded in page text ('&amp;' last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
# Elements dropped with their content before text extraction.
NOISE_TAGS = ["nav", "footer", "aside", "header", "script", "style", "noscript", "iframe"]

RX_COMMENT = r"(?s)<!--.*?-->"
RX_TAG = r"<[^>]+>"
RX_TITLE = r"(?is)<title\b[^>]*>(.*?)</title>"
RX_H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"
RX_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article>"
RX_MAIN = r"(?is)<main\b[^>]*>(.*?)</main>"
RX_CONTENT_DIV = r"""(?is)<div\b[^>]*\bclass\s*=\s*["'][^"']*(content|article|post)[^"']*["'][^>]*>(.*)"""
RX_BODY = r"(?is)<body\b[^>]*>(.*)"
RX_P_OPEN = r"(?i)<p\b[^>]*>"
RX_P_CLOSE_REST = r"(?is)</p>.*$"
RX_META_CONTENT = r"""(?i)\bcontent\s*=\s*["']([^"']*)["']"""


def rx_element(tag: str) -> str:
    return rf"(?is)<{tag}\b[^>]*>.*?</{tag}>"


def rx_meta(attr: str, value: str) -> str:
    return rf"""(?i)<meta\b[^>]*\b{attr}\s*=\s*["']{value}["'][^>]*>"""


def unescape(c: Column | str) -> Column:
    out = col(c)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def drop_elements(html: Column | str, tags: list[str]) -> Column:
    out = F.regexp_replace(col(html), RX_COMMENT, "")
    for t in tags:
        out = F.regexp_replace(out, rx_element(t), "")
    return out


def node_text(fragment: Column) -> Column:
    """Text nodes of a fragment, each stripped and unescaped, concatenated."""
    return F.array_join(F.transform(F.split(fragment, RX_TAG), lambda x: strip(unescape(x))), "")


def node_lines(fragment: Column) -> Column:
    """Non-empty stripped text nodes joined by newlines."""
    nodes = F.transform(F.split(fragment, RX_TAG), lambda x: strip(unescape(x)))
    return F.array_join(F.filter(nodes, lambda x: x != ""), "\n")


def meta_content(html: Column, attr: str, value: str) -> Column:
    tag = F.regexp_extract(html, rx_meta(attr, value), 0)
    return F.regexp_extract(tag, RX_META_CONTENT, 1)


@cached
def page_title(html: Column | str) -> Column:
    """og:title -> <title> -> first <h1> -> ''."""
    h = drop_elements(html, ["script", "style"])
    og = strip(unescape(meta_content(h, "property", "og:title")))
    title = strip(unescape(F.regexp_extract(h, RX_TITLE, 1)))
    h1 = node_text(F.regexp_extract(h, RX_H1, 1))
    return F.coalesce(F.nullif(og, F.lit("")), F.nullif(title, F.lit("")), h1)


def cut(c: Column, n: int | None) -> Column:
    """First n characters; all of them without n."""
    return c if n is None else F.substring(c, 1, n)


@cached
def meta_description(html: Column | str, n: int | None = None) -> Column:
    """og:description, else meta description; stripped; first n chars (all
    without n); NULL if none."""
    h = col(html)
    og = strip(unescape(meta_content(h, "property", "og:description")))
    desc = strip(unescape(meta_content(h, "name", "description")))
    return cut(F.coalesce(F.nullif(og, F.lit("")), F.nullif(desc, F.lit(""))), n)


@cached
def main_text(html: Column | str, n: int | None = None) -> Column:
    """Readable text: noise elements dropped; root = article -> main ->
    div with class content/article/post (from its opening tag on, so nested
    divs stay inside) -> body; paragraphs over 20 chars joined by a blank
    line, else all text lines; first n chars (all without n)."""
    h = drop_elements(html, NOISE_TAGS)
    root = F.coalesce(F.nullif(F.regexp_extract(h, RX_ARTICLE, 1), F.lit("")),
                      F.nullif(F.regexp_extract(h, RX_MAIN, 1), F.lit("")),
                      F.nullif(F.regexp_extract(h, RX_CONTENT_DIV, 2), F.lit("")),
                      F.nullif(F.regexp_extract(h, RX_BODY, 1), F.lit("")), h)
    pieces = F.slice(F.split(root, RX_P_OPEN), 2, 1 << 30)
    paras = F.filter(F.transform(pieces, lambda x: node_text(F.regexp_replace(x, RX_P_CLOSE_REST, ""))),
                     lambda x: F.length(x) > 20)
    text = F.when(F.size(paras) > 0, F.array_join(paras, "\n\n")).otherwise(node_lines(root))
    return cut(F.regexp_replace(text, "\n{3,}", "\n\n"), n)


@cached
def page_excerpt(html: Column | str, n: int | None = None) -> Column:
    """Meta description, else the main text (first n chars, all without n);
    NULL when empty."""
    return F.coalesce(meta_description(html, n), F.nullif(main_text(html, n), F.lit("")))
