"""Main text of web pages by a minimum cut.

A page is split into text blocks.  A logistic classifier gives each block a
probability of being content; the costs of calling it boilerplate or content
(negative logarithms) become the capacities of its edges to the source and
the sink.  Blocks that follow each other, and blocks that share a parent
element, are joined by smoothness edges, heavier the closer they are in the
element tree.  The blocks on the source's side of the minimum cut are the
main text: the labelling with the least sum of costs and broken ties.

The classifier has two parts.  What a block's own text looks like (links,
length, sentences, place) is learned here, on a bounded sample of pages whose
markup says what their blocks are: those whose nearest telling ancestor is an
article or main element are content; navigation, footers, asides, forms,
notices, adverts and comments boilerplate.  That label is no feature of the
fit; where a page has it, it enters the cost with a fixed weight.  Without any
page that tells, the starting weights are used.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that separate blocks, that hold no visible text, and that never close.
BLOCK_TAGS = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
HIDDEN_TAGS = frozenset("script style head title noscript template textarea select svg math iframe object audio video canvas button".split())
RAW_TAGS = frozenset("script style textarea title iframe noscript template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
AUTO_CLOSED = {"p": "p", "li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}
NEGATIVE_TAGS = frozenset("nav footer aside form menu dialog button label fieldset".split())
POSITIVE_TAGS = frozenset(("article", "main"))
# Words in class, id and role that tell what an element is for.
NEGATIVE_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
notice notification alert menu nav navbar navigation sidebar aside footer breadcrumb breadcrumbs comment comments reply replies disqus
share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar search
pagination pager copyright complementary contentinfo form masthead topbar""".split())
POSITIVE_WORDS = frozenset("article post entry story content body text main".split())
# Parts of a class name that say nothing by themselves.
PLAIN_WORDS = frozenset("""list item box wrap wrapper container block bar area inner outer left right top bottom main site page section primary secondary
small big first last col row group panel link links text title icon btn button js id the""".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|([^<]+|<)""", re.S)
_ATTRS = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(\shidden)(?=[\s/=]|$)|display\s*:\s*(none)""", re.I)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_RIGHTS = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)|all rights reserved", re.I)


@dataclass
class Block:
    text: str
    path: tuple[int, ...]        # element numbers from the root
    cue: int                     # nearest telling ancestor: 1 content, -1 boilerplate, 0 none
    link: float                  # share of the characters inside links
    heading: bool
    item: bool                   # in a list


def _cue(tag: str, attrs: str, inside: bool, around: int) -> int:
    """What an element says about its blocks.  Boilerplate stays boilerplate
    inside, but for an article or main element that it does not sit in."""
    if around < 0 and (inside or tag not in POSITIVE_TAGS) or tag in ("html", "body"):
        return around
    if tag in NEGATIVE_TAGS or tag == "header" and not inside:
        return -1
    names = [[w.lower() for w in _WORDS.findall(n)] for m in _ATTRS.finditer(attrs) if not (m[5] or m[6])
             for n in (m[2] or m[3] or m[4] or "").split()] if "=" in attrs else []
    # a name speaks against a block if all of it does: "ad-box" and "site-footer", not "social-science"
    against = any(not NEGATIVE_WORDS.isdisjoint(n) and (NEGATIVE_WORDS | PLAIN_WORDS).issuperset(n) for n in names)
    favour = any(not POSITIVE_WORDS.isdisjoint(n) and NEGATIVE_WORDS.isdisjoint(n) for n in names)
    if tag in POSITIVE_TAGS:
        return -1 if against and not favour else 1
    if against != favour:
        return 1 if favour else -1
    return around


def blocks_of(page: str) -> list[Block]:
    """Visible text blocks in page order: character references decoded, runs
    of white space one space, ends trimmed, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]      # tag, number, cue, inside content
    hidden: list[int] = []                                            # stack places of elements that are not shown
    parts: list[str] = []
    linked = number = links = 0
    pos = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            tags = [s[0] for s in stack]
            cue = -1 if not stack[-1][2] and len(text) < 200 and _RIGHTS.search(text) else stack[-1][2]
            out.append(Block(text, tuple(s[1] for s in stack), cue, min(1.0, linked / len(text)),
                             any(t in ("h1", "h2", "h3", "h4", "h5", "h6") for t in tags), "li" in tags or "td" in tags))
        parts.clear()
        linked = 0

    while pos < len(page):
        m = _TOKEN.match(page, pos)
        if m is None:                                                 # an unclosed tag: the rest is text
            if not hidden:
                parts.append(page[pos])
            pos += 1
            continue
        pos = m.end()
        if hidden and (m[5] is not None or m[1] is not None):
            continue
        if m[5] is not None or m[1] is not None:
            text = m[5] if m[5] is not None else html.escape(m[1])
            parts.append(text)
            linked += len(text) if links else 0
            continue
        if not m[3]:
            continue
        tag, closing, attrs = m[3].lower(), bool(m[2]), m[4]
        if tag in RAW_TAGS and not closing:
            pos = pos if attrs.endswith("/") else _skip(page, pos, tag)
            continue
        unseen = not closing and tag not in VOID_TAGS and (tag in HIDDEN_TAGS or ("hid" in attrs or "none" in attrs)
                                                           and any(a[5] or a[6] for a in _ATTRS.finditer(attrs)))
        if tag == "a":
            links = 0 if closing else 1
        if tag == "body" and not closing and stack[-1][0] == "head":
            stack.pop()                                               # a head that was never closed
            hidden = [h for h in hidden if h < len(stack)]
        if tag not in BLOCK_TAGS and not unseen and not (closing and any(stack[h][0] == tag for h in hidden)):
            continue
        if tag in BLOCK_TAGS:
            close()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            links = 0 if tag != "li" else links
        elif tag not in VOID_TAGS and not attrs.endswith("/") or tag in BLOCK_TAGS - VOID_TAGS:
            if tag in BLOCK_TAGS and len(stack) > 1 and (stack[-1][0] == "p" or AUTO_CLOSED.get(tag) == stack[-1][0] or tag == stack[-1][0] and tag in AUTO_CLOSED):
                stack.pop()
                hidden = [h for h in hidden if h < len(stack)]
            number += 1
            cue = _cue(tag, attrs, stack[-1][3], stack[-1][2])
            if unseen:
                hidden.append(len(stack))
            stack.append((tag, number, cue, stack[-1][3] or tag in POSITIVE_TAGS))
        hidden = [h for h in hidden if h < len(stack)]
    close()
    return out


def _skip(page: str, pos: int, tag: str) -> int:
    """Position after a raw element, whose content is no markup."""
    end = re.compile(rf"</{tag}\s*>", re.I).search(page, pos)
    return end.end() if end else len(page)


def features(b: Block) -> list[float]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    return [1.0, float(b.cue > 0), float(b.cue < 0), b.link, min(math.log1p(words), 6.0) / 6, float(b.text[-1] in ".!?…\"”»"),
            min(b.text.count(". ") + b.text.count(", "), 20) / 20, float(b.heading), float(b.item), float(n < 25)]


#: Starting weights, in the order of ``features``; also used where no page teaches any.
START = np.array([-1.0, 4.0, -5.0, -3.0, 3.0, 1.0, 1.0, 0.5, -1.0, -0.5])


#: Features that say what the markup tells; the fit leaves their weights alone.
CUES = (1, 2)


def fit(rows: np.ndarray, labels: np.ndarray, pull: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps on all features but the cues,
    pulled towards START."""
    rows = rows.copy()
    rows[:, CUES] = 0
    w = START.copy()
    if not len(labels) or labels.min() == labels.max():
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        grad = rows.T @ (p - labels) / len(labels) + pull * (w - START)
        hess = (rows * (p * (1 - p))[:, None]).T @ rows / len(labels) + pull * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def min_cut(up: list[float], down: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side of a minimum cut: up[i] is the capacity source -> i,
    down[i] that of i -> sink, edges are undirected.  Nodes that could be on
    either side go to the sink's.  Dinic's method on what remains after each
    node's direct flow source -> i -> sink."""
    n = len(up)
    rest = [u - d for u, d in zip(up, down)]
    if all(r > 0 for r in rest) or all(r <= 0 for r in rest):
        return [r > 0 for r in rest]
    out: list[list[int]] = [[] for _ in range(n)]
    head: list[int] = []
    cap: list[float] = []
    for a, b, c in edges:
        out[a].append(len(head))
        head.append(b)
        cap.append(c)
        out[b].append(len(head))
        head.append(a)
        cap.append(c)
    tiny = 1e-12
    while True:
        level = [0 if r > tiny else -1 for r in rest]
        queue = deque(i for i in range(n) if level[i] == 0)
        reached = False
        while queue:
            a = queue.popleft()
            if rest[a] < -tiny:
                reached = True
            for e in out[a]:
                if cap[e] > tiny and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if not reached:
            return [x >= 0 for x in level]
        at = [0] * n
        for s in range(n):
            while rest[s] > tiny and level[s] == 0:
                path, a = [], s
                while rest[a] >= -tiny or not path:
                    while at[a] < len(out[a]) and not (cap[out[a][at[a]]] > tiny and level[head[out[a][at[a]]]] == level[a] + 1):
                        at[a] += 1
                    if at[a] < len(out[a]):
                        path.append(out[a][at[a]])
                        a = head[path[-1]]
                    elif path:
                        e = path.pop()
                        a = head[e ^ 1]
                        at[a] += 1
                    else:
                        break
                if not path:
                    break
                flow = min(rest[s], -rest[a], min(cap[e] for e in path))
                rest[s] -= flow
                rest[a] += flow
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow


def label(blocks: list[Block], weights: np.ndarray, smooth: float = 0.8) -> list[bool]:
    if not blocks:
        return []
    z = np.clip(np.array([features(b) for b in blocks]) @ weights, -12, 12)
    as_boilerplate, as_content = np.logaddexp(0, z), np.logaddexp(0, -z)     # -log of the other label's probability
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, smooth / (1 + _apart(blocks[i - 1].path, b.path))))
        parent = b.path[-2] if len(b.path) > 1 else 0
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, smooth / 2))
        last[parent] = i
    return min_cut(as_boilerplate.tolist(), as_content.tolist(), edges)


def _apart(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Elements to climb from one block's element to the other's."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(page or "")
    return " ".join(b.text for b, keep in zip(blocks, label(blocks, weights)) if keep)


def train(pages: DataFrame, *, sample_pages: int = 1000, html_col: str = "html", url_col: str = "url") -> np.ndarray:
    """Weights from about ``sample_pages`` pages, chosen by a hash; blocks
    whose markup tells nothing teach nothing.  Sums of features reach the
    driver, bounded by the sample."""
    n = pages.count()
    share = min(1.0, sample_pages / max(n, 1))
    some = pages.select(html_col).where(F.col(html_col).isNotNull() & (F.pmod(F.xxhash64(html_col, F.col(url_col)), F.lit(1 << 30)) < share * (1 << 30)))

    def run(batches):
        for batch in batches:
            for page in batch.column(0).to_pylist():
                told = [(features(b), float(b.cue > 0)) for b in blocks_of(page) if b.cue]
                if told:
                    yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in told], pa.list_(pa.float64())), pa.array([y for _, y in told])], names=["x", "y"])

    counted = some.mapInArrow(run, "x array<double>, y double").groupBy("x", "y").count().orderBy("x", "y").collect()
    if not counted:
        return START
    times = np.array([r["count"] for r in counted])
    return fit(np.repeat(np.array([r["x"] for r in counted]), times, axis=0), np.repeat(np.array([r["y"] for r in counted]), times))


def extract(pages: DataFrame, weights: np.ndarray, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id_col``, ``url_col``, text (empty if the page
    has none), n_chars (its code points).  Null or empty html gives empty
    text; markup that is never closed ends with the page; repeated rows give
    a row each; other columns are ignored."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructType
    src = pages.select(id_col, url_col, html_col)
    spec = StructType(src.schema.fields[:2]).add("text", StringType()).add("n_chars", LongType())
    schema = to_arrow_schema(spec)

    def run(batches):
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], schema=schema)

    return src.mapInArrow(run, spec)
