"""Date resolution.

Every parser is a regex-guarded ``try_to_date`` so malformed input gives
NULL instead of an error under ANSI mode, and the whole cascade is a
``coalesce`` that stops at the first hit per row.  Dates are returned as
DATE; an impossible calendar day is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import cached, col, let, strip
from .text import strip_html
from .url import date_from_url

# Month names the parsers accept (full name or 3-letter form).
MONTHS = ["january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december"]
_MONTH_WORD = ("(?i)^(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|"
               "aug(ust)?|sep(tember)?|oct(ober)?|nov(ember)?|dec(ember)?)$")
_ABBR = "".join(m[:3] for m in MONTHS)

# Meta properties (exact) and meta names (substring, any case)
# that may carry a publish date, in priority order.
META_PROPERTIES = ["article:published_time", "article:published", "datePublished",
                   "og:article:published_time", "pubdate", "date", "DC.date.issued"]
META_NAMES = ["pubdate", "publishdate", "date", "article_date_original",
              "sailthru.date", "dcterms.date"]
# Visible-text date patterns, tried in this order.
VISIBLE_DATE_PATTERNS = [
    r"(?i)(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},?\s+\d{4}",
    r"(?i)\d{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{4}",
    r"\d{4}[-/]\d{1,2}[-/]\d{1,2}",
    r"(?i)(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}",
]
# Time-zone names understood in feed dates (hours from UTC).
ZONE_HOURS = {"GMT": 0, "UT": 0, "UTC": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6,
              "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}


RX_ISO = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ]\d{1,2}:\d{1,2}:\d{1,2}(?:Z|[+-]\d{2}:?\d{2})?)?$"
RX_MDY = r"^([A-Za-z]+)(\.?)\s+(\d{1,2})\s+(\d{4})$"
RX_DMY = r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$"
RX_YMD_SLASH = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
RX_MDY_SLASH = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
RX_ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"
RX_LDJSON = r"""(?is)<script\b[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""
RX_TIME_ATTR = r"""(?i)<time\b[^>]*\bdatetime\s*=\s*["']([^"']*)["']"""
RX_TIME_TEXT = r"(?is)<time\b[^>]*>(.*?)</time>"
_DATE_CLASS = (r"""[^>]*\bclass\s*=\s*["'][^"']*(?:date|time|publish|posted|created|updated|meta)[^"']*["'][^>]*>.*?""")
RX_DATE_CLASSED = "(?is)" + "|".join(rf"<{t}\b{_DATE_CLASS}</{t}>" for t in ("span", "div", "p", "small", "li"))
RX_DATA_ELEMENT = r"""(?is)<[a-z][^>]*\bdata-date\s*=\s*["'][^"']*["'][^>]*>.*?</"""
RX_DATA_DATE = r"""(?i)\bdata-date\s*=\s*["']([^"']*)["']"""
RX_SCRIPT_STYLE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
RX_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article>"
RX_MAIN = r"(?is)<main\b[^>]*>(.*?)</main>"
RX_BODY = r"(?is)<body\b[^>]*>(.*)"


_DOT = r"\."


def rx_meta_property(prop: str) -> str:
    return rf"""<meta\b[^>]*\bproperty\s*=\s*["']{prop.replace('.', _DOT)}["'][^>]*>"""


def rx_meta_name(name: str) -> str:
    return rf"""(?i)<meta\b[^>]*\bname\s*=\s*["'][^"']*{name.replace('.', _DOT)}[^"']*["'][^>]*>"""


RX_CONTENT = r"""(?i)\bcontent\s*=\s*["']([^"']*)["']"""


def _ymd(y: Column, m: Column, d: Column) -> Column:
    s = F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int"))
    return F.try_to_date(s, "yyyy-MM-dd")


def _month_no(word: Column) -> Column:
    return ((F.instr(F.lit(_ABBR), F.lower(F.substring(word, 1, 3))) + 2) / 3).cast("int")


@cached
def parse_date(raw: Column | str) -> Column:
    """Tolerant parse of one date string; the date as written (no zone shift).

    Accepts ISO dates and date-times, ``Feb 28, 2026``, ``February 28 2026``,
    ``Feb. 28, 2026``, ``28 Feb 2026``, ``2026/2/28``, ``2/28/2026``; commas
    are optional; else a leading ``YYYY-MM-DD`` is taken.  The cleaned
    string is bound once (``let``), so the parser stays a compact expression
    wherever it is inlined."""
    def parse(r: Column) -> Column:
        return let(F.replace(r, F.lit(","), F.lit("")), lambda nc: _parse_clean(r, nc))
    return let(F.regexp_replace(strip(col(raw)), "\\.+$", ""), parse)


def _parse_clean(r: Column, nc: Column) -> Column:
    def g(rx: str, i: int) -> Column:
        return F.regexp_extract(nc, rx, i)

    mdy_word = g(RX_MDY, 1)
    mdy_ok = (nc.rlike(RX_MDY) & mdy_word.rlike(_MONTH_WORD)
              & ((g(RX_MDY, 2) == "") | (F.length(mdy_word) == 3)))
    dmy_word = g(RX_DMY, 2)
    return F.coalesce(
        F.when(nc.rlike(RX_ISO), _ymd(g(RX_ISO, 1), g(RX_ISO, 2), g(RX_ISO, 3))),
        F.when(mdy_ok, _ymd(g(RX_MDY, 4), _month_no(mdy_word), g(RX_MDY, 3))),
        F.when(nc.rlike(RX_DMY) & dmy_word.rlike(_MONTH_WORD),
               _ymd(g(RX_DMY, 3), _month_no(dmy_word), g(RX_DMY, 1))),
        F.when(nc.rlike(RX_YMD_SLASH), _ymd(g(RX_YMD_SLASH, 1), g(RX_YMD_SLASH, 2), g(RX_YMD_SLASH, 3))),
        F.when(nc.rlike(RX_MDY_SLASH), _ymd(g(RX_MDY_SLASH, 3), g(RX_MDY_SLASH, 1), g(RX_MDY_SLASH, 2))),
        F.when(r.rlike(RX_ISO_PREFIX), F.try_to_date(F.substring(r, 1, 10), "yyyy-MM-dd")),
    )


@cached
def feed_date(raw: Column | str) -> Column:
    """Feed entry date shifted to UTC: RFC 822 (``Tue, 03 Mar 2026 23:30:00
    -0500``, zone names) or ISO 8601 with offset; else a plain ISO date."""
    return let(strip(col(raw)), _feed_date)


RX_RFC822 = (r"^(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})[A-Za-z]*\s+(\d{4})\s+"
             r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[A-Za-z]+)?$")
RX_ISO_TS = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def _zone_minutes(z: Column) -> Column:
    num = F.when(z.rlike(r"^[+-]\d{2}:?\d{2}$"),
                 F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1)
                 * (F.substring(z, 2, 2).cast("int") * 60
                    + F.substring(F.replace(z, F.lit(":"), F.lit("")), 4, 2).cast("int")))
    named = F.coalesce(*[F.when(F.upper(z) == k, F.lit(v * 60)) for k, v in ZONE_HOURS.items()])
    return F.coalesce(num, named, F.lit(0))


def _utc_date(local: Column, zone: Column) -> Column:
    return F.to_date(F.timestamp_add("MINUTE", -let(zone, _zone_minutes), local.cast("timestamp_ntz")))


def _feed_date(r: Column) -> Column:
    def g(rx: str, i: int) -> Column:
        return F.regexp_extract(r, rx, i)

    rfc_local = F.try_to_timestamp(
        F.format_string("%s-%02d-%02d %02d:%s:%s", g(RX_RFC822, 3), _month_no(g(RX_RFC822, 2)),
                        g(RX_RFC822, 1).cast("int"), g(RX_RFC822, 4).cast("int"), g(RX_RFC822, 5),
                        F.coalesce(F.nullif(g(RX_RFC822, 6), F.lit("")), F.lit("00"))),
        F.lit("yyyy-MM-dd HH:mm:ss"))
    iso_local = F.try_to_timestamp(F.concat(g(RX_ISO_TS, 1), F.lit(" "), g(RX_ISO_TS, 2)),
                                   F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(
        F.when(r.rlike(RX_RFC822), _utc_date(rfc_local, g(RX_RFC822, 7))),
        F.when(r.rlike(RX_ISO_TS), _utc_date(iso_local, g(RX_ISO_TS, 3))),
        F.when(r.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(r, "yyyy-MM-dd")),
    )


def first_parsed(candidates: Column) -> Column:
    """First candidate string (in order) that parses as a date.

    One ``parse_date`` inside one lambda serves every candidate, which keeps
    the expression tree small however many sources of dates are chained."""
    return F.get(F.filter(F.transform(candidates, parse_date), lambda d: d.isNotNull()), 0)


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _has(h: Column, needle: str) -> Column:
    """Cheap guard: a case-blind substring test before any regex runs."""
    return F.instr(F.lower(h), needle) > 0


_NO_CANDIDATES = "array<string>"


@cached
def meta_candidates(html: Column | str) -> Column:
    """content of the first <meta> per property (exact), then per name
    (substring, any case), in priority order."""
    h = col(html)
    cands = [_nonempty(F.regexp_extract(F.regexp_extract(h, rx_meta_property(p), 0), RX_CONTENT, 1))
             for p in META_PROPERTIES]
    cands += [_nonempty(F.regexp_extract(F.regexp_extract(h, rx_meta_name(n), 0), RX_CONTENT, 1))
              for n in META_NAMES]
    return F.when(_has(h, "<meta"), F.array(*cands)).otherwise(F.array().cast(_NO_CANDIDATES))


@cached
def jsonld_candidates(html: Column | str) -> Column:
    """Per ld+json script, per object (or list element): datePublished,
    dateCreated, dateModified, then datePublished/dateCreated of each
    @graph node."""
    scripts = F.regexp_extract_all(col(html), F.lit(RX_LDJSON), 1)
    nothing = F.array().cast(_NO_CANDIDATES)

    def text(v: Column, key: str) -> Column:
        return F.try_variant_get(v, f"$['{key}']", "string")

    def nodes(v: Column, path: str) -> Column:
        return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))

    def item_cands(o: Column) -> Column:
        own = F.array(*[text(o, k) for k in ("datePublished", "dateCreated", "dateModified")])
        graph = F.transform(nodes(o, "$['@graph']"), lambda n: F.array(text(n, "datePublished"), text(n, "dateCreated")))
        return F.concat(own, F.flatten(graph))

    def script_cands(v: Column) -> Column:
        # a list holds objects; anything else is one
        listed = F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))
        return F.flatten(F.transform(F.when(listed, nodes(v, "$")).otherwise(F.array(v)), item_cands))

    # each script is parsed once; broken JSON has no candidates
    per_script = F.transform(scripts, lambda s: F.coalesce(let(F.try_parse_json(strip(s)), script_cands), nothing))
    return F.when(_has(col(html), "ld+json"), F.flatten(per_script)).otherwise(nothing)


@cached
def time_candidates(html: Column | str) -> Column:
    """<time datetime=...> attributes in order, then <time> texts."""
    h = col(html)
    attrs = F.regexp_extract_all(h, F.lit(RX_TIME_ATTR), 1)
    texts = F.transform(F.regexp_extract_all(h, F.lit(RX_TIME_TEXT), 1), lambda t: strip(strip_html(t)))
    return F.when(_has(h, "<time"), F.concat(attrs, texts)).otherwise(F.array().cast(_NO_CANDIDATES))


@cached
def visible_text(html: Column | str, n: int | None = None) -> Column:
    """Text of article, else main, else body: tags become spaces,
    whitespace squeezed; first n chars (all without n)."""
    h = F.regexp_replace(col(html), RX_SCRIPT_STYLE, " ")
    root = F.coalesce(_nonempty(F.regexp_extract(h, RX_ARTICLE, 1)), _nonempty(F.regexp_extract(h, RX_MAIN, 1)),
                      _nonempty(F.regexp_extract(h, RX_BODY, 1)), h)
    txt = strip(F.regexp_replace(F.regexp_replace(root, "<[^>]+>", " "), "[\\t\\n\\x0B\\f\\r ]+", " "))
    return txt if n is None else F.substring(txt, 1, n)


def text_candidates(text: Column) -> Column:
    """First match of each visible-date pattern, in pattern order."""
    return F.array(*[_nonempty(F.regexp_extract(text, rx, 0)) for rx in VISIBLE_DATE_PATTERNS])


def date_in_text(text: Column) -> Column:
    return first_parsed(text_candidates(text))


@cached
def visible_candidates(html: Column | str) -> Column:
    """Date-classed span/div/p/small/li elements (and such elements inside
    them), then elements with data-date; each gives its data-date first, then
    its text.  Last, pattern matches in the main text."""
    h = col(html)

    def of(element: Column) -> Column:
        opening = F.regexp_extract(element, "(?s)^<[^>]*>", 0)
        return F.array(_nonempty(F.regexp_extract(opening, RX_DATA_DATE, 1)),
                       strip(strip_html(F.regexp_replace(element, "</$", ""))))

    def with_inner(element: Column) -> Column:
        inner = F.regexp_extract_all(F.regexp_replace(element, "(?s)^<[^>]*>", ""), F.lit(RX_DATE_CLASSED), 0)
        return F.concat(of(element), F.flatten(F.transform(inner, of)))

    classed = F.flatten(F.transform(F.regexp_extract_all(h, F.lit(RX_DATE_CLASSED), 0), with_inner))
    data_date = F.when(_has(h, "data-date"), F.flatten(F.transform(F.regexp_extract_all(h, F.lit(RX_DATA_ELEMENT), 0), of))) \
        .otherwise(F.array().cast(_NO_CANDIDATES))
    return F.concat(classed, data_date, let(visible_text(h), text_candidates))


@cached
def from_meta(html: Column | str) -> Column:
    return first_parsed(meta_candidates(html))


@cached
def from_jsonld(html: Column | str) -> Column:
    return first_parsed(jsonld_candidates(html))


@cached
def from_time_tag(html: Column | str) -> Column:
    return first_parsed(time_candidates(html))


@cached
def from_visible_text(html: Column | str) -> Column:
    return first_parsed(visible_candidates(html))


@cached
def from_html(html: Column | str) -> Column:
    """Meta -> JSON-LD -> time tag -> visible text: the first step with a
    candidate that parses; later steps are not evaluated then."""
    return F.coalesce(from_meta(html), from_jsonld(html), from_time_tag(html), from_visible_text(html))


def resolve_date(html: Column | str | None, url: Column | str | None,
                 hint: Column | str | None) -> Column:
    """HTML cascade, then URL date, then a parsed feed hint."""
    parts = []
    if html is not None:
        parts.append(from_html(html))
    if url is not None:
        parts.append(date_from_url(url))
    if hint is not None:
        parts.append(parse_date(hint))
    return F.coalesce(*parts)


def resolve_with_method(html: Column | str | None, url: Column | str | None,
                        hint: Column | str | None) -> Column:
    """struct(date, method): ``resolve_date`` and the step that produced it,
    each step evaluated once."""
    steps = [(from_html(html), "html")] if html is not None else []
    steps += [(date_from_url(url), "url")] if url is not None else []
    steps += [(parse_date(hint), "hint")] if hint is not None else []

    def named(date: Column, method: str) -> Column:
        return let(date, lambda v: F.when(v.isNotNull(), F.struct(v.alias("date"), F.lit(method).alias("method"))))

    return F.coalesce(*[named(d, m) for d, m in steps], F.struct(F.lit(None).cast("date").alias("date"), F.lit("none").alias("method")))
