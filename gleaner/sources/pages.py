"""Landed web pages as sources.

Listing pages become one row per article link: anchors, their texts and
the dates near them come from element extents (``operators/markup``), never
from a per-row parser.  Every window here is per page (bounded by one
document's links), never per source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.common import col, ntz, strip
from ..functions.dates import from_jsonld, from_meta, from_time_tag
from ..functions.html import unescape
from ..operators import markup
from ..session import shared_table
from ..spec import as_of_date, window_cutoff

# Anchor texts that are navigation, and path hints of articles.
NAV_TEXT = (r"(?i)^(home|about|contact|login|sign.?up|register|products?|solutions?|pricing|"
            r"careers?|jobs?|team|press|privacy|terms|legal|cookie|faq|help|support|"
            r"search|subscribe|newsletter|download|docs?|documentation|api|platform|"
            r"partners?|customers?|resources?)$")
ARTICLE_PATH_HINT = (r"(?i)/(blog|news|post|article|research|paper|update|release|announcement|"
                     r"insight|report|press-release|changelog|20\d{2})/")
# Elements of a listing that are dropped with their links.
LISTING_NOISE = ["nav", "footer", "header"]
RX_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def no_dots(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
                       lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                       .otherwise(F.concat(acc, F.array(s))))
    end = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of href relative to base (scheme, authority, absolute
    and relative paths, query- and fragment-only references)."""
    scheme = F.regexp_extract(base, U.URL_RX, 1)
    auth = F.regexp_extract(base, U.URL_RX, 2)
    bpath = F.regexp_extract(base, U.URL_RX, 3)
    origin = F.concat(scheme, F.lit("://"), auth)
    no_frag = F.regexp_replace(base, "#.*$", "")
    bdir = F.regexp_replace(bpath, "[^/]*$", "")
    ref_path, ref_tail = F.regexp_extract(href, "^[^?#]*", 0), F.regexp_replace(href, "^[^?#]*", "")
    return (F.when(href.rlike(RX_SCHEME), href)
            .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
            .when(F.startswith(href, F.lit("/")), F.concat(origin, no_dots(ref_path), ref_tail))
            .when(href == "", no_frag)
            .when(F.startswith(href, F.lit("#")), F.concat(no_frag, href))
            .when(F.startswith(href, F.lit("?")), F.concat(origin, bpath, href))
            .otherwise(F.concat(origin, no_dots(F.concat(F.when(bdir == "", F.lit("/")).otherwise(bdir), ref_path)), ref_tail)))


def same_site(link_domain: Column, base_domain: Column) -> Column:
    """Same host, or one is a subdomain of the other."""
    return ((link_domain == base_domain)
            | F.endswith(base_domain, F.concat(F.lit("."), link_domain))
            | F.endswith(link_domain, F.concat(F.lit("."), base_domain)))


def is_likely_article(href: Column | str, text: Column | str, base: Column | str) -> Column:
    """Not a navigation word; path deeper than one segment (or an article
    hint); not the page itself; not an anchor into the page."""
    href, text, base = col(href), col(text), col(base)
    path = U.path(href)
    shallow = (path == "") | (path == "/") | (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))) <= 1)
    self_link = F.regexp_replace(href, "/+$", "") == F.regexp_replace(base, "/+$", "")
    anchor = (F.instr(href, "#") > 0) & (path == U.path(base))
    return (~strip(text).rlike(NAV_TEXT) & ~(shallow & ~path.rlike(ARTICLE_PATH_HINT))
            & ~self_link & ~anchor)


def extract_links(listings: DataFrame, max_links: int | None = None) -> DataFrame:
    """(listing_url, html) -> (listing_url, link_pos, href, text, ctx_date):
    same-site article links, first occurrence of each absolute href; the
    first ``max_links`` of a listing (all by default).  The date is that of
    the link's parent element, else of its grandparent; it is looked for at
    the links that are kept."""
    found, dates = markup.links(listings.select("listing_url", "html"), LISTING_NOISE)
    href = resolve(F.col("listing_url"), unescape(strip("href")))
    links = found.withColumn("href", href)
    ok = (same_site(U.domain("href"), U.domain("listing_url"))
          & (F.length("text") >= 10)
          & is_likely_article("href", "text", "listing_url"))
    # several pages of a listing may hold the same link at the same place: ranks keep them until their dates are known
    first = Window.partitionBy("listing_url", "href").orderBy("start", "text")
    pos = Window.partitionBy("listing_url").orderBy("start", "href")
    kept = (links.where(ok).withColumn("_k", F.rank().over(first)).where(F.col("_k") == 1)
            .withColumn("link_pos", F.dense_rank().over(pos).cast("long")).drop("_k"))
    kept = shared_table(kept if max_links is None else kept.where(F.col("link_pos") <= max_links), "listing-anchors")
    by_date = Window.partitionBy("listing_url", "href").orderBy("ctx_date")
    return (kept.join(dates(kept), [*markup.KEY, "start"], "left")
            .withColumn("_k", F.row_number().over(by_date)).where(F.col("_k") == 1)
            .select("listing_url", "link_pos", "href", "text", "ctx_date"))


def html_dates(pages: DataFrame) -> DataFrame:
    """The pages without their html and with html_date: meta, JSON-LD, time
    tag, and, only for pages that these leave undated, the visible date by
    element extents."""
    early = F.coalesce(from_meta("html"), from_jsonld("html"), from_time_tag("html"))
    # written once: dates, and html only where there is none yet
    first = pages.withColumn("html_date", early).withColumn("html", F.when(F.col("html_date").isNull(), F.col("html")))
    first = shared_table(first, "html-dates")
    undated = first.where("html_date IS NULL").drop("html_date")
    return first.where("html_date IS NOT NULL").drop("html").unionByName(markup.visible_dates(undated).withColumnRenamed("visible_date", "html_date"))


def page_dates(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """(page_key, page_date): HTML publish date of the first landed page of
    every wanted key.  Pages are semi-joined to the keys first, so the date
    steps run only on pages that an undated link needs."""
    keyed = pages.select(U.url_hash("url").alias("page_key"), "page_id", "html").join(keys, "page_key", "left_semi")
    return (html_dates(keyed).groupBy("page_key").agg(F.min_by("html_date", "page_id").alias("page_date")))    # fixed-width: hash aggregate


def scan_listing(listings: DataFrame, pages: DataFrame, as_of: dt.datetime, window_days: int, *, label: str | None = None,
                 source_ord: int = 0, fallback_today: bool = True, max_links: int | None = None,
                 max_lookups: int | None = None) -> DataFrame:
    """Article links of landed listing pages as raw items.

    Date = context -> URL -> the landed article page -> as_of; rows dated
    before the window are dropped after resolution; source = label, else the
    listing's URL.  A column ``listing_ord`` numbers the pages of a listing:
    links arrive in that order, then by their place in the page.  ``max_links`` takes the first links of a listing,
    ``max_lookups`` looks up the first undated ones that have a landed page;
    by default all."""
    links = shared_table(extract_links(listings, max_links), "listing-links")         # read for the lookups and for the rows
    item_ord = F.col("link_pos").cast("long")
    if "listing_ord" in listings.columns:
        order = listings.groupBy("listing_url").agg(F.min("listing_ord").cast("long").alias("listing_ord"))
        links = links.join(order, "listing_url")
        item_ord = F.col("listing_ord") * (1 << 32) + item_ord
    known = F.coalesce(F.col("ctx_date"), U.date_from_url("href"))
    j = links.withColumn("known", known).withColumn("page_key", F.when(F.col("known").isNull(), U.url_hash("href")))
    keys = j.where(F.col("page_key").isNotNull()).select("page_key").distinct()
    # dated links look nothing up: a key of their own each keeps them out of one task
    own = F.concat(F.lit("-"), F.col("link_pos").cast("string"), F.lit("-"), F.col("listing_url"))
    j = j.withColumn("page_key", F.coalesce("page_key", own)).join(page_dates(pages, keys).withColumn("landed", F.lit(True)), "page_key", "left")
    looked_up = F.col("page_date")
    if max_lookups is not None:
        # only lookups that find a page count
        w = Window.partitionBy("listing_url", F.col("landed")).orderBy("link_pos")
        j = j.withColumn("_lookup", F.when(F.col("landed"), F.row_number().over(w)))
        looked_up = F.when(F.col("_lookup") <= max_lookups, looked_up)
    resolved = F.coalesce(F.col("known"), looked_up)
    method = (F.when(F.col("ctx_date").isNotNull(), F.lit("context"))
              .when(F.col("known").isNotNull(), F.lit("url"))
              .when(looked_up.isNotNull(), F.lit("page"))
              .otherwise(F.lit("fallback" if fallback_today else "none")))
    out = (j.select("listing_url", "link_pos", item_ord.alias("item_ord"), "href", "text", resolved.alias("resolved"), method.alias("date_method"))
           .where(F.col("resolved").isNull() | (F.col("resolved") >= F.lit(window_cutoff(as_of, window_days)))))
    pub = F.coalesce("resolved", F.lit(as_of_date(as_of))) if fallback_today else F.col("resolved")
    none = F.lit(None).cast("string")
    return out.select(F.col("href").alias("url"), F.col("text").alias("title"),
                      (F.lit(label) if label else F.col("listing_url")).alias("source"), pub.alias("publish_date"),
                      none.alias("excerpt"), none.alias("raw_html"), ntz(as_of).alias("fetched_at"),
                      F.lit(source_ord).cast("int").alias("source_ord"), "item_ord",
                      "date_method", "link_pos")


def scan_urls(urls: DataFrame, pages: DataFrame, label: str | None = None, *, as_of: dt.datetime | None = None,
              source_ord: int = 0, with_html: bool = False, max_html: int | None = None) -> DataFrame:
    """Explicit URL list (url, url_ord) left-joined to the first landed page
    of that very URL: title (or the URL), date from the page then the URL,
    meta description.  No window cutoff.  Pages are semi-joined to the list
    first, so fields are taken from listed pages only; html itself is only
    carried along (``with_html``) if wanted."""
    from ..functions.html import cut, meta_description, page_title
    wanted = pages.select("url", "page_id", "html").join(urls.select("url").distinct(), "url", "left_semi")
    first = wanted.groupBy("url").agg(F.min("page_id").alias("page_id"))
    listed = shared_table(wanted.join(first, ["url", "page_id"]).dropDuplicates(["url", "page_id"]), "listed-pages")
    fields = listed.select("url", page_title("html").alias("page_title"), meta_description("html").alias("excerpt"), F.length("html").cast("long").alias("html_chars"),
                           *([cut(F.col("html"), max_html).alias("raw_html")] if with_html else []))
    dates = html_dates(listed.select("url", "html")).select("url", F.col("html_date").alias("page_date"))
    j = urls.join(fields, "url", "left").join(dates, "url", "left")
    out = j if with_html else j.withColumn("raw_html", F.lit(None).cast("string"))
    return out.select("url_ord", "url", F.coalesce(F.nullif("page_title", F.lit("")), F.col("url")).alias("title"),
                      F.lit(label or "manual").alias("source"), F.coalesce("page_date", U.date_from_url("url")).alias("publish_date"),
                      "excerpt", "raw_html", (ntz(as_of) if as_of else F.lit(None).cast("timestamp_ntz")).alias("fetched_at"),
                      F.lit(source_ord).cast("int").alias("source_ord"), F.col("url_ord").cast("long").alias("item_ord"), "html_chars")
