"""Queries of the scan limits: the newest entries of a paper feed, the first
links of a listing and its first lookups that find a page.

Their SQL twins state the rule that made the input and count by window."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import ntz
from ..sources import adapters as A
from ..sources.feeds import scan_atom
from ..sources.pages import scan_listing
from ..streaming.scratch import run_folder
from . import catalog as C
from . import oracle_queries as Q

NEWEST, LINKS, LOOKUPS = 80, 30, 15      # Fixed values: entries a feed, links a listing, lookups a listing.
SITE = "https://list.example.com"


@C.query
def paper_newest(spark, sf):
    """One Atom feed per language, an entry per document, each a second older
    than the one before: the newest of every feed."""
    path = run_folder(spark, "newest")
    d = A.table(spark, sf, "documents")
    published = F.date_format(F.timestamp_add("SECOND", -F.col("doc_id").cast("int"), ntz(A.AS_OF)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    link = F.array(F.struct(F.format_string("https://papers.example.com/abs/%d", F.col("doc_id")).alias("_href"), F.lit("alternate").alias("_rel")))
    (d.select(F.col("doc_id").cast("string").alias("id"), F.format_string("Paper %d", F.col("doc_id")).alias("title"), link.alias("link"),
              published.alias("published"), F.substring(F.sha2("text", 256), 1, 20).alias("summary"), F.coalesce("lang", F.lit("none")).alias("source"))
     .write.partitionBy("source").format("xml").option("rowTag", "entry").option("rootTag", "feed").save(path))
    items = scan_atom(spark, path, query="all", label=None, as_of=A.AS_OF, window_days=A.WINDOW_DAYS, feed_col="source", newest=NEWEST)
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"), "excerpt")


Q.reg("paper_newest", f"""WITH k AS (SELECT doc_id, coalesce(lang, 'none') AS source, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn,
    TIMESTAMP '{A.AS_OF:%Y-%m-%d %H:%M:%S}' - to_seconds(doc_id) AS ts FROM documents)
  SELECT printf('https://papers.example.com/abs/%d', doc_id) AS url, printf('Paper %d', doc_id) AS title, source,
    strftime(ts, '%Y-%m-%d') AS publish_date, substr(sha256(text), 1, 20) AS excerpt
  FROM k WHERE rn <= {NEWEST} AND CAST(ts AS DATE) >= {Q.CUTOFF_D}""")


@C.query
def listing_limits(spark, sf):
    """A listing of a link per order in pages of bounded size: of the first
    links every fifth is dated in its card; of the others, every third has no
    landed page, and the first that have one are looked up."""
    k = F.col("o_orderkey")
    o = A.table(spark, sf, "orders").select("o_orderkey", F.floor(k / A.LISTING_CHUNK).cast("long").alias("block"))
    day = F.format_string("2024-01-%02d", (F.lit(22) + k % 8).cast("int"))
    date = F.when(k % 5 == 0, F.format_string('<time datetime="%s"></time>', day)).otherwise("")
    card = F.concat(F.format_string('<ul><li><a href="/orders/x/%d">Order number %d in the list</a>', k, k), date, F.lit("</li></ul>"))
    listings = (o.select("block", "o_orderkey", card.alias("card")).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "card"))).alias("c"))
                .select(F.format_string(f"{SITE}/all/%d", F.col("block")).alias("listing_url"), F.array_join(F.transform("c", lambda x: x["card"]), "").alias("html")))
    pages = (o.where(k % 3 > 0).select(k.alias("page_id"), F.format_string(f"{SITE}/orders/x/%d", k).alias("url"),
                                       F.format_string('<p>Ordered <time datetime="%s">then</time></p>', day).alias("html")))
    items = scan_listing(listings, pages, A.AS_OF, A.WINDOW_DAYS, max_links=LINKS, max_lookups=LOOKUPS)
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"), "date_method", "link_pos")


Q.reg("listing_limits", f"""WITH k AS (
    SELECT o_orderkey AS k, o_orderkey // {A.LISTING_CHUNK} AS block, make_date(2024, 1, CAST(22 + o_orderkey % 8 AS INTEGER)) AS day,
      row_number() OVER (PARTITION BY o_orderkey // {A.LISTING_CHUNK} ORDER BY o_orderkey) AS link_pos FROM orders),
  f AS (SELECT *, CASE WHEN k % 5 > 0 AND k % 3 > 0 THEN row_number() OVER (PARTITION BY block, k % 5 > 0 AND k % 3 > 0 ORDER BY link_pos) END AS lookup
        FROM k WHERE link_pos <= {LINKS}),
  r AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'context' WHEN lookup <= {LOOKUPS} THEN 'page' ELSE 'fallback' END AS date_method FROM f)
  SELECT printf('{SITE}/orders/x/%d', k) AS url, printf('Order number %d in the list', k) AS title, printf('{SITE}/all/%d', block) AS source,
    CASE date_method WHEN 'fallback' THEN '{A.AS_OF:%Y-%m-%d}' ELSE strftime(day, '%Y-%m-%d') END AS publish_date, date_method, link_pos
  FROM r WHERE date_method = 'fallback' OR day >= {Q.CUTOFF_D}""")
