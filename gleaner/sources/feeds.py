"""Landed RSS and Atom feeds (A2-A5).

Read with Spark's XML source (``rowTag`` item / entry) under an explicit
schema; every field rule is a Column expression.  Position in the feed is
kept as ``item_ord`` (monotonic id: increasing in file order), since first
wins in dedup and ties keep feed order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.common import ntz, strip
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.dates import feed_date
from ..functions.html import cut
from ..operators.gate import in_window

RSS_ITEM = StructType([StructField(n, StringType()) for n in (
    "title", "link", "pubDate", "published", "updated", "description", "summary", "content:encoded", "guid")])
ATOM_LINK = StructType([StructField("_href", StringType()), StructField("_rel", StringType()),
                        StructField("_type", StringType())])
ATOM_ENTRY = StructType([
    StructField("id", StringType()), StructField("title", StringType()),
    StructField("link", ArrayType(ATOM_LINK)), StructField("published", StringType()),
    StructField("updated", StringType()), StructField("summary", StringType()),
])
ATOM_TEXT = StructType([StructField("_VALUE", StringType()), StructField("_type", StringType())])
CHANNEL = StructType([StructField("title", StringType())])


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType) -> DataFrame:
    return (spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", "false")
            .option("mode", "PERMISSIVE").schema(schema).load(path))


def feed_title(spark: SparkSession, path: str) -> str | None:
    """The title of the channel (RSS) or feed (Atom): one small value."""
    for tag in ("channel", "feed"):
        row = read_xml(spark, path, tag, CHANNEL).where(F.col("title").isNotNull()).first()
        if row:
            return row["title"].strip()
    return None


def _excerpt(summary: Column, content: Column, chars: int | None) -> Column:
    return cut(F.coalesce(F.nullif(summary, F.lit("")), content), chars)


def scan_rss(spark: SparkSession, path: str, *, label: str | None, url: str | None,
             as_of: dt.datetime, window_days: int, source_ord: int = 0,
             excerpt_chars: int | None = None) -> DataFrame:
    """One row per item (RSS) or entry (an Atom feed) with a link; source =
    label, else the feed's title, else the feed URL; date shifted to UTC;
    dated rows before the window dropped, undated rows kept."""
    source = label or feed_title(spark, path) or url or path
    rss = read_xml(spark, path, "item", RSS_ITEM)
    atom = read_xml(spark, path, "entry", StructType(ATOM_ENTRY.fields + [StructField("content", ATOM_TEXT)]))
    r = rss.unionByName(atom.select(
        "title", _alternate(F.col("link")).alias("link"), F.lit(None).cast("string").alias("pubDate"), "published", "updated",
        F.lit(None).cast("string").alias("description"), "summary", F.col("content._VALUE").alias("content:encoded"), F.col("id").alias("guid")))
    link = strip(F.coalesce(F.col("link"), F.lit("")))
    pub = F.coalesce(feed_date(F.coalesce("pubDate", "published")), feed_date("updated"))
    out = r.select(
        link.alias("url"), strip(F.coalesce(F.col("title"), F.lit(""))).alias("title"),
        F.lit(source).alias("source"), pub.alias("publish_date"),
        _excerpt(F.coalesce("description", "summary"), F.col("`content:encoded`"), excerpt_chars).alias("excerpt"),
        F.lit(None).cast("string").alias("raw_html"),
        ntz(as_of).alias("fetched_at"),
        F.lit(source_ord).cast("int").alias("source_ord"),
        F.monotonically_increasing_id().alias("item_ord"))
    return out.where((F.col("url") != "") & in_window("publish_date", as_of, window_days))


def _alternate(links: Column) -> Column:
    """href of the first rel=alternate (or rel-less) link, else the first link."""
    alt = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return F.coalesce(F.get(alt, 0)["_href"], F.get(links, 0)["_href"])


def scan_atom(spark: SparkSession, path: str, *, query: str, label: str | None,
              as_of: dt.datetime, window_days: int, source_ord: int = 0,
              feed_col: str | None = None, newest: int | None = None,
              excerpt_chars: int | None = None) -> DataFrame:
    """Paper-API Atom entries: alternate link, ISO published date as
    written, newlines in title/summary become spaces, source = label else
    ``arXiv:{query}``.  ``newest`` keeps that many entries per feed
    (``feed_col`` when several feeds share a path), ``excerpt_chars`` that
    many characters of a summary; by default nothing is cut."""
    source = label or f"arXiv:{query}"
    r = read_xml(spark, path, "entry", ATOM_ENTRY) if feed_col is None else (
        spark.read.format("xml").option("rowTag", "entry").option("ignoreSurroundingSpaces", "false")
        .schema(StructType(ATOM_ENTRY.fields + [StructField(feed_col, StringType())])).load(path))
    pub_raw = strip(F.coalesce(F.col("published"), F.lit("")))
    pub = F.when(pub_raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(pub_raw, 1, 10), "yyyy-MM-dd"))
    summary = F.replace(strip(F.coalesce(F.col("summary"), F.lit(""))), F.lit("\n"), F.lit(" "))
    feed = F.col(feed_col) if feed_col else F.lit(source)
    out = r.select(
        strip(F.coalesce(_alternate(F.col("link")), F.lit(""))).alias("url"),
        F.replace(strip(F.coalesce(F.col("title"), F.lit(""))), F.lit("\n"), F.lit(" ")).alias("title"),
        feed.alias("source"), pub.alias("publish_date"), pub_raw.alias("_pub_raw"),
        F.when(summary != "", cut(summary, excerpt_chars)).alias("excerpt"),
        F.lit(None).cast("string").alias("raw_html"),
        ntz(as_of).alias("fetched_at"),
        F.lit(source_ord).cast("int").alias("source_ord"),
        F.monotonically_increasing_id().alias("item_ord"))
    if newest is not None:
        # row_number <= k is a WindowGroupLimit: only k rows per feed leave each map task
        w = Window.partitionBy("source").orderBy(F.col("_pub_raw").desc(), F.col("item_ord"))
        out = out.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= newest).drop("_k")
    return out.where((F.col("url") != "") & in_window("publish_date", as_of, window_days)).drop("_pub_raw")
