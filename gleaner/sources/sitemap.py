"""Landed XML sitemaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import ntz, strip
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import parse_date
from ..functions.text import title_from_slug
from ..functions.url import date_from_url
from ..spec import window_cutoff

SITEMAP_URL = StructType([StructField("loc", StringType()), StructField("lastmod", StringType())])


def scan_sitemap(spark: SparkSession, path: str, *, label: str | None, url: str | None,
                 path_filter: str | None, as_of: dt.datetime, window_days: int,
                 source_ord: int = 0) -> DataFrame:
    """One row per <url> with a <loc>: substring path filter first, date =
    <lastmod> else the URL date, undated rows dropped, then the window; the
    title is made from the last path segment."""
    source = label or url or path
    r = (spark.read.format("xml").option("rowTag", "url").option("ignoreSurroundingSpaces", "false")
         .schema(SITEMAP_URL).load(path))
    loc = strip(F.coalesce(F.col("loc"), F.lit("")))
    r = r.select(loc.alias("url"), "lastmod", F.monotonically_increasing_id().alias("item_ord"))
    r = r.where(F.col("url") != "")
    if path_filter:
        r = r.where(F.instr("url", path_filter) > 0)
    pub = F.coalesce(parse_date(F.nullif(strip(F.coalesce(F.col("lastmod"), F.lit(""))), F.lit(""))),
                     date_from_url("url"))
    out = r.select("url", title_from_slug("url").alias("title"), F.lit(source).alias("source"),
                   pub.alias("publish_date"), F.lit(None).cast("string").alias("excerpt"),
                   F.lit(None).cast("string").alias("raw_html"),
                   ntz(as_of).alias("fetched_at"),
                   F.lit(source_ord).cast("int").alias("source_ord"), "item_ord")
    return out.where(F.col("publish_date").isNotNull()
                     & (F.col("publish_date") >= F.lit(window_cutoff(as_of, window_days))))
