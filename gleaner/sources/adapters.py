"""Driver tables -> engine inputs.

The test tables are not feeds, so these adapters derive the engine's
inputs from them with plain column expressions: ``raw_items`` from
``documents``, ``seen`` state from ``documents``, a fetch log from
``events`` and listing pages from ``pages``.  The same derivations are
written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import ntz

from ..spec import FilterSpec, JobSpec, RankingSpec, SourceSpec
from ..functions import url as U

# Fixed run parameters used by every registered query.
AS_OF = dt.datetime(2024, 1, 30)
TASK_KEY = "weekly_corpus"
WINDOW_DAYS = 7
TTL_DAYS = 45
N_SOURCES = 22                      # src0..src21; src20, src21 never publish
WEIGHTS = [("en.example.com", 1.5), ("example.com", 1.1), ("src3", 1.4), ("src7", 1.2)]
INCLUDE = ["the ", "que", "und"]
EXCLUDE = ["nicht", "blest", "###"]
MIN_SIGNALS = 0
# File suffixes given to part names for the media-type query.
MEDIA_SUFFIXES = [".png", ".JPG", ".pdf", ".mp3", ".mp4", ".txt", ".webp", ".mov"]
# Ordered theme lexicon built from words of the corpus.
THEMES = [
    ("english", ["that", "with", "this"]),
    ("german", ["und", "sch", "der"]),
    ("french", ["les", "que", "pour"]),
    ("spanish", ["los", "por", "para"]),
    ("suffix", ["tion", "ment"]),
    ("misc", ["an", "en", "on"]),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def job_spec(min_signals: int = MIN_SIGNALS) -> JobSpec:
    return JobSpec(
        task_key=TASK_KEY,
        time_window_days=WINDOW_DAYS,
        dedup_ttl_days=TTL_DAYS,
        sources=[SourceSpec(type="rss", label=f"src{i}", weight=1.0) for i in range(N_SOURCES)],
        filters=FilterSpec(require_publish_date=True, include_patterns=list(INCLUDE),
                           exclude_patterns=list(EXCLUDE), min_detail_signals=min_signals),
        ranking=RankingSpec(source_weight_map=dict(WEIGHTS), multi_source_bonus=0.3,
                            detail_signal_bonus=0.1),
    )


def doc_url(doc_id, text, lang, source):
    host = F.when(doc_id % 2 == 0, F.upper(lang)).otherwise(lang)
    tail = (F.when(doc_id % 3 == 0, F.lit("/"))
            .when(doc_id % 3 == 1, F.concat(F.lit("?page=1&utm_source="), source))
            .otherwise(F.lit("?page=1#top")))
    return F.concat(F.lit("https://"), host, F.lit(".example.com/d/"),
                    F.substring(F.sha2(text, 256), 1, 16), tail)


def raw_items(spark: SparkSession, sf_dir: str, as_of: dt.datetime = AS_OF) -> DataFrame:
    """documents -> raw items (url, title, source, publish_date, excerpt, ...)."""
    d = table(spark, sf_dir, "documents")
    doc_id, text = F.col("doc_id"), F.col("text")
    first_line = F.substring_index(F.substring_index(text, "\n", 1), ".", 1)
    return d.select(
        doc_url(doc_id, text, F.col("lang"), F.col("source")).alias("url"),
        first_line.alias("title"),
        F.col("source"),
        F.when(doc_id % 17 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit(dt.date(2024, 1, 1)), (doc_id % 30).cast("int"))).alias("publish_date"),
        text.alias("excerpt"),
        F.lit(None).cast("string").alias("raw_html"),
        ntz(as_of).alias("fetched_at"),
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("source_ord"),
        doc_id.cast("long").alias("item_ord"),
    )


def seen_state(spark: SparkSession, sf_dir: str, as_of: dt.datetime = AS_OF) -> DataFrame:
    """Hashes of the labelled documents (a rater saw them), first seen
    doc_id % 90 days ago."""
    labels = table(spark, sf_dir, "labels").select("doc_id").distinct()
    d = table(spark, sf_dir, "documents").join(labels, "doc_id", "left_semi")
    url = doc_url(F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source"))
    return d.select("doc_id", url.alias("url")).select(
        F.lit(TASK_KEY).alias("task_key"),
        U.url_hash("url").alias("url_hash"),
        F.timestamp_add("DAY", -(F.col("doc_id") % 90), ntz(as_of)).alias("first_seen_ts"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> one fetch outcome per event: success when it is a purchase."""
    e = table(spark, sf_dir, "events")
    success = F.col("event_type") == "purchase"
    return e.select(
        F.lit(TASK_KEY).alias("task_key"),
        F.concat(F.lit("src"), F.col("user_id").cast("string")).alias("source_id"),
        F.col("ts"),
        success.alias("success"),
        F.when(success, F.floor("value").cast("long")).otherwise(F.lit(0).cast("long")).alias("item_count"),
        F.col("event_id"),
    )


def sources_dim(spark: SparkSession, spec: JobSpec | None = None) -> DataFrame:
    """Configured sources as a small dimension table (size = job config)."""
    from ..plans.run import source_table
    return source_table(spark, spec or job_spec())


LISTING_CHUNK = 512    # pages per synthetic listing page (bounds every group)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages built from ``pages``, one per host and block of page ids.

    Four layouts by page_id % 4: a list item with a <time>, an article whose
    <time> follows the heading link, a table row with a date cell, and a card
    of nested divs without a date; every eighth page links with ``../``."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    whole = F.regexp_replace("url", "#.*$", "")
    href = F.when(k % 8 == 3, F.concat(F.lit("../x/.."), F.regexp_replace(whole, "^[a-z]+://[^/]*", ""))).otherwise(whole)
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    day = (k % 30 + 1).cast("int")
    link = F.concat(F.lit('<a href="'), href, F.lit('">'), title, F.lit("</a>"))
    time_tag = F.format_string('<time datetime="2024-01-%02d"></time>', day)
    card = (F.when(k % 4 == 0, F.concat(F.lit("<ul><li>"), time_tag, F.lit(" "), link, F.lit("</li></ul>")))
            .when(k % 4 == 1, F.concat(F.lit("<article><h3>"), link, F.lit("</h3>"), time_tag, F.lit("</article>")))
            .when(k % 4 == 2, F.concat(F.lit("<table><tr><td>"), link, F.lit("</td><td>"), F.format_string("Jan %d, 2024", day),
                                       F.lit("</td></tr></table>")))
            .otherwise(F.concat(F.lit('<div class="card"><div>'), link, F.lit("</div><p>more</p></div>"))))
    return (p.select(U.domain("url").alias("host"), F.floor(k / LISTING_CHUNK).cast("long").alias("block"), "page_id", card.alias("card"))
            .groupBy("host", "block").agg(F.sort_array(F.collect_list(F.struct("page_id", "card"))).alias("cards"))
            .select(F.format_string("https://%s/list/%d", F.col("host"), F.col("block")).alias("listing_url"),
                    F.concat(F.lit('<html><body><nav><a href="/">Home page link</a></nav>'),
                             F.array_join(F.transform("cards", lambda x: x["card"]), ""), F.lit("</body></html>")).alias("html")))
