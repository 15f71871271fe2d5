"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
operator, all reading the driver tables (or data Spark derives from them)
in full.  Their SQL twins live in ``oracle_queries``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import __version__
from ..functions import text as T
from ..functions import url as U
from ..functions.dates import parse_date as parse_date_expr
from ..operators import dedup, gate, health, rank, stats, themes
from ..operators.markup import main_texts
from ..operators.order import with_global_rank
from ..sources import adapters as A
from . import pipeline as P
from .run import REPORT_THEMES

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ----------------------------------------------------------------- helpers
def _raw(spark, sf):
    return P.windowed(A.raw_items(spark, sf), A.AS_OF, A.WINDOW_DAYS)


def _seen_live(spark, sf):
    from ..sources.state import live_seen
    return live_seen(A.seen_state(spark, sf), A.TASK_KEY, A.TTL_DAYS, A.AS_OF)


def _curated(spark, sf):
    return P.curate(_raw(spark, sf), _seen_live(spark, sf), A.job_spec(), A.AS_OF)


def _ranked(spark, sf):
    return with_global_rank(_curated(spark, sf).items, rank.order_cols(), "rank")


# ------------------------------------------------------------ URL functions
@query
def url_normalize(spark, sf):
    p = A.table(spark, sf, "pages")
    return p.select("page_id", U.normalize_url("url").alias("norm_url"))


@query
def url_hash(spark, sf):
    p = A.table(spark, sf, "pages")
    return p.select("page_id", U.url_hash("url").alias("url_hash"))


@query
def url_domain(spark, sf):
    p = A.table(spark, sf, "pages")
    return p.groupBy(U.domain("url").alias("domain")).agg(F.count(F.lit(1)).cast("long").alias("n_pages"))


def _dated_url(d, key):
    """Synthetic article URLs carrying a date in one of three layouts."""
    return (F.when(key % 4 == 0, F.concat(F.lit("https://ex.com/news/"), F.date_format(d, "yyyy/M/d"), F.lit("/story")))
            .when(key % 4 == 1, F.concat(F.lit("https://ex.com/"), F.date_format(d, "yyyy-MM-dd"), F.lit("/x")))
            .when(key % 4 == 2, F.concat(F.lit("https://ex.com/a/"), F.date_format(d, "yyyyMMdd")))
            .otherwise(F.concat(F.lit("https://ex.com/p/"), key.cast("string"))))


@query
def url_date(spark, sf):
    o = A.table(spark, sf, "orders")
    u = _dated_url(F.col("o_orderdate"), F.col("o_orderkey"))
    return o.select("o_orderkey", F.date_format(U.date_from_url(u), "yyyy-MM-dd").alias("url_date"))


@query
def slug_title(spark, sf):
    p = A.table(spark, sf, "part")
    u = F.concat(F.lit("https://ex.com/news/"), F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit("/"))
    return p.select("p_partkey", T.title_from_slug(u).alias("title"))


@query
def parse_date(spark, sf):
    o = A.table(spark, sf, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    raw = (F.when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd"))
           .when(k % 6 == 1, F.date_format(d, "MMM d, yyyy"))
           .when(k % 6 == 2, F.date_format(d, "MMMM d yyyy"))
           .when(k % 6 == 3, F.date_format(d, "d MMM yyyy"))
           .when(k % 6 == 4, F.date_format(d, "yyyy/M/d"))
           .otherwise(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return o.select("o_orderkey", F.date_format(parse_date_expr(raw), "yyyy-MM-dd").alias("parsed"))


# ----------------------------------------------------------- text functions
@query
def strip_html(spark, sf):
    p = A.table(spark, sf, "pages")
    return p.select("page_id", T.strip_html("html").alias("text"))


@query
def truncate_words(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", T.truncate_words("text", 60).alias("cut"))


@query
def excerpt(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", T.make_excerpt("text", 120).alias("excerpt"))


@query
def sentences(spark, sf):
    d = A.table(spark, sf, "documents")
    s = T.sentences("text")
    return d.select("doc_id", F.size(s).cast("long").alias("n_sentences"),
                    F.coalesce(F.get(s, 0), F.lit("")).alias("first_sentence"),
                    F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit("")).alias("last_sentence"))


@query
def takeaway(spark, sf):
    r = A.raw_items(spark, sf)
    return r.select("item_ord", T.takeaway("title", "excerpt", 60).alias("takeaway"))


@query
def signals(spark, sf):
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", F.array_join(T.detect_signals("text"), ",").alias("signals"))


@query
def freshness(spark, sf):
    r = A.raw_items(spark, sf)
    return r.select("item_ord", rank.freshness("publish_date", A.AS_OF).alias("freshness"))


@query
def stars_clip(spark, sf):
    items = _curated(spark, sf).items
    return items.select("item_ord", T.stars("score").alias("stars"),
                        T.clip("title", 60).alias("title_60"), T.clip("title", 55).alias("title_55"),
                        T.clip("title", 50).alias("title_50"))


# ------------------------------------------------------- filters and dedup
@query
def window_gate(spark, sf):
    r = A.raw_items(spark, sf)
    return (r.where(gate.in_window("publish_date", A.AS_OF, A.WINDOW_DAYS))
            .select("item_ord", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date")))


@query
def seen_ttl(spark, sf):
    s = _seen_live(spark, sf)
    return s.select("url_hash", F.date_format("first_seen_ts", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query
def dedup_state(spark, sf):
    r = _raw(spark, sf).withColumn("url_hash", U.url_hash("url"))
    return dedup.not_seen(r, _seen_live(spark, sf)).select("item_ord", "url_hash")


@query
def dedup_run(spark, sf):
    r = _raw(spark, sf).withColumn("url_hash", U.url_hash("url"))
    return dedup.first_wins(r).select("item_ord", "url_hash")


@query
def disposition(spark, sf):
    t = _curated(spark, sf).tagged
    return t.select("item_ord", "url_hash", "disposition",
                    F.array_join("signals", ",").alias("signals"))


# ------------------------------------------------------------------ ranking
@query
def source_weight(spark, sf):
    r = A.raw_items(spark, sf)
    w = rank.with_source_weight(r, A.job_spec().weight_entries())
    return w.select("item_ord", U.domain("url").alias("domain"), "source", "weight")


@query
def multi_source(spark, sf):
    r = A.raw_items(spark, sf).withColumn("url_hash", U.url_hash("url"))
    return r.groupBy("url_hash").agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                                     F.countDistinct("source").cast("long").alias("n_sources"))


@query
def score_rank(spark, sf):
    r = _ranked(spark, sf)
    return r.select("rank", "url_hash", "score", "publish_date", "source", "title", "excerpt",
                    "takeaway", F.array_join("signals", ",").alias("signals"))


@query
def curated_top(spark, sf):
    items = _curated(spark, sf).items
    top = rank.top_items(items, 5)
    # row_number over the five rows left after the top-k (bounded window)
    return top.select(F.row_number().over(Window.orderBy(*rank.order_cols())).cast("long").alias("rank"),
                      T.stars("score").alias("stars"), "publish_date", "source",
                      T.clip("title", 60).alias("title"), "takeaway", "url", "score")


# --------------------------------------------------------------- statistics
@query
def run_stats_rollup(spark, sf):
    return stats.run_stats_rollup(_curated(spark, sf).tagged)


@query
def per_source_stats(spark, sf):
    return stats.per_source(_curated(spark, sf).tagged, A.sources_dim(spark)).drop("source_ord")


@query
def silent_sources(spark, sf):
    ps = stats.per_source(_curated(spark, sf).tagged, A.sources_dim(spark))
    return stats.silent_sources(ps).drop("source_ord")


@query
def active_sources(spark, sf):
    return stats.active_sources(_curated(spark, sf).items)


@query
def waterline(spark, sf):
    return stats.waterline(_seen_live(spark, sf), _curated(spark, sf).tagged)


# ------------------------------------------------------------------- themes
@query
def theme_assign(spark, sf):
    items = _curated(spark, sf).items
    return themes.assign(items, A.THEMES).select("item_ord", "theme")


@query
def theme_board(spark, sf):
    b = themes.board(_ranked(spark, sf), A.THEMES)
    return b.select("theme", "n", "first_rank",
                    F.array_join(F.transform("refs", lambda r: r["title"]), " | ").alias("ref_titles"),
                    F.array_join(F.transform("refs", lambda r: r["rank"].cast("string")), ",").alias("ref_ranks"))


# ------------------------------------------------------------------- health
@query
def health_fold(spark, sf):
    h = health.source_health(A.fetch_log(spark, sf))
    return h.select("source_id", "consecutive_failures",
                    F.date_format("last_success", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_success"),
                    F.date_format("last_failure", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_failure"),
                    "disabled", "total_items_fetched")


@query
def health_alerts(spark, sf):
    a = health.health_alerts(health.source_health(A.fetch_log(spark, sf)))
    return a.select("source_id", "failures", "disabled", "status")


# -------------------------------------------------------------------- pages
@query
def page_title(spark, sf):
    from ..functions.html import page_title as title
    p = A.table(spark, sf, "pages")
    return p.select("page_id", title("html").alias("title"))


@query
def page_excerpt(spark, sf):
    """Meta description; the main text only of pages that have none."""
    from ..functions.html import meta_description
    p = A.table(spark, sf, "pages").select("page_id", "html", meta_description("html").alias("excerpt"))
    bare = main_texts(p.where("excerpt IS NULL").drop("excerpt"))
    return p.where("excerpt IS NOT NULL").select("page_id", "excerpt").unionByName(
        bare.select("page_id", F.nullif("main_text", F.lit("")).alias("excerpt")))


@query
def main_text(spark, sf):
    return main_texts(A.table(spark, sf, "pages").select("page_id", "html"))


def _listings(spark, sf):
    return A.listings(spark, sf)


@query
def page_links(spark, sf):
    from ..sources.pages import extract_links
    links = extract_links(_listings(spark, sf))
    return links.select("listing_url", "link_pos", "href", "text",
                        F.date_format("ctx_date", "yyyy-MM-dd").alias("ctx_date"))


@query
def listing_scan(spark, sf):
    from ..sources.pages import scan_listing
    items = scan_listing(_listings(spark, sf), A.table(spark, sf, "pages"), A.AS_OF, A.WINDOW_DAYS)
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
                        "date_method", "link_pos")


@query
def url_list_scan(spark, sf):
    from ..sources.pages import scan_urls
    p = A.table(spark, sf, "pages")
    urls = p.select(F.col("page_id").alias("url_ord"),
                    F.when(F.col("page_id") % 10 == 0, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("/gone")))
                    .otherwise(F.col("url")).alias("url"))
    items = scan_urls(urls, p)
    return items.select("url_ord", "url", "title", "source",
                        F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"), "excerpt",
                        "html_chars")


# ------------------------------------------------------------------ reports
@query
def timeline_lines(spark, sf):
    from ..operators.report import timeline_lines as tl
    return tl(_ranked(spark, sf))


@query
def source_lines(spark, sf):
    from ..operators.report import source_lines as sl
    return sl(_ranked(spark, sf))


@query
def item_docs(spark, sf):
    from ..operators.report import item_docs as docs
    return docs(_ranked(spark, sf))


@query
def text_blocks(spark, sf):
    from ..operators.blocks import doc_title, text_to_blocks
    d = A.table(spark, sf, "documents")
    # documents carry single newlines only; doubling them makes every line a paragraph
    d2 = d.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("body"),
                  doc_title("text").alias("title"))
    b = text_to_blocks(d2, "doc_id", "body")
    return b.join(d2.select("doc_id", "title"), "doc_id").select(
        "doc_id", "block_ord", "block_type", "content", "sent", "title")


@query
def natural_sort(spark, sf):
    from ..operators.blocks import slide_caption
    c = A.table(spark, sf, "customer").select("c_custkey", "c_name", T.natural_key("c_name").alias("nkey"))
    r = with_global_rank(c, [F.col("nkey"), F.col("c_custkey")], "natural_rank")
    return r.select("c_custkey", "c_name", slide_caption("c_name").alias("caption"), "natural_rank")


@query
def media_type(spark, sf):
    from ..operators.blocks import media_type as mt
    p = A.table(spark, sf, "part")
    suffix = F.element_at(F.array(*[F.lit(x) for x in A.MEDIA_SUFFIXES]),
                          (F.col("p_partkey") % len(A.MEDIA_SUFFIXES) + 1).cast("int"))
    name = F.concat(F.replace(F.lower("p_name"), F.lit(" "), F.lit("_")), suffix)
    return p.select("p_partkey", name.alias("file_name"), mt(name).alias("block_type"))


# ------------------------------------------------------------------- export
def _imported(spark, sf, ranked):
    """Hashes of the documents that a rater called good."""
    good = A.table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("item_ord")).distinct()
    return ranked.join(good, "item_ord", "left_semi").select("url_hash")


@query
def import_pending(spark, sf):
    from ..operators.export import pending
    r = _ranked(spark, sf)
    return pending(r, _imported(spark, sf, r)).select("url_hash", "rank")


@query
def export_batches(spark, sf):
    from ..operators.export import batches, pending
    r = _ranked(spark, sf)
    return batches(pending(r, _imported(spark, sf, r))).select("url_hash", "rank", "pos", "batch")


@query
def coverage(spark, sf):
    from ..operators.export import coverage as cov
    return cov(_curated(spark, sf).items)


# ------------------------------------------------------------- run records
@query
def enabled_sources(spark, sf):
    h = health.source_health(A.fetch_log(spark, sf))
    return health.enabled_sources(A.sources_dim(spark), h).select("label")


@query
def job_status(spark, sf):
    from ..operators.status import job_status as js
    return js(A.fetch_log(spark, sf))


@query
def manifest_row(spark, sf):
    from ..operators.status import manifest_row as mr
    c = _curated(spark, sf)
    return mr(c.tagged, _seen_live(spark, sf), A.job_spec(), A.AS_OF)


# ---------------------------------------------------------------- streaming
@query
def stream_incremental(spark, sf):
    """Three cron-style availableNow runs over arrivals split by source
    range; survivors must equal the batch run's survivors."""
    from ..streaming.incremental import run_incremental, seed_state
    from ..streaming.scratch import run_folder
    base = run_folder(spark, "incremental")
    landing, state, out, ckpt = (f"{base}/{x}" for x in ("landing", "seen", "items", "checkpoint"))
    seed_state(A.seen_state(spark, sf), state)
    raw = _raw(spark, sf)
    for lo, hi in ((0, 7), (7, 14), (14, 1 << 30)):
        raw.where((F.col("source_ord") >= lo) & (F.col("source_ord") < hi)).write.mode("append").parquet(landing)
        run_incremental(spark, landing, spec=A.job_spec(), as_of=A.AS_OF, state_path=state,
                        out_path=out, checkpoint=ckpt)
    return spark.read.parquet(out).select("url_hash", "source", "publish_date", "score", "title")


@query
def stream_ttl_dedup(spark, sf):
    """Event-time TTL dedup on a stream: one row per URL hash."""
    from ..schema import RAW_ITEMS
    from ..streaming.incremental import ttl_dedup
    from ..streaming.scratch import run_folder
    base = run_folder(spark, "ttl-dedup")
    _raw(spark, sf).write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(RAW_ITEMS).parquet(f"{base}/landing")
    q = (ttl_dedup(stream, "fetched_at", A.TTL_DAYS).select("url_hash", "url", "source")
         .writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("url_hash")


@query
def stream_health(spark, sf):
    """Health fold over three time-ordered arrivals of the fetch log;
    must equal the batch fold."""
    from ..streaming.health import latest_health, run_health_stream
    from ..streaming.scratch import run_folder
    base = run_folder(spark, "health")
    log = A.fetch_log(spark, sf).drop("event_id")
    day = F.dayofmonth("ts")
    for lo, hi in ((1, 11), (11, 21), (21, 32)):
        log.where((day >= lo) & (day < hi)).write.mode("append").parquet(f"{base}/landing")
        run_health_stream(spark, f"{base}/landing", f"{base}/health", f"{base}/checkpoint")
    h = latest_health(spark, f"{base}/health")
    return h.select("source_id", "consecutive_failures",
                    F.date_format("last_success", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_success"),
                    F.date_format("last_failure", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_failure"),
                    "disabled", "total_items_fetched")


# -------------------------------------------------------- feeds and sitemaps
@query
def rss_scan(spark, sf):
    """Raw items written as an RSS feed (Spark XML writer), scanned back."""
    from ..sources.feeds import scan_rss
    from ..streaming.scratch import run_folder
    path = run_folder(spark, "rss")
    r = A.raw_items(spark, sf)
    pub = F.concat(F.date_format(F.col("publish_date").cast("timestamp_ntz"), "EEE, dd MMM yyyy HH:mm:ss"),
                   F.lit(" +0000"))
    (r.select("title", F.col("url").alias("link"), pub.alias("pubDate"), F.col("excerpt").alias("description"),
              F.col("item_ord").alias("guid"))
     .write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path))
    items = scan_rss(spark, path, label="corpus-rss", url=None, as_of=A.AS_OF, window_days=A.WINDOW_DAYS)
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
                        "excerpt")


@query
def atom_scan(spark, sf):
    """Raw items written as one Atom feed per source (two links per entry,
    whole texts as many-line titles), scanned back."""
    from ..sources.feeds import scan_atom
    from ..streaming.scratch import run_folder
    path = run_folder(spark, "atom")
    r = A.raw_items(spark, sf)
    published = F.date_format(F.timestamp_add("SECOND", (F.col("item_ord") % 86400).cast("int"),
                                              F.col("publish_date").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    links = F.array(F.struct(F.col("url").alias("_href"), F.lit("alternate").alias("_rel")),
                    F.struct(F.concat(F.col("url"), F.lit(".pdf")).alias("_href"), F.lit("related").alias("_rel")))
    (r.select(F.col("item_ord").cast("string").alias("id"), F.col("excerpt").alias("title"),
              links.alias("link"), published.alias("published"), F.col("excerpt").alias("summary"), "source")
     .sortWithinPartitions("item_ord")
     .write.partitionBy("source").format("xml").option("rowTag", "entry").option("rootTag", "feed").save(path))
    items = scan_atom(spark, path, query="corpus", label=None, as_of=A.AS_OF, window_days=A.WINDOW_DAYS,
                      feed_col="source")
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
                        "excerpt")


@query
def sitemap_scan(spark, sf):
    """Pages written as a sitemap (lastmod, URL-dated and undated entries,
    some without <loc>), scanned back with a '/en/' path filter."""
    from ..sources.sitemap import scan_sitemap
    from ..streaming.scratch import run_folder
    path = run_folder(spark, "sitemap")
    p = A.table(spark, sf, "pages")
    day = (F.col("page_id") % 28 + 1).cast("int")
    base = F.regexp_replace("url", "#.*$", "")
    loc = (F.when(F.col("page_id") % 11 == 0, F.lit(None))
           .when(F.col("page_id") % 3 == 1, F.format_string("%s/2024/01/%02d/", base, day))
           .otherwise(base))
    lastmod = F.when(F.col("page_id") % 3 == 0, F.format_string("2024-01-%02d", day))
    (p.select(loc.alias("loc"), lastmod.alias("lastmod"))
     .write.format("xml").option("rowTag", "url").option("rootTag", "urlset").save(path))
    items = scan_sitemap(spark, path, label="corpus-sitemap", url=None, path_filter="/en/",
                         as_of=A.AS_OF, window_days=A.WINDOW_DAYS)
    return items.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"))


@query
def weekly_report(spark, sf):
    """The whole weekly report as ordered lines.  The tagged rows are
    materialised once; items, statistics and boards all read them."""
    from ..operators.order import materialize
    from ..operators.report import display_title, weekly_report as weekly
    spec = A.job_spec()
    tagged = materialize(P.tag(_raw(spark, sf), _seen_live(spark, sf), spec))
    ranked = with_global_rank(P.survivors(tagged, spec, A.AS_OF), rank.order_cols(), "rank")
    silent = stats.silent_sources(stats.per_source(tagged, A.sources_dim(spark)))
    alerts = health.health_alerts(health.source_health(A.fetch_log(spark, sf)))
    board = themes.board(ranked, A.THEMES, max_themes=REPORT_THEMES)
    return weekly(ranked, board, silent, alerts, title=display_title(A.TASK_KEY), as_of=A.AS_OF,
                  window_days=A.WINDOW_DAYS, configured=A.N_SOURCES, version=__version__)


@query
def memo_report(spark, sf):
    """The memo report (investment memo / company dossier) as ordered lines."""
    from ..operators.report import display_title, memo_report as memo
    ranked = _ranked(spark, sf)
    return memo(ranked, themes.board(ranked, A.THEMES, max_themes=REPORT_THEMES), title=display_title(A.TASK_KEY), as_of=A.AS_OF,
                window_days=A.WINDOW_DAYS, version=__version__)


@query
def score_pre_dedup(spark, sf):
    """Scores with the multi-source bonus counted before dedup (distinct
    sources per URL hash)."""
    c = P.curate(_raw(spark, sf), _seen_live(spark, sf), A.job_spec(), A.AS_OF)
    items = P.survivors(c.tagged, A.job_spec(), A.AS_OF, multi_stage="pre_dedup")
    return items.select("url_hash", "source", "score")


@query
def top_board(spark, sf):
    """The report's top-five board rows (stars, date, source, clipped
    title, takeaway, link)."""
    from ..operators.report import top_lines
    items = _curated(spark, sf).items
    top = rank.top_items(items, 5)
    ranked = top.select("*", F.row_number().over(Window.orderBy(*rank.order_cols())).cast("long").alias("rank"))
    return top_lines(ranked)


@query
def latest_run(spark, sf):
    """Manifests of three daily runs (as_of 01-28, 01-29, 01-30); the
    status board shows the newest run per task with source health."""
    import datetime as dt
    from ..operators.status import manifest_row as mr, run_status
    from ..sources.state import live_seen
    spec = A.job_spec()
    manifests = None
    for day in (28, 29, 30):
        as_of = dt.datetime(2024, 1, day)
        raw = P.windowed(A.raw_items(spark, sf, as_of), as_of, A.WINDOW_DAYS)
        seen = live_seen(A.seen_state(spark, sf, as_of), A.TASK_KEY, A.TTL_DAYS, as_of)
        m = mr(P.tag(raw, seen, spec), seen, spec, as_of)
        manifests = m if manifests is None else manifests.unionByName(m)
    return run_status(manifests, A.fetch_log(spark, sf)).select(
        "task_key", "run_id", "fetched", "deduped", "filtered_out", "final", "waterline_before",
        "waterline_after", "runs", "last_run", "sources", "disabled", "alerting")
