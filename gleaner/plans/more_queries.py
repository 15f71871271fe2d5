"""Queries of the single date steps, the sinks, the source union and a
whole run from landed data.

Their SQL twins say what must come out from the rule that made the input
(an order's date, a document's text), not from the engine's patterns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions import url as U
from ..operators import blocks, gate, health, markup
from ..sources import adapters as A
from ..sources.pages import html_dates
from ..spec import FilterSpec, JobSpec, RankingSpec, SourceSpec, window_cutoff
from ..streaming.scratch import run_folder
from . import catalog as C
from . import oracle as O
from . import oracle_queries as Q
from . import pipeline as P

query = C.query


def _pages_of(spark: SparkSession, sf: str, shapes) -> DataFrame:
    """orders -> (o_orderkey, html): one layout per remainder of the key."""
    o = A.table(spark, sf, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    iso, words = F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "MMMM d, yyyy")
    forms = shapes(iso, words, F.date_format(F.date_add(d.cast("date"), 400), "yyyy-MM-dd"))
    html = F.element_at(F.array(*forms), (k % len(forms) + 1).cast("int"))
    return o.select("o_orderkey", F.concat(F.lit("<html><head><title>t</title></head><body>"), html, F.lit("</body></html>")).alias("html"))


def _step(name: str, step, shapes, dated: int, total: int) -> None:
    """Register a date step over pages in ``total`` layouts, of which the
    first ``dated`` carry the order's date; ``step`` takes the html column or,
    by element extents, the pages."""
    def run(spark, sf):
        pages = _pages_of(spark, sf, shapes)
        found = step(pages).toDF("o_orderkey", "found") if step in (markup.visible_dates, html_dates) else pages.select("o_orderkey", step("html").alias("found"))
        return found.select("o_orderkey", F.date_format("found", "yyyy-MM-dd").alias("found"))
    run.__name__ = name
    query(run)
    Q.reg(name, f"""SELECT o_orderkey, CASE WHEN o_orderkey % {total} < {dated} THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END
      AS found FROM orders""")


def _meta(iso, words, other):
    return [F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('T08:00:00Z"><time datetime="'), other, F.lit('">x</time>')),
            F.concat(F.lit('<meta name="pubdate" content="'), words, F.lit('">')),
            F.concat(F.lit('<meta property="og:title" content="'), iso, F.lit('"><p>'), iso, F.lit("</p>"))]


def _jsonld(iso, words, other):
    start = F.lit('<script type="application/ld+json">')
    end = F.lit("</script>")
    return [F.concat(start, F.lit('{"@type":"Article","datePublished":"'), iso, F.lit('","dateModified":"'), other, F.lit('"}'), end),
            F.concat(start, F.lit('[{"dateCreated":"'), words, F.lit('"}]'), end),
            F.concat(start, F.lit('{"@graph":[{"@type":"WebPage"},{"datePublished":"'), iso, F.lit('"}]}'), end),
            F.concat(start, F.lit('{"datePublished": not json '), iso, end)]


def _time(iso, words, other):
    return [F.concat(F.lit('<p><time class="x" datetime="'), iso, F.lit('">'), other, F.lit("</time></p>")),
            F.concat(F.lit("<time>"), words, F.lit('</time>')),
            F.concat(F.lit('<time datetime="soon">later</time><p>'), iso, F.lit("</p>"))]


def _visible(iso, words, other):
    filler = F.repeat(F.lit("some words of prose "), 200)
    return [F.concat(F.lit('<span class="post-date" data-date="'), iso, F.lit('">'), other, F.lit("</span>")),
            F.concat(F.lit('<div class="meta"><b>By A</b> <span class="published">'), words, F.lit('</span></div>')),
            F.concat(F.lit('<p class="byline">By B</p><i data-date="not a date">'), iso, F.lit("</i>")),
            F.concat(F.lit("<article><p>"), filler, F.lit("seen on "), words, F.lit(" in print</p></article>")),
            F.lit('<p class="meta">no date here</p>')]


def _cascade(iso, words, other):
    late = F.concat(F.lit('<time datetime="'), other, F.lit('">x</time>'))
    return [F.concat(F.lit('<meta name="date" content="'), iso, F.lit('">'), late),
            F.concat(F.lit('<script type="application/ld+json">{"datePublished":"'), iso, F.lit('"}</script>'), late),
            F.concat(F.lit('<span class="date">'), other, F.lit('</span><time datetime="'), iso, F.lit('"></time>')),
            F.concat(F.lit('<small class="updated">'), words, F.lit("</small>")),
            F.lit("<p>nothing</p>")]


_step("date_meta", D.from_meta, _meta, 2, 3)
_step("date_jsonld", D.from_jsonld, _jsonld, 3, 4)
_step("date_time_tag", D.from_time_tag, _time, 2, 3)
_step("date_visible", markup.visible_dates, _visible, 4, 5)
_step("date_html", html_dates, _cascade, 4, 5)


@query
def date_resolve(spark, sf):
    """HTML cascade, then the URL, then the feed's hint, with the step that
    gave the date."""
    pages = _pages_of(spark, sf, lambda iso, words, other: [
        F.concat(F.lit('<time datetime="'), iso, F.lit('"></time>')), F.lit("<p>x</p>"), F.lit("<p>x</p>"), F.lit("<p>x</p>")])
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy/MM/dd")
    url = F.when(k % 4 <= 1, F.concat(F.lit("https://ex.com/"), F.when(k % 4 == 0, F.lit("1999/01/01")).otherwise(day), F.lit("/x"))) \
        .otherwise(F.lit("https://ex.com/x"))
    hint = F.when(k % 4 == 2, F.date_format("o_orderdate", "d MMM yyyy")).when(k % 4 == 3, F.lit("no date"))
    j = pages.join(o, "o_orderkey").select("o_orderkey", "html", url.alias("url"), hint.alias("hint"))
    r = j.select("o_orderkey", D.resolve_with_method("html", "url", "hint").alias("r"))
    return r.select("o_orderkey", F.date_format("r.date", "yyyy-MM-dd").alias("found"), F.col("r.method").alias("method"))


Q.reg("date_resolve", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS found,
  ['html', 'url', 'hint', 'none'][o_orderkey % 4 + 1] AS method FROM orders""")


@query
def low_signal(spark, sf):
    """The filter gate with a minimum of one detail signal."""
    raw = P.windowed(A.raw_items(spark, sf), A.AS_OF, A.WINDOW_DAYS)
    spec = FilterSpec(require_publish_date=True, min_detail_signals=1)
    return gate.tag_reason(raw, spec).select("item_ord", "disposition")


Q.reg("low_signal", f"""WITH {Q.RAW}, {Q.RAW_W} SELECT item_ord, CASE WHEN publish_date IS NULL THEN 'no_date'
  WHEN len({O.signals("coalesce(title, '') || ' ' || coalesce(excerpt, '')")}) < 1 THEN 'low_signal' ELSE 'passed' END AS disposition FROM raw_w""")


@query
def image_listing(spark, sf):
    """Image files in natural order (the suffix filter, then the sort)."""
    from ..operators.order import with_global_rank
    part = A.table(spark, sf, "part")
    suffix = F.element_at(F.array(*[F.lit(x) for x in A.MEDIA_SUFFIXES]), (F.col("p_partkey") % len(A.MEDIA_SUFFIXES) + 1).cast("int"))
    files = part.select("p_partkey", F.concat(F.lit("Slide"), F.lpad(F.col("p_partkey").cast("string"), 45, "0"), suffix).alias("file_name"))
    images = blocks.image_files(files, "file_name").withColumn("nkey", T.natural_key("file_name"))
    ranked = with_global_rank(images, [F.col("nkey")], "place")
    return ranked.select("p_partkey", blocks.slide_caption("file_name").alias("caption"), "place")


Q.reg("image_listing", f"""SELECT p_partkey, 'Slide ' || CAST(p_partkey AS VARCHAR) AS caption, CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS place
  FROM part WHERE lower([{', '.join(O.q(x) for x in A.MEDIA_SUFFIXES)}][p_partkey % {len(A.MEDIA_SUFFIXES)} + 1]) IN ('.png', '.jpg', '.jpeg', '.webp', '.gif')""")


# -------------------------------------------------------------------- sinks
@query
def items_sink(spark, sf):
    """Ranked items written as JSON lines and read back."""
    from .. import sinks
    path = run_folder(spark, "items")
    sinks.write_items(C._ranked(spark, sf), path)
    back = spark.read.schema("rank long, url string, title string, source string, publish_date string, excerpt string, takeaway string, "
                             "signals array<string>, score double, url_hash string").json(path)
    return back.select("rank", "url", "title", "source", "publish_date", "excerpt", "takeaway",
                       F.array_join("signals", ",").alias("signals"), "score", "url_hash")


Q.reg("items_sink", f"""{Q.PIPE} SELECT rank, url, title, source, publish_date, excerpt, takeaway, array_to_string(signals, ',') AS signals,
  score, url_hash FROM ranked""")


@query
def seen_append(spark, sf):
    """Hashes that a run appends to the seen table, read back with the TTL."""
    from .. import sinks
    from ..sources.state import load_seen
    path = run_folder(spark, "seen")
    sinks.append_seen(C._curated(spark, sf).tagged, path, A.TASK_KEY, A.AS_OF)
    back = load_seen(spark, path, A.TASK_KEY, A.TTL_DAYS, A.AS_OF)
    return back.select("url_hash", F.date_format("first_seen_ts", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


Q.reg("seen_append", f"""WITH {Q.RAW}, {Q.RAW_W}, {Q.SEEN}, {Q.TAGGED} SELECT url_hash, '{A.AS_OF:%Y-%m-%d %H:%M:%S}' AS first_seen FROM tagged
  WHERE dup IS NULL""")


@query
def fetch_log_append(spark, sf):
    """Fetch outcomes of the enabled sources, appended and read back."""
    from .. import sinks
    from ..schema import FETCH_LOG
    path = run_folder(spark, "fetch-log")
    raw = P.windowed(A.raw_items(spark, sf), A.AS_OF, A.WINDOW_DAYS)
    scanned = health.enabled_sources(A.sources_dim(spark), health.source_health(A.fetch_log(spark, sf)))
    sinks.append_fetch_log(health.fetch_outcomes(raw.groupBy("source").agg(F.count(F.lit(1)).alias("n")), scanned, A.TASK_KEY, A.AS_OF), path)
    back = spark.read.schema(FETCH_LOG).parquet(path)
    return back.select("source_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "success", "item_count")


Q.reg("fetch_log_append", f"""WITH {Q.RAW}, {Q.RAW_W}, {Q.HEALTH}, {Q.SOURCES} SELECT label AS source_id, '{A.AS_OF:%Y-%m-%d}' AS day,
  coalesce(n, 0) > 0 AS success, coalesce(n, 0) AS item_count
  FROM sources LEFT JOIN (SELECT source, count(*) AS n FROM raw_w GROUP BY source) c ON c.source = label
  WHERE label NOT IN (SELECT source_id FROM health WHERE consecutive_failures >= 5)""")


# ---------------------------------------------------------------- streaming
def _arrivals(spark, sf, name: str, phases: list[tuple[DataFrame, int]], ttl_days: int) -> DataFrame:
    """TTL dedup over hashes that arrive in the phases' order, one run of the
    stream a phase; an event is dated ``day`` plus 0-4 days by its hash."""
    from ..streaming.incremental import ttl_dedup
    base = run_folder(spark, name)
    for rows, day in phases:
        late = F.conv(F.substring("url_hash", 1, 2), 16, 10).cast("int") % 5
        (rows.select("url_hash", F.date_add(F.lit(dt.date(2024, 1, 1)), late + day).cast("timestamp").alias("ts"))
         .write.mode("append").parquet(f"{base}/landing"))
        stream = spark.readStream.schema("url_hash string, ts timestamp").parquet(f"{base}/landing")
        q = (ttl_dedup(stream, "ts", ttl_days).select("url_hash", F.date_format("ts", "yyyy-MM-dd").alias("seen_on"))
             .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema("url_hash string, seen_on string").parquet(f"{base}/out")


def _hashes(spark, sf) -> DataFrame:
    return A.raw_items(spark, sf).select(U.url_hash("url").alias("url_hash"))


def _marked(hashes: DataFrame, mark: str) -> DataFrame:
    """Other hashes, as many."""
    return hashes.select(F.sha2(F.concat(F.lit(mark), "url_hash"), 256).alias("url_hash"))


@query
def stream_ttl_expiry(spark, sf):
    """A hash is dropped again within the TTL (day 10), and passes once the
    watermark, moved on by other hashes (day 100), has left its state behind
    (day 101)."""
    h = _hashes(spark, sf)
    return _arrivals(spark, sf, "ttl-expiry", [(h, 0), (h, 10), (_marked(h, "advance"), 100), (h, 101)], 30)


_DAY = "CAST(('0x' || substr(url_hash, 1, 2)) AS INTEGER) % 5"
_HASHES = f"h AS (SELECT DISTINCT {O.url_hash('url')} AS url_hash FROM raw)"
_ADVANCED = f"""SELECT url_hash, strftime(DATE '2024-01-01' + 100 + {_DAY}, '%Y-%m-%d') AS seen_on
  FROM (SELECT sha256('advance' || url_hash) AS url_hash FROM h)"""
Q.reg("stream_ttl_expiry", f"""WITH {Q.RAW}, {_HASHES} SELECT url_hash, strftime(DATE '2024-01-01' + {_DAY}, '%Y-%m-%d') AS seen_on FROM h
  UNION ALL SELECT url_hash, strftime(DATE '2024-01-01' + 101 + {_DAY}, '%Y-%m-%d') FROM h UNION ALL {_ADVANCED}""")


@query
def late_data(spark, sf):
    """Rows dated before the watermark are dropped, even of new hashes."""
    h = _hashes(spark, sf)
    return _arrivals(spark, sf, "late-data", [(h, 0), (_marked(h, "advance"), 100), (_marked(h, "late"), 20)], 30)


Q.reg("late_data", f"""WITH {Q.RAW}, {_HASHES} SELECT url_hash, strftime(DATE '2024-01-01' + {_DAY}, '%Y-%m-%d') AS seen_on FROM h
  UNION ALL {_ADVANCED}""")


# ------------------------------------------------- a run from landed sources
GONE = "https://gone.example.org/2024/01/29/que-the-und"
LANDED = [SourceSpec(type="rss", label="feed-a"), SourceSpec(type="rss", label="feed-b", weight=1.2),
          SourceSpec(type="arxiv", query="cat:all"), SourceSpec(type="sitemap", label="site"),
          SourceSpec(type="html_list", label="listing", url="https://list.example.com/all/pages", weight=0.9),
          SourceSpec(type="manual_urls", label="picked", url=GONE), SourceSpec(type="rss", label="off")]


def landed_job() -> JobSpec:
    return JobSpec(task_key="landed", time_window_days=A.WINDOW_DAYS, dedup_ttl_days=A.TTL_DAYS, sources=LANDED,
                   filters=FilterSpec(exclude_patterns=["nicht"]), ranking=RankingSpec(detail_signal_bonus=0.1))


def _day_of(text: Column) -> Column:
    """A publish date by the text, so that equal texts agree in it."""
    return F.date_add(F.lit(dt.date(2024, 1, 1)), F.conv(F.substring(F.sha2(text, 256), 1, 4), 16, 10).cast("int") % 30)


def _doc_link(text: Column) -> Column:
    return F.concat(F.lit("https://docs.example.org/d/"), F.substring(F.sha2(text, 256), 1, 24))


def _land(spark: SparkSession, sf: str) -> dict[str, str]:
    """Documents as two RSS-type feeds (one of them Atom) and a paper feed,
    pages as a sitemap and as a listing in numbered pages of a bounded size."""
    base = run_folder(spark, "landed")
    d = A.table(spark, sf, "documents").where("text IS NOT NULL")
    text, part = F.col("text"), F.col("doc_id") % 3
    day = F.date_format(_day_of(text).cast("timestamp_ntz"), "yyyy-MM-dd")
    rows = d.select("doc_id", text.alias("body"), _doc_link(text).alias("href"), day.alias("day"), F.concat(F.lit("T "), F.substring(F.sha2(text, 256), 1, 12)).alias("title"))
    rss = rows.where(part == 0).select("title", F.col("href").alias("link"),
                                       F.concat(F.date_format(F.col("day").cast("timestamp_ntz"), "EEE, dd MMM yyyy"), F.lit(" 10:00:00 GMT")).alias("pubDate"),
                                       F.col("body").alias("description"))
    rss.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(f"{base}/feed-a")
    link = F.array(F.struct(F.col("href").alias("_href"), F.lit("alternate").alias("_rel")))
    entry = rows.select((F.col("doc_id") % 3).alias("part"), "title", link.alias("link"),
                        F.concat(F.col("day"), F.lit("T10:00:00Z")).alias("published"), F.col("body").alias("summary"))
    for name, k in (("feed-b", 1), ("arXiv", 2)):
        entry.where(F.col("part") == k).drop("part").write.format("xml").option("rowTag", "entry").option("rootTag", "feed").save(f"{base}/{name}")
    p = A.table(spark, sf, "pages")
    loc = F.format_string("https://site.example.com/en/%d-que-page", F.col("page_id"))
    (p.select(loc.alias("loc"), F.format_string("2024-01-%02d", (F.col("page_id") % 28 + 1).cast("int")).alias("lastmod"))
     .write.format("xml").option("rowTag", "url").option("rootTag", "urlset").save(f"{base}/site"))
    card = F.format_string('<article><h3><a href="../news/2024/%d">Long enough title %d</a></h3><time datetime="2024-01-%02d"></time></article>',
                           F.col("page_id"), F.col("page_id"), (F.col("page_id") % 28 + 1).cast("int"))
    block = F.floor(F.col("page_id") / A.LISTING_CHUNK).cast("long")
    listed = (p.select("page_id", block.alias("block"), card.alias("card")).groupBy("block")
              .agg(F.sort_array(F.collect_list(F.struct("page_id", "card"))).alias("c"))
              .select((-1 - F.col("block")).alias("page_id"),
                      F.concat(F.lit(LANDED[4].url), F.when(F.col("block") == 0, "").otherwise(F.concat(F.lit("?page="), F.col("block").cast("string")))).alias("url"),
                      F.array_join(F.transform("c", lambda x: x["card"]), "").alias("html")))
    listed.unionByName(p.select("page_id", "url", "html")).write.parquet(f"{base}/listing")
    p.select("page_id", "url", "html").write.parquet(f"{base}/picked")
    return {s.source_id: f"{base}/{'arXiv' if s.type == 'arxiv' else s.source_id}" for s in LANDED} | {"off": f"{base}/feed-a"}


@query
def source_union(spark, sf):
    """All source types scanned from landed files (``off`` is disabled); a
    source that fails fails the query."""
    from ..sources.registry import scan_whole
    where = _land(spark, sf)
    raw = scan_whole(spark, LANDED, A.AS_OF, A.WINDOW_DAYS, lambda s: where[s.source_id], {"off"})
    return raw.select("url", "title", "source", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"), "source_ord")


@query
def whole_run(spark, sf):
    """A run from the job: health skips a disabled source, landed files are
    scanned, the report and all tables are written; the survivors.  They
    stand for every enabled source, so a source that fails fails the query."""
    from ..schema import FETCH_LOG
    from ..sources.registry import ScanFailed
    from .run import run_job
    where, base = _land(spark, sf), run_folder(spark, "whole-run")
    days = [(A.AS_OF - dt.timedelta(days=i)) for i in range(1, 6)]
    spark.createDataFrame([("landed", "off", d, False, 0) for d in days], FETCH_LOG).write.mode("append").partitionBy("task_key").parquet(f"{base}/log")
    result = run_job(spark, landed_job(), lambda s: where[s.source_id], as_of=A.AS_OF, out_dir=f"{base}/out", seen_path=f"{base}/seen",
                     log_path=f"{base}/log")
    if result.faults:
        raise ScanFailed(result.faults)
    back = spark.read.schema("url string, title string, source string, publish_date string, takeaway string, score double").json(f"{base}/out/items")
    return back.select("url", "title", "source", "publish_date", "takeaway", "score")


_CUT = f"DATE '{window_cutoff(A.AS_OF, A.WINDOW_DAYS):%Y-%m-%d}'"
_HEX_DAY = "(DATE '2024-01-01' + CAST(('0x' || substr(sha256(text), 1, 4)) AS INTEGER) % 30)"
_UNION = f"""docs AS (SELECT doc_id % 3 AS part, 'https://docs.example.org/d/' || substr(sha256(text), 1, 24) AS url,
    'T ' || substr(sha256(text), 1, 12) AS title, {_HEX_DAY} AS publish_date, text AS excerpt FROM documents WHERE text IS NOT NULL),
  u AS (
    SELECT url, title, ['feed-a', 'feed-b', 'cat:all'][part + 1] AS source, publish_date, part AS source_ord, excerpt FROM docs
    UNION ALL SELECT printf('https://site.example.com/en/%d-que-page', page_id), printf('%d Que Page', page_id), 'site',
      make_date(2024, 1, CAST(page_id % 28 + 1 AS INTEGER)), 3, NULL FROM pages
    UNION ALL SELECT printf('https://list.example.com/news/2024/%d', page_id), printf('Long enough title %d', page_id), 'listing',
      make_date(2024, 1, CAST(page_id % 28 + 1 AS INTEGER)), 4, NULL FROM pages
    UNION ALL SELECT '{GONE}', '{GONE}', 'picked', DATE '2024-01-29', 5, NULL),
  raw0 AS (SELECT * FROM u WHERE publish_date >= {_CUT})"""
Q.reg("source_union", f"""WITH {_UNION} SELECT url, title, CASE source WHEN 'cat:all' THEN 'arXiv:cat:all' ELSE source END AS source,
  strftime(publish_date, '%Y-%m-%d') AS publish_date, CAST(source_ord AS INTEGER) AS source_ord FROM raw0""")
Q.reg("whole_run", f"""WITH {_UNION},
  k AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source_ord) AS rn FROM raw0),
  f AS (SELECT *, {O.signals("title || ' ' || coalesce(excerpt, '')")} AS sig FROM k WHERE rn = 1
        AND instr(lower(title || ' ' || coalesce(excerpt, '')), 'nicht') = 0)
  SELECT url, title, CASE source WHEN 'cat:all' THEN 'arXiv:cat:all' ELSE source END AS source,
    strftime(publish_date, '%Y-%m-%d') AS publish_date, {O.takeaway('title', 'excerpt', 60)} AS takeaway,
    round(CASE source WHEN 'feed-b' THEN 1.2::DOUBLE WHEN 'listing' THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END
      + least(0.1::DOUBLE * len(sig), 0.3::DOUBLE) + 0.0::DOUBLE
      + CASE WHEN date_diff('day', publish_date, {Q.AS_OF_D}) <= 1 THEN 0.3::DOUBLE
             WHEN date_diff('day', publish_date, {Q.AS_OF_D}) <= 3 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END, 3) AS score FROM f""")
