"""DuckDB SQL for every registered query (tables are views named after the
driver tables).  Adapter derivations are repeated here as CTEs so the SQL
stands on its own."""

from __future__ import annotations

import datetime as dt

from ..sources import adapters as A
from ..spec import window_cutoff
from . import oracle as O

AS_OF_TS = f"TIMESTAMP '{A.AS_OF:%Y-%m-%d %H:%M:%S}'"
AS_OF_D = f"DATE '{A.AS_OF:%Y-%m-%d}'"
CUTOFF_D = f"DATE '{window_cutoff(A.AS_OF, A.WINDOW_DAYS):%Y-%m-%d}'"
TTL_TS = f"TIMESTAMP '{A.AS_OF - dt.timedelta(days=A.TTL_DAYS):%Y-%m-%d %H:%M:%S}'"

SQL: dict[str, str] = {}


def doc_url(alias: str = "") -> str:
    a = alias + "." if alias else ""
    return (f"'https://' || CASE WHEN {a}doc_id % 2 = 0 THEN upper({a}lang) ELSE {a}lang END "
            f"|| '.example.com/d/' || substr(sha256({a}text), 1, 16) || "
            f"CASE WHEN {a}doc_id % 3 = 0 THEN '/' WHEN {a}doc_id % 3 = 1 THEN '?page=1&utm_source=' || {a}source "
            f"ELSE '?page=1#top' END")


RAW = f"""raw AS (
  SELECT {doc_url()} AS url,
         split_part(split_part(text, chr(10), 1), '.', 1) AS title,
         source,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) END AS publish_date,
         text AS excerpt,
         CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) AS source_ord,
         CAST(doc_id AS BIGINT) AS item_ord
  FROM documents)"""

RAW_W = f"""raw_w AS (SELECT *, {O.url_hash('url')} AS url_hash FROM raw
  WHERE publish_date IS NULL OR publish_date >= {CUTOFF_D})"""

SEEN = f"""seen_live AS (
  SELECT url_hash, first_seen_ts FROM (
    SELECT {O.url_hash('(' + doc_url() + ')')} AS url_hash,
           {AS_OF_TS} - to_days(CAST(doc_id % 90 AS INTEGER)) AS first_seen_ts
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) s
  WHERE first_seen_ts >= {TTL_TS})"""


def _any(text: str, pats: list[str]) -> str:
    return "(" + " OR ".join(f"instr({text}, {O.q(p.lower())}) > 0" for p in pats) + ")"


def _weight_values() -> str:
    rows = ", ".join(f"({O.q(p)}, CAST({w!r} AS DOUBLE), {i})"
                     for i, (p, w) in enumerate(A.job_spec().weight_entries()))
    return f"weights AS (SELECT * FROM (VALUES {rows}) t(pattern, weight, ord))"


def _gtext(t: str = "title", e: str = "excerpt") -> str:
    return f"lower(coalesce({t}, '') || ' ' || coalesce({e}, ''))"


TAGGED = f"""tagged AS (
  SELECT r.*, sig, CASE WHEN s.url_hash IS NOT NULL THEN 'dup_state' WHEN rn > 1 THEN 'dup_run' END AS dup,
    COALESCE(CASE WHEN s.url_hash IS NOT NULL THEN 'dup_state' WHEN rn > 1 THEN 'dup_run' END,
      CASE WHEN r.publish_date IS NULL THEN 'no_date'
           WHEN NOT {_any(_gtext('r.title', 'r.excerpt'), A.INCLUDE)} THEN 'not_included'
           WHEN {_any(_gtext('r.title', 'r.excerpt'), A.EXCLUDE)} THEN 'excluded'
           ELSE 'passed' END) AS disposition
  FROM (SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY source_ord, item_ord) AS rn,
               {O.signals("coalesce(title, '') || ' ' || coalesce(excerpt, '')")} AS sig
        FROM raw_w) r
  LEFT JOIN (SELECT DISTINCT url_hash FROM seen_live) s ON r.url_hash = s.url_hash)"""

ITEMS = f"""{_weight_values()},
items AS (
  SELECT url, title, source, strftime(publish_date, '%Y-%m-%d') AS publish_date,
         {O.make_excerpt('excerpt', 120)} AS excerpt, {O.takeaway('title', 'excerpt', 60)} AS takeaway,
         sig AS signals, url_hash, source_ord, item_ord,
         round(w + least(CAST(0.1 AS DOUBLE) * len(sig), CAST(0.3 AS DOUBLE)) + CAST(0.0 AS DOUBLE)
               + CASE WHEN date_diff('day', publish_date, {AS_OF_D}) <= 1 THEN CAST(0.3 AS DOUBLE)
                      WHEN date_diff('day', publish_date, {AS_OF_D}) <= 3 THEN CAST(0.15 AS DOUBLE)
                      ELSE CAST(0.0 AS DOUBLE) END, 3) AS score
  FROM (SELECT t.*, coalesce((SELECT weight FROM weights
                              WHERE instr({O.domain('t.url')}, pattern) > 0 OR lower(pattern) = lower(t.source)
                              ORDER BY ord LIMIT 1), CAST(1.0 AS DOUBLE)) AS w
        FROM tagged t WHERE disposition = 'passed') x),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, publish_date DESC NULLS LAST,
                                             source_ord, item_ord) AS rank FROM items)"""

PIPE = f"WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}, {ITEMS}"

SOURCES = ("sources AS (SELECT 'src' || CAST(i AS VARCHAR) AS label FROM range(0, "
           f"{A.N_SOURCES}) t(i))")


def _fmt_ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def reg(name: str, sql: str) -> None:
    SQL[name] = sql.strip()


reg("url_normalize", f"SELECT page_id, {O.normalize_url('url')} AS norm_url FROM pages")
reg("url_hash", f"SELECT page_id, {O.url_hash('url')} AS url_hash FROM pages")
reg("url_domain", f"SELECT {O.domain('url')} AS domain, CAST(count(*) AS BIGINT) AS n_pages FROM pages GROUP BY 1")
reg("url_date", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL
  ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS url_date FROM orders""")
reg("slug_title", f"""SELECT p_partkey, {O.title_from_slug("'https://ex.com/news/' || lower(replace(p_name, ' ', '-')) || '/'")} AS title FROM part""")
reg("parse_date", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS parsed FROM orders")
reg("strip_html", f"SELECT page_id, {O.strip_html('html')} AS text FROM pages")
reg("truncate_words", f"SELECT doc_id, {O.truncate_words('text', 60)} AS cut FROM documents")
reg("excerpt", f"SELECT doc_id, {O.make_excerpt('text', 120)} AS excerpt FROM documents")
reg("sentences", f"""SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, coalesce(s[1], '') AS first_sentence,
  coalesce(s[-1], '') AS last_sentence FROM (SELECT doc_id, {O.sentences('text')} AS s FROM documents)""")
reg("takeaway", f"WITH {RAW} SELECT item_ord, {O.takeaway('title', 'excerpt', 60)} AS takeaway FROM raw")
reg("signals", f"SELECT doc_id, array_to_string({O.signals('text')}, ',') AS signals FROM documents")
reg("freshness", f"""WITH {RAW} SELECT item_ord,
  CASE WHEN publish_date IS NULL THEN CAST(0.0 AS DOUBLE)
       WHEN date_diff('day', publish_date, {AS_OF_D}) <= 1 THEN CAST(0.3 AS DOUBLE)
       WHEN date_diff('day', publish_date, {AS_OF_D}) <= 3 THEN CAST(0.15 AS DOUBLE)
       ELSE CAST(0.0 AS DOUBLE) END AS freshness FROM raw""")
reg("stars_clip", f"""{PIPE} SELECT item_ord, {O.stars('score')} AS stars, {O.clip('title', 60)} AS title_60,
  {O.clip('title', 55)} AS title_55, {O.clip('title', 50)} AS title_50 FROM items""")
reg("window_gate", f"""WITH {RAW} SELECT item_ord, strftime(publish_date, '%Y-%m-%d') AS publish_date FROM raw
  WHERE publish_date IS NULL OR publish_date >= {CUTOFF_D}""")
reg("seen_ttl", f"WITH {SEEN} SELECT url_hash, strftime(first_seen_ts, '%Y-%m-%d %H:%M:%S') AS first_seen FROM seen_live")
reg("dedup_state", f"""WITH {RAW}, {RAW_W}, {SEEN} SELECT item_ord, url_hash FROM raw_w
  WHERE url_hash NOT IN (SELECT url_hash FROM seen_live)""")
reg("dedup_run", f"""WITH {RAW}, {RAW_W} SELECT item_ord, url_hash FROM (
  SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY source_ord, item_ord) AS rn FROM raw_w) WHERE rn = 1""")
reg("disposition", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}
  SELECT item_ord, url_hash, disposition, array_to_string(sig, ',') AS signals FROM tagged""")
reg("source_weight", f"""WITH {RAW}, {_weight_values()} SELECT item_ord, {O.domain('r.url')} AS domain, source,
  coalesce((SELECT weight FROM weights WHERE instr({O.domain('r.url')}, pattern) > 0 OR lower(pattern) = lower(r.source)
            ORDER BY ord LIMIT 1), CAST(1.0 AS DOUBLE)) AS weight FROM raw r""")
reg("multi_source", f"""WITH {RAW} SELECT url_hash, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(DISTINCT source) AS BIGINT) AS n_sources FROM (SELECT {O.url_hash('url')} AS url_hash, source FROM raw)
  GROUP BY url_hash""")
reg("score_rank", f"""{PIPE} SELECT rank, url_hash, score, publish_date, source, title, excerpt, takeaway,
  array_to_string(signals, ',') AS signals FROM ranked""")
reg("curated_top", f"""{PIPE} SELECT rank, {O.stars('score')} AS stars, publish_date, source,
  {O.clip('title', 60)} AS title, takeaway, url, score FROM ranked WHERE rank <= 5""")

_COUNTERS = """CAST(count(*) AS BIGINT) AS fetched,
  CAST(count(*) FILTER (WHERE dup IS NOT NULL) AS BIGINT) AS deduped,
  CAST(count(*) FILTER (WHERE disposition IN ('no_date','not_included','excluded','low_signal')) AS BIGINT) AS filtered_out,
  CAST(count(*) FILTER (WHERE disposition = 'passed') AS BIGINT) AS final,
  CAST(count(*) FILTER (WHERE disposition = 'no_date') AS BIGINT) AS no_date,
  CAST(count(*) FILTER (WHERE disposition = 'not_included') AS BIGINT) AS not_included,
  CAST(count(*) FILTER (WHERE disposition = 'excluded') AS BIGINT) AS excluded,
  CAST(count(*) FILTER (WHERE disposition = 'low_signal') AS BIGINT) AS low_signal"""

reg("run_stats_rollup", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}
  SELECT source, {_COUNTERS}, CASE WHEN grouping(source) = 1 THEN 'total' ELSE 'source' END AS level
  FROM tagged GROUP BY ROLLUP (source)""")

PER_SOURCE = f"""obs AS (SELECT source, CAST(count(*) AS BIGINT) AS fetched,
    CAST(count(*) FILTER (WHERE dup IS NULL) AS BIGINT) AS dedup_kept,
    CAST(count(*) FILTER (WHERE disposition = 'no_date') AS BIGINT) AS no_date,
    CAST(count(*) FILTER (WHERE disposition = 'not_included') AS BIGINT) AS not_included,
    CAST(count(*) FILTER (WHERE disposition = 'excluded') AS BIGINT) AS excluded,
    CAST(count(*) FILTER (WHERE disposition = 'low_signal') AS BIGINT) AS low_signal,
    CAST(count(*) FILTER (WHERE disposition = 'passed') AS BIGINT) AS final
  FROM tagged GROUP BY source),
{SOURCES},
per_source AS (SELECT coalesce(o.source, c.label) AS source,
    coalesce(fetched, 0) AS fetched, coalesce(dedup_kept, 0) AS dedup_kept,
    greatest(0, coalesce(fetched, 0) - coalesce(dedup_kept, 0)) AS dedup_dropped,
    coalesce(dedup_kept, 0) AS filter_input,
    greatest(0, coalesce(dedup_kept, 0) - coalesce(final, 0)) AS filter_dropped,
    coalesce(no_date, 0) AS no_date, coalesce(not_included, 0) AS not_included,
    coalesce(excluded, 0) AS excluded, coalesce(low_signal, 0) AS low_signal, coalesce(final, 0) AS final
  FROM obs o FULL OUTER JOIN (SELECT DISTINCT label FROM sources) c ON o.source = c.label)"""

reg("per_source_stats", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}, {PER_SOURCE}
  SELECT source, CAST(fetched AS BIGINT) AS fetched, CAST(dedup_kept AS BIGINT) AS dedup_kept,
    CAST(dedup_dropped AS BIGINT) AS dedup_dropped, CAST(filter_input AS BIGINT) AS filter_input,
    CAST(filter_dropped AS BIGINT) AS filter_dropped, CAST(no_date AS BIGINT) AS no_date,
    CAST(not_included AS BIGINT) AS not_included, CAST(excluded AS BIGINT) AS excluded,
    CAST(low_signal AS BIGINT) AS low_signal, CAST(final AS BIGINT) AS final FROM per_source""")
reg("silent_sources", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}, {PER_SOURCE}
  SELECT c.label AS source,
    CASE WHEN coalesce(p.fetched, 0) = 0 THEN 'empty/failed'
         WHEN coalesce(p.dedup_dropped, 0) >= coalesce(p.fetched, 0) AND coalesce(p.filter_dropped, 0) = 0 THEN 'all deduped'
         WHEN coalesce(p.filter_dropped, 0) > 0 THEN 'all filtered' ELSE 'none selected' END AS reason,
    CAST(coalesce(p.fetched, 0) AS BIGINT) AS fetched, CAST(coalesce(p.dedup_dropped, 0) AS BIGINT) AS dedup_dropped,
    CAST(coalesce(p.filter_dropped, 0) AS BIGINT) AS filter_dropped
  FROM (SELECT DISTINCT label FROM sources) c LEFT JOIN per_source p ON p.source = c.label
  WHERE coalesce(p.final, 0) = 0""")
reg("active_sources", f"""{PIPE} SELECT CAST(count(DISTINCT source) AS BIGINT) AS active_sources,
  CAST(count(*) AS BIGINT) AS item_count FROM items""")
reg("waterline", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}
  SELECT b.before, n.new_hashes, b.before + n.new_hashes AS after FROM
  (SELECT CAST(count(DISTINCT url_hash) AS BIGINT) AS before FROM seen_live) b,
  (SELECT CAST(count(*) FILTER (WHERE dup IS NULL) AS BIGINT) AS new_hashes FROM tagged) n""")


def _theme_case(text: str) -> str:
    parts = " ".join(f"WHEN {_any(text, words)} THEN {O.q(name)}" for name, words in A.THEMES)
    return f"CASE {parts} END"


reg("theme_assign", f"{PIPE} SELECT item_ord, {_theme_case(_gtext())} AS theme FROM items")
reg("theme_board", f"""{PIPE}, th AS (SELECT *, {_theme_case(_gtext())} AS theme FROM ranked),
  c AS (SELECT theme, CAST(count(*) AS BIGINT) AS n, min(rank) AS first_rank FROM th WHERE theme IS NOT NULL GROUP BY theme),
  r AS (SELECT theme, string_agg(title, ' | ' ORDER BY rank) AS ref_titles,
               string_agg(CAST(rank AS VARCHAR), ',' ORDER BY rank) AS ref_ranks
        FROM (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY rank) AS k FROM th WHERE theme IS NOT NULL)
        WHERE k <= 5 GROUP BY theme)
  SELECT c.theme, n, CAST(first_rank AS BIGINT) AS first_rank, ref_titles, ref_ranks FROM c JOIN r USING (theme)
""")

LOG = """log AS (SELECT 'src' || CAST(user_id AS VARCHAR) AS source_id, ts, event_type = 'purchase' AS success,
  CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS item_count FROM events)"""
HEALTH = f"""{LOG}, h1 AS (SELECT source_id, max(ts) FILTER (WHERE success) AS last_success,
    max(ts) FILTER (WHERE NOT success) AS last_failure,
    CAST(sum(CASE WHEN success THEN item_count ELSE 0 END) AS BIGINT) AS total_items_fetched FROM log GROUP BY source_id),
  health AS (SELECT h1.*, CAST((SELECT count(*) FROM log l WHERE l.source_id = h1.source_id AND NOT l.success
      AND (h1.last_success IS NULL OR l.ts > h1.last_success)) AS BIGINT) AS consecutive_failures FROM h1)"""
reg("health_fold", f"""WITH {HEALTH} SELECT source_id, consecutive_failures, {_fmt_ts('last_success')} AS last_success,
  {_fmt_ts('last_failure')} AS last_failure, consecutive_failures >= 5 AS disabled, total_items_fetched FROM health""")
reg("health_alerts", f"""WITH {HEALTH} SELECT source_id, consecutive_failures AS failures,
  consecutive_failures >= 5 AS disabled, CASE WHEN consecutive_failures >= 5 THEN 'disabled' ELSE 'alert' END AS status
  FROM health WHERE consecutive_failures >= 3""")

reg("page_title", f"SELECT page_id, {O.page_title('html')} AS title FROM pages")
_ROOT = O.main_text_parts("html")[0]
reg("page_excerpt", f"""SELECT page_id, coalesce(md, nullif({O.main_text_from_root('root')}, '')) AS excerpt
  FROM (SELECT page_id, {O.meta_description('html')} AS md, {_ROOT} AS root FROM pages)""")
reg("main_text", f"""SELECT page_id, {O.main_text_from_root('root')} AS main_text
  FROM (SELECT page_id, {_ROOT} AS root FROM pages)""")

# ------------------------------------------------------------------ pages
from ..sources import pages as PG  # noqa: E402

def _no_dots(path: str) -> str:
    """Remove '/./' and '/x/../' by repeated replacement."""
    out = f"regexp_replace({path}, '/[.](/|$)', '/', 'g')"
    for _ in range(6):
        out = f"regexp_replace({out}, '/(?:[^/.][^/]*|[.][^/.][^/]*)/[.][.](/|$)', '/')"
    return f"regexp_replace({out}, '^(/[.][.])+(/|$)', '/')"


def _resolve(base: str, href: str) -> str:
    scheme = O.url_part(base, 1)
    auth = O.url_part(base, 2)
    bpath = O.url_part(base, 3)
    origin = f"({scheme} || '://' || {auth})"
    no_frag = f"regexp_replace({base}, '#.*$', '')"
    bdir = f"regexp_replace({bpath}, '[^/]*$', '')"
    ref_path, ref_tail = f"regexp_extract({href}, '^[^?#]*', 0)", f"regexp_replace({href}, '^[^?#]*', '')"
    return (f"(CASE WHEN regexp_matches({href}, {O.q(PG.RX_SCHEME)}) THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {origin} || {_no_dots(ref_path)} || {ref_tail} "
            f"WHEN {href} = '' THEN {no_frag} "
            f"WHEN starts_with({href}, '#') THEN {no_frag} || {href} "
            f"WHEN starts_with({href}, '?') THEN {origin} || {bpath} || {href} "
            f"ELSE {origin} || {_no_dots(f"CASE WHEN {bdir} = '' THEN '/' ELSE {bdir} END || {ref_path}")} || {ref_tail} END)")


def _likely_article(href: str, text: str, base: str) -> str:
    path = O.url_part(href, 3)
    shallow = f"({path} = '' OR {path} = '/' OR length({path}) - length(replace({path}, '/', '')) <= 1)"
    self_link = f"regexp_replace({href}, '/+$', '') = regexp_replace({base}, '/+$', '')"
    anchor = f"(instr({href}, '#') > 0 AND {path} = {O.url_part(base, 3)})"
    return (f"(NOT regexp_matches({O.strip(text)}, {O.q(PG.NAV_TEXT)}) "
            f"AND NOT ({shallow} AND NOT regexp_matches({path}, {O.q(PG.ARTICLE_PATH_HINT)})) "
            f"AND NOT ({self_link}) AND NOT {anchor})")


def _same_site(ld: str, bd: str) -> str:
    return f"({ld} = {bd} OR ends_with({bd}, '.' || {ld}) OR ends_with({ld}, '.' || {bd}))"


# What must come out of the test listings, from the rule that made them: a link per page, dated by its card but for the fourth layout.
LINKS = f"""anchors AS (
  SELECT printf('https://%s/list/%d', {O.domain('url')}, CAST(floor(page_id / {A.LISTING_CHUNK}) AS BIGINT)) AS listing_url, page_id AS seg_pos,
         CASE WHEN page_id % 4 < 3 THEN make_date(2024, 1, CAST(page_id % 30 + 1 AS INTEGER)) END AS ctx_date,
         CASE WHEN page_id % 8 = 3 THEN '../x/..' || regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-z]+://[^/]*', '')
              ELSE regexp_replace(url, '#.*$', '') END AS h,
         regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t
  FROM pages),
links0 AS (SELECT listing_url, seg_pos, ctx_date, {_resolve('listing_url', O.unescape(O.strip('h')))} AS href,
                  {O.node_text('t')} AS text FROM anchors),
links1 AS (SELECT *, row_number() OVER (PARTITION BY listing_url, href ORDER BY seg_pos) AS k FROM links0
  WHERE {_same_site(O.domain('href'), O.domain('listing_url'))} AND length(text) >= 10
    AND {_likely_article('href', 'text', 'listing_url')}),
links AS (SELECT listing_url, row_number() OVER (PARTITION BY listing_url ORDER BY seg_pos) AS link_pos,
                 href, text, ctx_date FROM links1 WHERE k = 1)"""

reg("page_links", f"""WITH {LINKS} SELECT listing_url, CAST(link_pos AS BIGINT) AS link_pos, href, text,
  strftime(ctx_date, '%Y-%m-%d') AS ctx_date FROM links""")

reg("listing_scan", f"""WITH {LINKS},
  lookup AS (SELECT {O.url_hash('url')} AS page_key, arg_min(html, page_id) AS page_html FROM pages GROUP BY 1),
  j AS (SELECT l.*, coalesce(ctx_date, {O.date_from_url('href')}) AS known, page_html
        FROM links l LEFT JOIN lookup p ON {O.url_hash('l.href')} = p.page_key),
  j2 AS (SELECT *, CASE WHEN known IS NULL AND page_html IS NOT NULL THEN row_number() OVER (
           PARTITION BY listing_url, (known IS NULL AND page_html IS NOT NULL) ORDER BY link_pos) END AS lk FROM j),
  j3 AS (SELECT *, CASE WHEN lk IS NOT NULL THEN {O.from_html('page_html')} END AS page_date FROM j2),
  r AS (SELECT *, coalesce(known, page_date) AS resolved FROM j3)
  SELECT href AS url, text AS title, listing_url AS source,
         strftime(coalesce(resolved, {AS_OF_D}), '%Y-%m-%d') AS publish_date,
         CASE WHEN ctx_date IS NOT NULL THEN 'context' WHEN known IS NOT NULL THEN 'url'
              WHEN page_date IS NOT NULL THEN 'page' ELSE 'fallback' END AS date_method,
         CAST(link_pos AS BIGINT) AS link_pos
  FROM r WHERE resolved IS NULL OR resolved >= {CUTOFF_D}""")

reg("url_list_scan", f"""WITH urls AS (SELECT page_id AS url_ord, CASE WHEN page_id % 10 = 0
      THEN regexp_replace(url, '#.*$', '') || '/gone' ELSE url END AS url FROM pages),
  pg AS (SELECT url, arg_min(html, page_id) AS html FROM pages GROUP BY url)
  SELECT u.url_ord, u.url,
    CASE WHEN html IS NOT NULL THEN coalesce(nullif({O.page_title('html')}, ''), u.url) ELSE u.url END AS title,
    'manual' AS source,
    strftime(CASE WHEN html IS NOT NULL THEN coalesce({O.from_html('html')}, {O.date_from_url('u.url')})
             ELSE {O.date_from_url('u.url')} END, '%Y-%m-%d') AS publish_date,
    CASE WHEN html IS NOT NULL THEN {O.meta_description('html')} END AS excerpt,
    CAST(length(html) AS BIGINT) AS html_chars
  FROM urls u LEFT JOIN pg ON u.url = pg.url""")

# ---------------------------------------------------------------- reports
from ..operators import report as RP  # noqa: E402
from ..operators import blocks as BK  # noqa: E402

reg("timeline_lines", f"""{PIPE} SELECT rank AS line_ord,
  printf('| %d | %s | %s | %s | %s | [%s](%s) |', rank, coalesce(publish_date, ''), coalesce(source, ''),
         {O.clip('title', 55)}, coalesce(excerpt, ''), {O.q(RP.LINK_LABEL)}, coalesce(url, '')) AS line FROM ranked""")

reg("source_lines", f"""{PIPE}, l AS (
  SELECT 0 AS rank, 1 AS k, '# Sources' AS line UNION ALL SELECT 0, 2, ''
  UNION ALL SELECT rank, 1 AS k, printf('%d. [%s](%s)', rank, coalesce(title, ''), coalesce(url, '')) AS line FROM ranked
  UNION ALL SELECT rank, 2, printf('   - Date: %s | Source: %s', coalesce(publish_date, ''), coalesce(source, '')) FROM ranked
  UNION ALL SELECT rank, 3, CASE WHEN substr(coalesce(excerpt, ''), 1, 80) <> ''
                       THEN '   - ' || substr(coalesce(excerpt, ''), 1, 80) END FROM ranked
  UNION ALL SELECT rank, 4, '' FROM ranked)
  SELECT rank, CAST(k AS BIGINT) AS line_ord, line FROM l WHERE line IS NOT NULL""")

reg("item_docs", f"""{PIPE} SELECT rank,
  printf('%03d_%s.md', rank, substr(regexp_replace(coalesce(title, ''), '[^\\p{{L}}\\p{{N}} _-]', '_', 'g'), 1, 60)) AS doc_name,
  printf('# %s' || chr(10) || chr(10) || '- URL: %s' || chr(10) || '- Date: %s' || chr(10) || '- Source: %s'
         || chr(10) || '- Score: %s' || chr(10) || '- Signals: %s' || chr(10) || chr(10) || '%s' || chr(10),
         coalesce(title, ''), coalesce(url, ''), coalesce(publish_date, ''), coalesce(source, ''),
         CAST(score AS VARCHAR), CASE WHEN len(signals) > 0 THEN array_to_string(signals, ', ') ELSE 'none' END,
         coalesce(excerpt, '')) AS body FROM ranked""")

_BODY = "replace(text, chr(10), chr(10) || chr(10))"
reg("text_blocks", f"""WITH d AS (SELECT doc_id, {_BODY} AS body,
      CASE WHEN {O.strip(f"split_part({O.strip('text')}, chr(10), 1)")} = '' THEN 'Untitled'
           ELSE {O.strip(f"split_part({O.strip('text')}, chr(10), 1)")} END AS title FROM documents),
  p0 AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS p_pos
         FROM (SELECT doc_id, regexp_split_to_array({O.strip('body')}, '\\n{{2,}}') AS ps FROM d)),
  p AS (SELECT doc_id, p_pos, {O.strip('p')} AS p FROM p0 WHERE {O.strip('p')} <> ''),
  c AS (SELECT doc_id, p_pos, p, starts_with(p, '^') AS heading,
               unnest(range(0, CASE WHEN starts_with(p, '^') THEN 1 ELSE CAST(ceil(length(p) / {BK.MAX_LEN}) AS BIGINT) END)) AS c
        FROM p),
  b AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p_pos, c) AS block_ord,
               CASE WHEN heading THEN 'heading_3' ELSE 'paragraph' END AS block_type,
               CASE WHEN heading THEN regexp_replace(p, '^[\\^ ]+', '') ELSE substr(p, CAST(c * {BK.MAX_LEN} + 1 AS BIGINT), {BK.MAX_LEN}) END AS content
        FROM c)
  SELECT b.doc_id, CAST(block_ord AS BIGINT) AS block_ord, block_type, content, block_ord <= {BK.MAX_BLOCKS} AS sent, d.title
  FROM b JOIN d USING (doc_id)""")


def _natural_key(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(coalesce({x}, ''), '[0-9]+|[^0-9]+'), "
            f"lambda r: CASE WHEN regexp_matches(r, '^[0-9]+$') THEN '0' || lpad(CAST(length(regexp_replace(r, '^0+', '')) AS VARCHAR), 10, '0') "
            f"|| regexp_replace(r, '^0+', '') "
            f"ELSE '1' || lower(r) || chr(1) END), '')")


def _caption(x: str) -> str:
    d = f"regexp_extract({x}, '([0-9]+)', 1)"
    return (f"CASE WHEN {d} <> '' THEN 'Slide ' || CASE WHEN regexp_replace({d}, '^0+', '') = '' THEN '0' "
            f"ELSE regexp_replace({d}, '^0+', '') END ELSE {x} END")


reg("natural_sort", f"""SELECT c_custkey, c_name, {_caption('c_name')} AS caption,
  CAST(row_number() OVER (ORDER BY {_natural_key('c_name')}, c_custkey) AS BIGINT) AS natural_rank FROM customer""")


def _media(x: str) -> str:
    ext = f"regexp_extract(lower({x}), '\\.([a-z0-9]+)$', 1)"
    return (f"CASE WHEN {ext} IN ('png','jpg','jpeg','gif','webp','bmp','svg','tif','tiff','ico') THEN 'image' "
            f"WHEN {ext} = 'pdf' THEN 'pdf' WHEN {ext} IN ('mp3','wav','ogg','m4a','aac','flac','aif','aiff') THEN 'audio' "
            f"WHEN {ext} IN ('mp4','mov','avi','webm','mkv','mpeg','mpg','m4v') THEN 'video' ELSE 'file' END")


_SUFFIX = "[" + ", ".join(O.q(x) for x in A.MEDIA_SUFFIXES) + f"][p_partkey % {len(A.MEDIA_SUFFIXES)} + 1]"
reg("media_type", f"""SELECT p_partkey, file_name, {_media('file_name')} AS block_type
  FROM (SELECT p_partkey, replace(lower(p_name), ' ', '_') || {_SUFFIX} AS file_name FROM part)""")

# ----------------------------------------------------------------- export
_PENDING = "pending AS (SELECT * FROM ranked WHERE url_hash NOT IN (SELECT url_hash FROM ranked WHERE item_ord IN (SELECT doc_id FROM labels WHERE quality = 1)))"
reg("import_pending", f"{PIPE}, {_PENDING} SELECT url_hash, rank FROM pending")
reg("export_batches", f"""{PIPE}, {_PENDING} SELECT url_hash, rank, CAST(pos AS BIGINT) AS pos,
  CAST(floor((pos - 1) / 20) AS BIGINT) AS batch FROM (SELECT *, row_number() OVER (ORDER BY rank) AS pos FROM pending)""")
reg("coverage", f"""{PIPE} SELECT strftime(min(CAST(publish_date AS DATE)), '%Y-%m-%d') AS date_from,
  strftime(max(CAST(publish_date AS DATE)), '%Y-%m-%d') AS date_to,
  CASE WHEN min(publish_date) IS NULL THEN 'dates-unknown'
       ELSE strftime(min(CAST(publish_date AS DATE)), '%m.%d') || '-' || strftime(max(CAST(publish_date AS DATE)), '%m.%d') END AS label,
  CAST(count(*) AS BIGINT) AS n FROM items""")

# ------------------------------------------------------------ run records
reg("enabled_sources", f"""WITH {HEALTH}, {SOURCES} SELECT label FROM sources
  WHERE label NOT IN (SELECT source_id FROM health WHERE consecutive_failures >= 5)""")
reg("job_status", f"""WITH {HEALTH} SELECT '{A.TASK_KEY}' AS task_key,
  (SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) FROM log) AS runs,
  (SELECT strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') FROM log) AS last_run,
  CAST(count(*) AS BIGINT) AS sources, CAST(count(*) FILTER (WHERE consecutive_failures >= 5) AS BIGINT) AS disabled,
  CAST(count(*) FILTER (WHERE consecutive_failures >= 3) AS BIGINT) AS alerting,
  CAST(sum(total_items_fetched) AS BIGINT) AS items_fetched FROM health""")
reg("manifest_row", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}
  SELECT '{A.TASK_KEY}' AS task_key, '{A.AS_OF:%Y%m%dT%H%M%S}' AS run_id, '{A.AS_OF:%Y-%m-%dT%H:%M:%S}+00:00' AS started_at,
    CAST({A.WINDOW_DAYS} AS BIGINT) AS window_days, CAST({A.TTL_DAYS} AS BIGINT) AS dedup_ttl_days,
    fetched, deduped, filtered_out, final, waterline_before, waterline_before + fetched - deduped AS waterline_after,
    CAST({A.N_SOURCES} AS BIGINT) AS configured_sources, '0.1.0' AS version,
    no_date, not_included, excluded, low_signal, '{A.AS_OF:%Y-%m-%dT%H:%M:%S}+00:00' AS completed_at
  FROM (SELECT CAST(count(*) AS BIGINT) AS fetched, CAST(count(*) FILTER (WHERE dup IS NOT NULL) AS BIGINT) AS deduped,
          CAST(count(*) FILTER (WHERE disposition IN ('no_date','not_included','excluded','low_signal')) AS BIGINT) AS filtered_out,
          CAST(count(*) FILTER (WHERE disposition = 'no_date') AS BIGINT) AS no_date,
          CAST(count(*) FILTER (WHERE disposition = 'not_included') AS BIGINT) AS not_included,
          CAST(count(*) FILTER (WHERE disposition = 'excluded') AS BIGINT) AS excluded,
          CAST(count(*) FILTER (WHERE disposition = 'low_signal') AS BIGINT) AS low_signal,
          CAST(count(*) FILTER (WHERE disposition = 'passed') AS BIGINT) AS final FROM tagged) t,
       (SELECT CAST(count(DISTINCT url_hash) AS BIGINT) AS waterline_before FROM seen_live) s""")

# -------------------------------------------------------------- streaming
reg("stream_incremental", f"{PIPE} SELECT url_hash, source, publish_date, score, title FROM items")
reg("stream_ttl_dedup", f"WITH {RAW}, {RAW_W} SELECT DISTINCT url_hash FROM raw_w")
reg("stream_health", SQL["health_fold"])

# --------------------------------------------------------- feeds, sitemaps
reg("rss_scan", f"""WITH {RAW} SELECT {O.strip('url')} AS url, {O.strip("coalesce(title, '')")} AS title,
  'corpus-rss' AS source, strftime(publish_date, '%Y-%m-%d') AS publish_date,
  nullif(excerpt, '') AS excerpt
  FROM raw WHERE {O.strip('url')} <> '' AND (publish_date IS NULL OR publish_date >= {CUTOFF_D})""")

reg("atom_scan", f"""WITH {RAW}
  SELECT {O.strip('url')} AS url, replace({O.strip('excerpt')}, chr(10), ' ') AS title,
    source, strftime(publish_date, '%Y-%m-%d') AS publish_date,
    CASE WHEN {O.strip("coalesce(excerpt, '')")} <> '' THEN replace({O.strip("coalesce(excerpt, '')")}, chr(10), ' ') END AS excerpt
  FROM raw WHERE {O.strip('url')} <> '' AND (publish_date IS NULL OR publish_date >= {CUTOFF_D})""")

LASTMOD = "coalesce(lastmod, '')"
reg("sitemap_scan", f"""WITH s AS (
    SELECT CASE WHEN page_id % 11 = 0 THEN NULL
                WHEN page_id % 3 = 1 THEN printf('%s/2024/01/%02d/', regexp_replace(url, '#.*$', ''), page_id % 28 + 1)
                ELSE regexp_replace(url, '#.*$', '') END AS loc,
           CASE WHEN page_id % 3 = 0 THEN printf('2024-01-%02d', page_id % 28 + 1) END AS lastmod
    FROM pages),
  u AS (SELECT {O.strip("coalesce(loc, '')")} AS url, lastmod FROM s),
  d AS (SELECT url, coalesce({O.parse_date(f"nullif({O.strip(LASTMOD)}, '')")},
                             {O.date_from_url('url')}) AS pd FROM u WHERE url <> '' AND instr(url, '/en/') > 0)
  SELECT url, {O.title_from_slug('url')} AS title, 'corpus-sitemap' AS source, strftime(pd, '%Y-%m-%d') AS publish_date
  FROM d WHERE pd IS NOT NULL AND pd >= {CUTOFF_D}""")

# ---------------------------------------------------------- weekly report
import datetime as _dt  # noqa: E402

from .. import __version__  # noqa: E402


def _lit_rows(section: int, part: int, lines: list[str], start: int = 0) -> str:
    return " UNION ALL ".join(f"SELECT {section}, {part}, {start + i}, {O.q(t)}" for i, t in enumerate(lines))


_BIG = 1 << 40
_START = (A.AS_OF - _dt.timedelta(days=A.WINDOW_DAYS)).strftime("%Y-%m-%d")
_TITLE = A.TASK_KEY.replace("_", " ").title()
_THEME_BOARD = f"""th AS (SELECT *, {_theme_case(_gtext())} AS theme FROM ranked),
  tc AS (SELECT theme, count(*) AS n, min(rank) AS first_rank FROM th WHERE theme IS NOT NULL GROUP BY theme),
  board AS (SELECT *, row_number() OVER (ORDER BY n DESC, first_rank) AS i FROM tc ORDER BY n DESC, first_rank LIMIT 6),
  refs AS (SELECT theme, rank, title, url, publish_date,
                  row_number() OVER (PARTITION BY theme ORDER BY rank) AS p FROM th WHERE theme IS NOT NULL)"""
_SILENT = f"""silent AS (SELECT c.label AS source,
    CASE WHEN coalesce(p.fetched, 0) = 0 THEN '{RP.SILENT_REASON_TEXT[0][1]}'
         WHEN coalesce(p.dedup_dropped, 0) >= coalesce(p.fetched, 0) AND coalesce(p.filter_dropped, 0) = 0 THEN '{RP.SILENT_REASON_TEXT[1][1]}'
         WHEN coalesce(p.filter_dropped, 0) > 0 THEN '{RP.SILENT_REASON_TEXT[2][1]}' ELSE '{RP.SILENT_REASON_TEXT[3][1]}' END AS reason,
    coalesce(p.fetched, 0) AS fetched, coalesce(p.dedup_dropped, 0) AS dedup_dropped, coalesce(p.filter_dropped, 0) AS filter_dropped
  FROM (SELECT DISTINCT label FROM sources) c LEFT JOIN per_source p ON p.source = c.label WHERE coalesce(p.final, 0) = 0)"""
_ALERTS = """alerts AS (SELECT source_id, consecutive_failures AS failures, consecutive_failures >= 5 AS disabled, last_failure
  FROM health WHERE consecutive_failures >= 3)"""
_LINES = f"""lines(section, part, line_ord, line) AS (
  {_lit_rows(0, 0, ['# ' + _TITLE, '', RP.W_PERIOD.format(start=_START, end=f'{A.AS_OF:%Y-%m-%d}'),
                    RP.W_GENERATED.format(generated=f'{A.AS_OF:%Y-%m-%d %H:%M} UTC')])}
  UNION ALL SELECT 0, 0, 4, printf({O.q(RP.W_SOURCES)}, {A.N_SOURCES}, (SELECT count(DISTINCT source) FROM ranked), (SELECT count(*) FROM ranked))
  UNION ALL {_lit_rows(0, 0, ['', '---', ''], 5)}
  UNION ALL SELECT 1, 0, 0, printf({O.q(RP.W_TOP)}, least(5, (SELECT count(*) FROM ranked)))
  UNION ALL {_lit_rows(1, 0, [''] + RP.TOP_HEADER, 1)}
  UNION ALL SELECT 1, rank, 0, printf('| %d | %s | %s | %s | %s | %s | [%s](%s) |', rank, {O.stars('score')},
      coalesce(publish_date, ''), coalesce(source, ''), {O.clip('title', 60)}, coalesce(takeaway, ''),
      {O.q(RP.LINK_LABEL)}, coalesce(url, '')) FROM ranked WHERE rank <= 5
  UNION ALL {_lit_rows(1, _BIG, ['', '---', ''])}
  UNION ALL {_lit_rows(2, 0, RP.TIMELINE_HEADER)}
  UNION ALL SELECT 2, rank, 0, printf('| %d | %s | %s | %s | %s | [%s](%s) |', rank, coalesce(publish_date, ''),
      coalesce(source, ''), {O.clip('title', 55)}, coalesce(excerpt, ''), {O.q(RP.LINK_LABEL)}, coalesce(url, '')) FROM ranked
  UNION ALL {_lit_rows(2, _BIG, ['', '---', ''])}
  UNION ALL SELECT 3, 0, 0, printf({O.q(RP.W_THEMES)}, (SELECT count(*) FROM board))
  UNION ALL {_lit_rows(3, 0, [''], 1)}
  UNION ALL SELECT 3, i, 0, printf({O.q(RP.W_THEME_HEAD)}, i, theme) FROM board
  UNION ALL SELECT 3, i, 1, '' FROM board
  UNION ALL SELECT 3, i, 2, printf({O.q(RP.W_THEME_SUMMARY)}, n, theme) FROM board
  UNION ALL SELECT 3, i, 3, '' FROM board
  UNION ALL SELECT 3, i, 4, {O.q(RP.W_THEME_REFS)} FROM board
  UNION ALL SELECT 3, b.i, 4 + r.p, printf({O.q(RP.W_THEME_REF)}, {O.clip('r.title', 50)}, coalesce(r.url, ''), coalesce(r.publish_date, ''))
      FROM board b JOIN refs r ON r.theme = b.theme AND r.p <= 5
  UNION ALL SELECT 3, b.i, 5 + least(5, b.n), '' FROM board b
  UNION ALL SELECT 3, {1 << 39}, 0, {O.q(RP.W_NO_THEMES)} WHERE (SELECT count(*) FROM board) = 0
  UNION ALL {_lit_rows(3, _BIG, ['', '---', ''])}
  UNION ALL {_lit_rows(4, 0, [RP.W_SILENT, ''])}
  UNION ALL SELECT 4, 0, 2 + t.k, t.line FROM (SELECT unnest([{', '.join(O.q(x) for x in [RP.W_SILENT_INTRO, ''] + RP.W_SILENT_HEADER)}]) AS line,
      unnest(range(0, 4)) AS k) t WHERE (SELECT count(*) FROM silent) > 0
  UNION ALL SELECT 4, 1, row_number() OVER (ORDER BY CAST(substr(source, 4) AS INTEGER)), printf('| %s | %s | %d | %d | %d |', source, reason,
      fetched, dedup_dropped, filter_dropped) FROM silent
  UNION ALL SELECT 4, 0, 2, {O.q(RP.W_NO_SILENT)} WHERE (SELECT count(*) FROM silent) = 0
  UNION ALL {_lit_rows(4, _BIG, ['', '---', ''])}
  UNION ALL {_lit_rows(5, 0, [RP.W_ALERTS, ''])}
  UNION ALL SELECT 5, 0, 2 + t.k, t.line FROM (SELECT unnest([{', '.join(O.q(x) for x in RP.W_ALERTS_HEADER)}]) AS line,
      unnest(range(0, 2)) AS k) t WHERE (SELECT count(*) FROM alerts) > 0
  UNION ALL SELECT 5, 1, row_number() OVER (ORDER BY disabled DESC, failures DESC, source_id),
      printf('| %s | %d | %s | %s |', source_id, failures, coalesce(strftime(last_failure, '%Y-%m-%d %H:%M:%S'), '—'),
             CASE WHEN disabled THEN '{RP.ALERT_STATUS_TEXT[0][1]}' ELSE '{RP.ALERT_STATUS_TEXT[1][1]}' END) FROM alerts
  UNION ALL SELECT 5, 0, 2, {O.q(RP.W_NO_ALERTS)} WHERE (SELECT count(*) FROM alerts) = 0
  UNION ALL {_lit_rows(5, _BIG, ['', '---', '', RP.W_FOOTER.format(version=__version__)])})"""

reg("weekly_report", f"""{PIPE}, {_THEME_BOARD}, {PER_SOURCE}, {_SILENT}, {HEALTH}, {_ALERTS}, {_LINES}
  SELECT CAST(section AS BIGINT) AS section, CAST(part AS BIGINT) AS part, CAST(line_ord AS BIGINT) AS line_ord, line
  FROM lines""")


def _fixed(section: int, part: int, lines: list[str]) -> str:
    return _lit_rows(section, part, lines)


_MEMO = f"""mlines(section, part, line_ord, line) AS (
  {_fixed(0, 0, [RP.M_TITLE.format(title=_TITLE), '', RP.M_PERIOD.format(start=_START, end=f'{A.AS_OF:%Y-%m-%d}'),
                 RP.M_GENERATED.format(generated=f'{A.AS_OF:%Y-%m-%d %H:%M} UTC')])}
  UNION ALL {_fixed(0, 1, ['', '---', ''] + RP.M_SUMMARY + ['', '---', '', RP.M_FACTS, ''])}
  UNION ALL {_fixed(2, 0, ['', '---', '', RP.M_ANALYSIS, ''])}
  UNION ALL {_fixed(4, 0, ['---', '', RP.M_REFERENCES, ''])}
  UNION ALL {_fixed(6, 0, ['', '---', '', RP.M_FOOTER.format(version=__version__)])}
  UNION ALL SELECT 0, 0, 4, printf({O.q(RP.M_SOURCES)}, (SELECT count(DISTINCT source) FROM ranked), (SELECT count(*) FROM ranked))
  UNION ALL SELECT 1, rank, 0, printf('%d. **%s** (%s)', rank, coalesce(title, ''), coalesce(publish_date, '')) FROM ranked
  UNION ALL SELECT 1, rank, 1, '   - Source: ' || coalesce(source, '') FROM ranked
  UNION ALL SELECT 1, rank, 2, '   - ' || substr(coalesce(excerpt, ''), 1, 120) FROM ranked
  UNION ALL SELECT 1, rank, 3, printf('   - [Source](%s)', coalesce(url, '')) FROM ranked
  UNION ALL SELECT 3, i, 0, '### ' || theme FROM board
  UNION ALL SELECT 3, i, 1, '' FROM board
  UNION ALL SELECT 3, i, 2, printf({O.q(RP.W_THEME_SUMMARY)}, n, theme) FROM board
  UNION ALL SELECT 3, i, 3, '' FROM board
  UNION ALL SELECT 3, i, 4, {O.q(RP.M_EVIDENCE)} FROM board
  UNION ALL SELECT 3, b.i, 4 + r.p, printf('- [%s](%s)', substr(coalesce(r.title, ''), 1, 50), coalesce(r.url, ''))
      FROM board b JOIN refs r ON r.theme = b.theme AND r.p <= 5
  UNION ALL SELECT 3, b.i, 5 + least(5, b.n), '' FROM board b
  UNION ALL SELECT 3, 0, 0, {O.q(RP.M_NO_THEMES)} WHERE (SELECT count(*) FROM board) = 0
  UNION ALL SELECT 5, rank, 0, printf('%d. %s — %s', rank, coalesce(title, ''), coalesce(url, '')) FROM ranked)"""

reg("memo_report", f"""{PIPE}, {_THEME_BOARD}, {_MEMO}
  SELECT CAST(section AS BIGINT) AS section, CAST(part AS BIGINT) AS part, CAST(line_ord AS BIGINT) AS line_ord, line
  FROM mlines""")

reg("score_pre_dedup", f"""{PIPE}, ms AS (SELECT url_hash, count(DISTINCT source) AS n_sources FROM tagged GROUP BY url_hash)
  SELECT i.url_hash, i.source,
    round(w + least(CAST(0.1 AS DOUBLE) * len(sig), CAST(0.3 AS DOUBLE))
          + CASE WHEN ms.n_sources > 1 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
          + CASE WHEN date_diff('day', publish_date, {AS_OF_D}) <= 1 THEN CAST(0.3 AS DOUBLE)
                 WHEN date_diff('day', publish_date, {AS_OF_D}) <= 3 THEN CAST(0.15 AS DOUBLE)
                 ELSE CAST(0.0 AS DOUBLE) END, 3) AS score
  FROM (SELECT t.*, coalesce((SELECT weight FROM weights
                              WHERE instr({O.domain('t.url')}, pattern) > 0 OR lower(pattern) = lower(t.source)
                              ORDER BY ord LIMIT 1), CAST(1.0 AS DOUBLE)) AS w
        FROM tagged t WHERE disposition = 'passed') i JOIN ms ON ms.url_hash = i.url_hash""")

reg("top_board", f"""{PIPE} SELECT rank AS line_ord,
  printf('| %d | %s | %s | %s | %s | %s | [%s](%s) |', rank, {O.stars('score')}, coalesce(publish_date, ''),
         coalesce(source, ''), {O.clip('title', 60)}, coalesce(takeaway, ''), {O.q(RP.LINK_LABEL)}, coalesce(url, '')) AS line
  FROM ranked WHERE rank <= 5""")

reg("latest_run", f"""WITH {RAW}, {RAW_W}, {SEEN}, {TAGGED}, {HEALTH},
  m AS (SELECT '{A.TASK_KEY}' AS task_key, '{A.AS_OF:%Y%m%dT%H%M%S}' AS run_id, fetched, deduped, filtered_out, final,
               waterline_before, waterline_before + fetched - deduped AS waterline_after
        FROM (SELECT CAST(count(*) AS BIGINT) AS fetched, CAST(count(*) FILTER (WHERE dup IS NOT NULL) AS BIGINT) AS deduped,
                CAST(count(*) FILTER (WHERE disposition IN ('no_date','not_included','excluded','low_signal')) AS BIGINT) AS filtered_out,
                CAST(count(*) FILTER (WHERE disposition = 'passed') AS BIGINT) AS final FROM tagged) t,
             (SELECT CAST(count(DISTINCT url_hash) AS BIGINT) AS waterline_before FROM seen_live) s),
  js AS (SELECT '{A.TASK_KEY}' AS task_key,
    (SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) FROM log) AS runs,
    (SELECT strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') FROM log) AS last_run,
    CAST(count(*) AS BIGINT) AS sources, CAST(count(*) FILTER (WHERE consecutive_failures >= 5) AS BIGINT) AS disabled,
    CAST(count(*) FILTER (WHERE consecutive_failures >= 3) AS BIGINT) AS alerting FROM health)
  SELECT m.*, runs, last_run, sources, disabled, alerting FROM m LEFT JOIN js USING (task_key)""")
