"""Report tables (G3-G6, B19-B21): each report section is a DataFrame of
ordered lines built with Column string functions, not a template engine.
Item-level sections carry the item's rank, so they stay distributed; only
bounded sections (top 5, themes, alerts) are ordered with a limit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import nz
from ..functions.text import clip, doc_name, stars

# Literal text of the report layout.
LINK_LABEL = "链接"
TIMELINE_HEADER = ["## 全量时间线", "",
                   "| # | 日期 | 来源 | 标题 | 摘要 | 链接 |",
                   "|---|------|------|------|------|------|"]
TOP_HEADER = ["| # | 重要度 | 日期 | 来源 | 标题 | Takeaway | 链接 |",
              "|---|--------|------|------|------|----------|------|"]


def top_lines(top: DataFrame) -> DataFrame:
    """Top board rows: ``| n | stars | date | source | title[:60] | takeaway | [link](url) |``."""
    line = F.format_string("| %d | %s | %s | %s | %s | %s | [%s](%s) |", F.col("rank"), stars("score"),
                           nz("publish_date"), nz("source"), clip("title", 60), nz("takeaway"),
                           F.lit(LINK_LABEL), nz("url"))
    return top.select(F.col("rank").alias("line_ord"), line.alias("line"))


def timeline_lines(ranked: DataFrame) -> DataFrame:
    """One line per ranked item: ``| n | date | source | title[:55] | excerpt | [link](url) |``."""
    line = F.format_string("| %d | %s | %s | %s | %s | [%s](%s) |", F.col("rank"), nz("publish_date"),
                           nz("source"), clip("title", 55), nz("excerpt"), F.lit(LINK_LABEL), nz("url"))
    return ranked.select(F.col("rank").alias("line_ord"), line.alias("line"))


def source_lines(ranked: DataFrame) -> DataFrame:
    """sources.md: a heading (rank 0); per item a link line, a date/source line, an
    excerpt[:80] line when there is an excerpt, and a blank line."""
    ex = F.substring(nz("excerpt"), 1, 80)
    lines = F.array(
        F.struct(F.lit(1).alias("k"), F.format_string("%d. [%s](%s)", F.col("rank"), nz("title"), nz("url")).alias("line")),
        F.struct(F.lit(2).alias("k"), F.format_string("   - Date: %s | Source: %s", nz("publish_date"), nz("source")).alias("line")),
        F.struct(F.lit(3).alias("k"), F.when(ex != "", F.concat(F.lit("   - "), ex)).alias("line")),
        F.struct(F.lit(4).alias("k"), F.lit("").alias("line")))
    body = (ranked.select("rank", F.explode(lines).alias("l"))
            .where(F.col("l.line").isNotNull())
            .select("rank", F.col("l.k").cast("long").alias("line_ord"), F.col("l.line").alias("line")))
    heading = ranked.sparkSession.createDataFrame([(0, 1, "# Sources"), (0, 2, "")], "rank long, line_ord long, line string")
    return heading.unionByName(body)


def item_docs(ranked: DataFrame) -> DataFrame:
    """One Markdown document per item: (doc_name, body)."""
    sig = F.when(F.size("signals") > 0, F.array_join("signals", ", ")).otherwise(F.lit("none"))
    body = F.format_string("# %s\n\n- URL: %s\n- Date: %s\n- Source: %s\n- Score: %s\n- Signals: %s\n\n%s\n",
                           nz("title"), nz("url"), nz("publish_date"), nz("source"),
                           F.col("score").cast("string"), sig, nz("excerpt"))
    return ranked.select("rank", doc_name("rank", "title").alias("doc_name"), body.alias("body"))


def display_title(task_key: str) -> str:
    """Task key to a display title: underscores to spaces, title case."""
    return task_key.replace("_", " ").title()


# ---------------------------------------------------------------------------
# Literal text of the weekly and memo report layouts
# ---------------------------------------------------------------------------
W_PERIOD = "> **周期**: {start} — {end}"
W_GENERATED = "> **生成时间**: {generated}"
W_SOURCES = "> **信息源**: 配置 %d 个 / 入选 %d 个 | **收录条目**: %d 条"
W_TOP = "## Top %d 看板"
W_THEMES = "## 主题结论（%d 个主题）"
W_THEME_HEAD = "### %d. %s"
W_THEME_SUMMARY = "本周期共 %d 条与「%s」相关的更新。"
W_THEME_REFS = "相关条目："
W_THEME_REF = "- [%s](%s)（%s）"
W_NO_THEMES = "_本周期内未检测到明显主题聚类。_"
W_SILENT = "## 本周无更新源清单"
W_SILENT_INTRO = "以下已配置信息源在本周期内无新增入选条目："
W_SILENT_HEADER = ["| 信息源 | 原因 | 抓取 | 去重淘汰 | 过滤淘汰 |", "|--------|------|------|----------|----------|"]
W_NO_SILENT = "_所有已配置信息源均产出了条目。_"
W_ALERTS = "## 信息源健康告警"
W_ALERTS_HEADER = ["| 信息源 | 连续失败 | 最近失败时间 | 状态 |", "|--------|----------|--------------|------|"]
W_NO_ALERTS = "_本周期无连续失败告警。_"
W_FOOTER = "_由 gleaner v{version} 自动生成_"
SILENT_REASON_TEXT = [("empty/failed", "抓取为空/失败"), ("all deduped", "全部被去重"),
                      ("all filtered", "全部被过滤"), ("none selected", "无新增入选")]
ALERT_STATUS_TEXT = [(True, "已禁用"), (False, "告警")]
# ---------------------------------------------------------------------------

LINES_SCHEMA = "section long, part long, line_ord long, line string"


def _rows(df: DataFrame, section: int, part: Column, line_ord: Column, line: Column) -> DataFrame:
    return df.select(F.lit(section).cast("long").alias("section"), part.cast("long").alias("part"),
                     line_ord.cast("long").alias("line_ord"), line.alias("line"))


def _theme_lines(board: DataFrame, section: int) -> DataFrame:
    """Per theme (at most six): heading, summary, and its reference lines."""
    idx = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("first_rank")))   # <= 6 rows
    b = board.withColumn("i", idx)
    heads = b.select("i", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.format_string(W_THEME_HEAD, F.col("i"), F.col("theme")).alias("line")),
        F.struct(F.lit(1).alias("k"), F.lit("").alias("line")),
        F.struct(F.lit(2).alias("k"), F.format_string(W_THEME_SUMMARY, F.col("n"), F.col("theme")).alias("line")),
        F.struct(F.lit(3).alias("k"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("k"), F.lit(W_THEME_REFS).alias("line")))).alias("l"))
    refs = b.select("i", F.posexplode("refs").alias("p", "r")).select(
        "i", (F.col("p") + 5).alias("k"),
        F.format_string(W_THEME_REF, clip(F.col("r.title"), 50), nz(F.col("r.url")), nz(F.col("r.publish_date")))
        .alias("line"))
    tail = b.select("i", (F.size("refs") + 5).alias("k"), F.lit("").alias("line"))
    out = heads.select("i", F.col("l.k").alias("k"), F.col("l.line").alias("line")).unionByName(refs).unionByName(tail)
    return _rows(out, section, F.col("i"), F.col("k"), F.col("line"))


def weekly_report(ranked: DataFrame, board: DataFrame, silent: DataFrame, alerts: DataFrame, *,
                  title: str, as_of: dt.datetime, window_days: int, configured: int,
                  version: str) -> DataFrame:
    """The weekly report as ordered lines (section, part, line_ord, line).

    Item-level sections (timeline) stay distributed; the bounded ones (top
    five, at most six themes, configured sources, alerting sources) are
    small.  Order lines by (section, part, line_ord)."""
    spark = ranked.sparkSession
    fixed: list[tuple] = []

    def static(section: int, lines: list[str], part: int = 0, start: int = 0) -> None:
        fixed.extend((section, part, start + i, t) for i, t in enumerate(lines))

    start = (as_of - dt.timedelta(days=window_days)).strftime("%Y-%m-%d")
    totals = ranked.agg(F.countDistinct("source").alias("active"), F.count(F.lit(1)).alias("items"))
    static(0, [f"# {title}", "", W_PERIOD.format(start=start, end=f"{as_of:%Y-%m-%d}"),
               W_GENERATED.format(generated=f"{as_of:%Y-%m-%d %H:%M} UTC")])
    header = _rows(totals, 0, F.lit(0), F.lit(4),
                   F.format_string(W_SOURCES, F.lit(configured), F.col("active"), F.col("items")))
    static(0, ["", "---", ""], start=5)

    top_title = _rows(totals, 1, F.lit(0), F.lit(0), F.format_string(W_TOP, F.least(F.lit(5), F.col("items"))))
    static(1, [""] + TOP_HEADER, start=1)
    static(1, ["", "---", ""], part=1 << 40)
    top = top_title.unionByName(
        _rows(top_lines(ranked.where(F.col("rank") <= 5)), 1, F.col("line_ord"), F.lit(0), F.col("line")))

    static(2, TIMELINE_HEADER)
    static(2, ["", "---", ""], part=1 << 40)
    timeline = _rows(timeline_lines(ranked), 2, F.col("line_ord"), F.lit(0), F.col("line"))

    k = board.agg(F.count(F.lit(1)).alias("k"))
    static(3, [""], start=1)
    static(3, ["", "---", ""], part=1 << 40)
    themes = (_rows(k, 3, F.lit(0), F.lit(0), F.format_string(W_THEMES, F.col("k")))
              .unionByName(_theme_lines(board, 3))
              .unionByName(_rows(k.where(F.col("k") == 0), 3, F.lit(1 << 39), F.lit(0), F.lit(W_NO_THEMES))))

    reason = F.coalesce(*[F.when(F.col("reason") == en, F.lit(zh)) for en, zh in SILENT_REASON_TEXT],
                        F.col("reason"))
    n_silent = silent.agg(F.count(F.lit(1)).alias("n"))
    # one row per configured source / alerting source: small tables, ordered by a plain window
    silent_rows = silent.withColumn("_o", F.row_number().over(Window.orderBy("source_ord"))).select(
        F.format_string("| %s | %s | %d | %d | %d |", F.col("source"), reason, F.col("fetched"),
                        F.col("dedup_dropped"), F.col("filter_dropped")).alias("line"), "_o")
    static(4, [W_SILENT, ""])
    static(4, ["", "---", ""], part=1 << 40)
    silent_head = n_silent.where(F.col("n") > 0).select(F.explode(F.array(
        *[F.struct(F.lit(i + 2).alias("k"), F.lit(t).alias("t"))
          for i, t in enumerate([W_SILENT_INTRO, ""] + W_SILENT_HEADER)])).alias("x"))
    silent_part = (_rows(silent_head, 4, F.lit(0), F.col("x.k"), F.col("x.t"))
                   .unionByName(_rows(silent_rows, 4, F.lit(1), F.col("_o"), F.col("line")))
                   .unionByName(_rows(n_silent.where(F.col("n") == 0), 4, F.lit(0), F.lit(2), F.lit(W_NO_SILENT))))

    n_alerts = alerts.agg(F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("disabled"), F.lit(ALERT_STATUS_TEXT[0][1])).otherwise(F.lit(ALERT_STATUS_TEXT[1][1]))
    ordered = alerts.withColumn("_o", F.row_number().over(
        Window.orderBy(F.col("disabled").desc(), F.col("failures").desc(), F.col("source_id"))))
    last = F.coalesce(F.date_format("last_failure", "yyyy-MM-dd HH:mm:ss"), F.lit("—"))
    alert_rows = ordered.select(F.format_string("| %s | %d | %s | %s |", F.col("source_id"), F.col("failures"),
                                                last, status).alias("line"), "_o")
    static(5, [W_ALERTS, ""])
    static(5, ["", "---", "", W_FOOTER.format(version=version)], part=1 << 40)
    alert_head = n_alerts.where(F.col("n") > 0).select(F.explode(F.array(
        *[F.struct(F.lit(i + 2).alias("k"), F.lit(t).alias("t")) for i, t in enumerate(W_ALERTS_HEADER)])).alias("x"))
    alert_part = (_rows(alert_head, 5, F.lit(0), F.col("x.k"), F.col("x.t"))
                  .unionByName(_rows(alert_rows, 5, F.lit(1), F.col("_o"), F.col("line")))
                  .unionByName(_rows(n_alerts.where(F.col("n") == 0), 5, F.lit(0), F.lit(2), F.lit(W_NO_ALERTS))))
    layout = spark.createDataFrame(fixed, LINES_SCHEMA)
    return (layout.unionByName(header).unionByName(top).unionByName(timeline).unionByName(themes)
            .unionByName(silent_part).unionByName(alert_part))


# Literal text of the memo layout (investment memo / dossier).
M_TITLE = "# Investment Memo: {title}"
M_PERIOD = "> **Period**: {start} — {end}"
M_GENERATED = "> **Generated**: {generated}"
M_SOURCES = "> **Sources**: %d | **Items**: %d"
M_SUMMARY = ["## Executive Summary", "", "_To be filled based on analysis of collected items._"]
M_FACTS = "## Facts (Verifiable Updates)"
M_ANALYSIS = "## Analysis"
M_EVIDENCE = "Evidence:"
M_NO_THEMES = "_Analysis pending — review facts above and form thematic conclusions._"
M_REFERENCES = "## Source References"
M_FOOTER = "_Generated by gleaner v{version}_"


def memo_report(ranked: DataFrame, board: DataFrame, *, title: str, as_of: dt.datetime,
                window_days: int, version: str) -> DataFrame:
    """Memo report lines (section, part, line_ord, line): facts per item,
    analysis per theme, numbered references."""
    spark = ranked.sparkSession
    start = (as_of - dt.timedelta(days=window_days)).strftime("%Y-%m-%d")
    fixed = [(0, 0, i, t) for i, t in enumerate([
        M_TITLE.format(title=title), "", M_PERIOD.format(start=start, end=f"{as_of:%Y-%m-%d}"),
        M_GENERATED.format(generated=f"{as_of:%Y-%m-%d %H:%M} UTC")])]
    fixed += [(0, 1, i, t) for i, t in enumerate(["", "---", ""] + M_SUMMARY + ["", "---", "", M_FACTS, ""])]
    fixed += [(2, 0, i, t) for i, t in enumerate(["", "---", "", M_ANALYSIS, ""])]
    fixed += [(4, 0, i, t) for i, t in enumerate(["---", "", M_REFERENCES, ""])]
    fixed += [(6, 0, i, t) for i, t in enumerate(["", "---", "", M_FOOTER.format(version=version)])]
    layout = spark.createDataFrame(fixed, LINES_SCHEMA)

    totals = ranked.agg(F.countDistinct("source").alias("active"), F.count(F.lit(1)).alias("items"))
    head = _rows(totals, 0, F.lit(0), F.lit(4), F.format_string(M_SOURCES, F.col("active"), F.col("items")))
    facts = ranked.select("rank", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.format_string("%d. **%s** (%s)", F.col("rank"), nz("title"),
                                                      nz("publish_date")).alias("line")),
        F.struct(F.lit(1).alias("k"), F.concat(F.lit("   - Source: "), nz("source")).alias("line")),
        F.struct(F.lit(2).alias("k"), F.concat(F.lit("   - "), F.substring(nz("excerpt"), 1, 120)).alias("line")),
        F.struct(F.lit(3).alias("k"), F.format_string("   - [Source](%s)", nz("url")).alias("line")))).alias("l"))
    facts = _rows(facts, 1, F.col("rank"), F.col("l.k"), F.col("l.line"))

    idx = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("first_rank")))   # <= 6 rows
    b = board.withColumn("i", idx)
    theme_heads = b.select("i", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.concat(F.lit("### "), F.col("theme")).alias("line")),
        F.struct(F.lit(1).alias("k"), F.lit("").alias("line")),
        F.struct(F.lit(2).alias("k"), F.format_string(W_THEME_SUMMARY, F.col("n"), F.col("theme")).alias("line")),
        F.struct(F.lit(3).alias("k"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("k"), F.lit(M_EVIDENCE).alias("line")))).alias("l"))
    theme_refs = b.select("i", F.posexplode("refs").alias("p", "r")).select(
        "i", (F.col("p") + 5).alias("k"),
        F.format_string("- [%s](%s)", F.substring(nz(F.col("r.title")), 1, 50), nz(F.col("r.url"))).alias("line"))
    theme_tail = b.select("i", (F.size("refs") + 5).alias("k"), F.lit("").alias("line"))
    analysis = (_rows(theme_heads, 3, F.col("i"), F.col("l.k"), F.col("l.line"))
                .unionByName(_rows(theme_refs.unionByName(theme_tail), 3, F.col("i"), F.col("k"), F.col("line")))
                .unionByName(_rows(b.agg(F.count(F.lit(1)).alias("k")).where(F.col("k") == 0), 3, F.lit(0),
                                   F.lit(0), F.lit(M_NO_THEMES))))
    refs = _rows(ranked, 5, F.col("rank"), F.lit(0),
                 F.format_string("%d. %s — %s", F.col("rank"), nz("title"), nz("url")))
    return layout.unionByName(head).unionByName(facts).unionByName(analysis).unionByName(refs)


# Report kinds and the layouts they use.
KINDS = {"weekly_intel": "weekly", "investment_memo": "memo", "company_dossier": "memo"}


def report_of(kind: str, ranked: DataFrame, board: DataFrame, silent: DataFrame, alerts: DataFrame, *, title: str,
              as_of: dt.datetime, window_days: int, configured: int, version: str) -> DataFrame:
    """The report of a kind (an unknown one is a weekly report)."""
    if KINDS.get(kind, "weekly") == "memo":
        return memo_report(ranked, board, title=title, as_of=as_of, window_days=window_days, version=version)
    return weekly_report(ranked, board, silent, alerts, title=title, as_of=as_of, window_days=window_days,
                         configured=configured, version=version)
