"""Filters and the ordered filter gate.

Nothing is dropped: each row gets the first failing reason in the order
date gate -> include -> exclude -> minimum signals, or 'passed'.  Long
pattern lists read every text once (``patterns``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import cached, col, nz
from ..functions.text import detect_signals, make_excerpt, takeaway
from ..spec import FilterSpec, window_cutoff
from .patterns import matches_any


@cached
def in_window(publish_date: Column | str, as_of: dt.datetime | dt.date, days: int) -> Column:
    """Undated rows pass; dated rows need date >= as_of - days (inclusive)."""
    d = col(publish_date)
    return d.isNull() | (d >= F.lit(window_cutoff(as_of, days)))


def gate_text(title: Column | str, excerpt: Column | str) -> Column:
    """Lower-cased ``title + ' ' + excerpt`` the include/exclude lists read."""
    return F.lower(F.concat(nz(title), F.lit(" "), nz(excerpt)))


def reason(spec: FilterSpec, signals_col: str = "signals") -> Column:
    """First failing filter reason, or 'passed'; needs ``_gate``, the text
    that the lists read."""
    return _reason(spec.require_publish_date, tuple(spec.include_patterns),
                   tuple(spec.exclude_patterns), spec.min_detail_signals, signals_col)


@cached
def _reason(require_date: bool, include: tuple, exclude: tuple, min_signals: int, signals_col: str) -> Column:
    text = F.col("_gate")
    c = F.when(F.lit(False), F.lit(None))
    if require_date:
        c = c.when(F.col("publish_date").isNull(), F.lit("no_date"))
    if include:
        c = c.when(~matches_any(text, list(include)), F.lit("not_included"))
    if exclude:
        c = c.when(matches_any(text, list(exclude)), F.lit("excluded"))
    if min_signals > 0:
        c = c.when(F.size(signals_col) < min_signals, F.lit("low_signal"))
    return c.otherwise(F.lit("passed"))


@cached
def item_signals(title: str, excerpt: str) -> Column:
    """Signals of the raw ``title + ' ' + excerpt``."""
    return detect_signals(F.concat(nz(title), F.lit(" "), nz(excerpt)))


def tag_reason(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Add ``signals`` (raw title + excerpt) and ``disposition``: the dup tag
    when present, else the filter reason.  Survivors get ``excerpt_120`` and
    ``takeaway``; others keep NULL there (computed only under 'passed')."""
    out = df.withColumn("signals", item_signals("title", "excerpt")).withColumn("_gate", gate_text("title", "excerpt"))
    r = reason(spec, "signals")
    disp = F.coalesce(F.col("dup"), r) if "dup" in df.columns else r
    out = out.withColumn("disposition", disp).drop("_gate")
    passed = F.col("disposition") == "passed"
    return (out.withColumn("excerpt_120", F.when(passed, make_excerpt("excerpt", 120)))
               .withColumn("takeaway", F.when(passed, takeaway("title", "excerpt", 60))))
