"""Job specification: the keys of a job file as plain objects.

Sources, the time window, the seen-state TTL, the filter gate, the ranking
parameters and the report options.  Nothing here touches Spark.
"""

from __future__ import annotations

import copy
import datetime as dt

# The keys of a job file and their defaults.
SOURCE_KEYS = {"type": None, "url": None, "urls": None, "query": None, "weight": 1.0, "label": None}
FILTER_KEYS = {"require_publish_date": True, "include_patterns": [], "exclude_patterns": [], "min_detail_signals": 0}
RANKING_KEYS = {"source_weight_map": {}, "multi_source_bonus": 0.3, "detail_signal_bonus": 0.2}
REPORT_KEYS = {"kind": "weekly_intel"}
BUNDLE_KEYS = {"include_sources_md": True, "one_md_per_item": False}


class Keyed:
    """An object with the keys of a table of defaults; unknown keys are errors."""

    KEYS: dict = {}

    def __init__(self, **given):
        unknown = set(given) - set(self.KEYS)
        if unknown:
            raise TypeError(f"{type(self).__name__} has no {', '.join(sorted(unknown))}")
        for key, default in self.KEYS.items():
            setattr(self, key, given[key] if key in given else copy.copy(default))


class SourceSpec(Keyed):
    """One source; type is rss, arxiv, html_list, sitemap or manual_urls."""

    KEYS = SOURCE_KEYS

    @property
    def source_id(self) -> str:
        """Label used for health, stats and weights (first non-empty)."""
        return self.label or self.url or self.query or self.type


class FilterSpec(Keyed):
    KEYS = FILTER_KEYS


class RankingSpec(Keyed):
    """The weight map is ordered: its first matching pattern wins."""

    KEYS = RANKING_KEYS


class ReportSpec(Keyed):
    KEYS = REPORT_KEYS


class BundleSpec(Keyed):
    KEYS = BUNDLE_KEYS


class JobSpec(Keyed):
    KEYS = {"task_key": None, "time_window_days": 7, "dedup_ttl_days": 45, "sources": [], "filters": FilterSpec(),
            "ranking": RankingSpec(), "report": ReportSpec(), "bundle": BundleSpec()}

    def weight_entries(self) -> list[tuple[str, float]]:
        """Configured weights, then each source's own weight under its label
        when the label is not already a key (first match wins later)."""
        weights = dict(self.ranking.source_weight_map)
        for s in self.sources:
            if s.source_id:
                weights.setdefault(s.source_id, s.weight)
        return list(weights.items())


def as_of_date(as_of: dt.datetime | dt.date) -> dt.date:
    return as_of.date() if isinstance(as_of, dt.datetime) else as_of


def window_cutoff(as_of: dt.datetime | dt.date, days: int) -> dt.date:
    """Inclusive lower bound of the time window (date of as_of - days)."""
    if isinstance(as_of, dt.datetime):
        return (as_of - dt.timedelta(days=days)).date()
    return as_of - dt.timedelta(days=days)
