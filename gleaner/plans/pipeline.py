"""The composite curation run (I1): scan -> dedup -> gate -> score.

Tag, don't drop: every raw row keeps one ``disposition`` so the survivors,
the run statistics, the new seen state and the silent-source board are all
projections or aggregates of one tagged DataFrame.  Shuffles: one on
``url_hash`` (dedup), one range sort for ranking; aggregates are partial.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.url import url_hash
from ..operators.dedup import tag_duplicates
from ..operators.gate import in_window, tag_reason
from ..operators.rank import multi_source_counts, score
from ..spec import JobSpec

ITEM_COLUMNS = ["url", "title", "source", "publish_date", "excerpt", "takeaway", "signals",
                "score", "url_hash", "source_ord", "item_ord"]


@dataclass
class Curated:
    tagged: DataFrame      # every raw row with url_hash, dup, signals, disposition
    items: DataFrame       # survivors, scored (unordered; order with rank.ORDER)


def windowed(raw: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Scan-time time window (undated rows pass)."""
    return raw.where(in_window("publish_date", as_of, days))


def tag(raw: DataFrame, seen: DataFrame | None, spec: JobSpec) -> DataFrame:
    with_hash = raw.withColumn("url_hash", url_hash("url"))
    return tag_reason(tag_duplicates(with_hash, seen), spec.filters)


def survivors(tagged: DataFrame, spec: JobSpec, as_of: dt.datetime,
              multi_stage: str = "post_dedup") -> DataFrame:
    """Passed rows, scored.  The multi-source bonus counts rows per hash
    among survivors (``post_dedup``, as the reference does: always one, so
    it never fires) or distinct sources per hash before dedup
    (``pre_dedup``: one partial aggregate joined back)."""
    passed = tagged.where(F.col("disposition") == "passed")
    multi = None
    if multi_stage == "pre_dedup":
        passed = passed.join(multi_source_counts(tagged, "pre_dedup"), "url_hash", "left")
        multi = F.col("n_sources") > 1
    scored = score(passed, spec.ranking, spec.weight_entries(), as_of, multi)
    return scored.select(
        "url", "title", "source",
        F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
        F.col("excerpt_120").alias("excerpt"), "takeaway", "signals", "score", "url_hash",
        "source_ord", "item_ord")


def curate(raw: DataFrame, seen: DataFrame | None, spec: JobSpec, as_of: dt.datetime) -> Curated:
    tagged = tag(raw, seen, spec)
    return Curated(tagged=tagged, items=survivors(tagged, spec, as_of))
