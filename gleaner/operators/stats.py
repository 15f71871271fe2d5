"""Run statistics.

All counters are ``count_if`` over the tagged rows in one partial
aggregate; totals and per-source rows come from one ``rollup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FILTER_REASONS


def _n(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def counters() -> list[Column]:
    """The counters of tagged rows; also the metrics a run observes while it
    writes them."""
    d = F.col("disposition")
    return [
        F.count(F.lit(1)).cast("long").alias("fetched"),
        _n(F.col("dup").isNotNull()).alias("deduped"),
        _n(d.isin(*FILTER_REASONS)).alias("filtered_out"),
        _n(d == "passed").alias("final"),
    ] + [_n(d == r).alias(r) for r in FILTER_REASONS]


def run_stats_rollup(tagged: DataFrame) -> DataFrame:
    """One row per source plus a total row (``source`` NULL, level 'total')."""
    return (tagged.rollup("source").agg(*counters(), F.grouping_id().alias("_g"))
            .withColumn("level", F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.lit("source")))
            .drop("_g"))


def per_source(tagged: DataFrame, sources: DataFrame) -> DataFrame:
    """Per-source funnel over configured and observed labels (missing -> 0);
    ``source_ord`` is the configured position, NULL if not configured."""
    d = F.col("disposition")
    obs = tagged.groupBy("source").agg(
        F.count(F.lit(1)).cast("long").alias("fetched"),
        _n(F.col("dup").isNull()).alias("dedup_kept"),
        *[_n(d == r).alias(r) for r in FILTER_REASONS],
        _n(d == "passed").alias("final"))
    conf = sources.groupBy(F.col("label").alias("source")).agg(F.min("source_ord").alias("source_ord"))
    j = obs.join(conf, "source", "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return j.select(
        "source",
        z("fetched").alias("fetched"),
        z("dedup_kept").alias("dedup_kept"),
        F.greatest(F.lit(0).cast("long"), z("fetched") - z("dedup_kept")).alias("dedup_dropped"),
        z("dedup_kept").alias("filter_input"),
        F.greatest(F.lit(0).cast("long"), z("dedup_kept") - z("final")).alias("filter_dropped"),
        *[z(r).alias(r) for r in FILTER_REASONS],
        z("final").alias("final"), "source_ord")


def silent_sources(per_src: DataFrame) -> DataFrame:
    """Configured sources with no survivor, with the reason and the
    configured position."""
    f, dd, fd = F.col("fetched"), F.col("dedup_dropped"), F.col("filter_dropped")
    reason = (F.when(f == 0, F.lit("empty/failed"))
              .when((dd >= f) & (fd == 0), F.lit("all deduped"))
              .when(fd > 0, F.lit("all filtered"))
              .otherwise(F.lit("none selected")))
    return (per_src.where((F.col("final") == 0) & F.col("source_ord").isNotNull())
            .select("source", reason.alias("reason"), "fetched", "dedup_dropped", "filter_dropped", "source_ord"))


def active_sources(items: DataFrame) -> DataFrame:
    return items.agg(F.countDistinct("source").cast("long").alias("active_sources"),
                     F.count(F.lit(1)).cast("long").alias("item_count"))


def waterline(seen_live: DataFrame, tagged: DataFrame) -> DataFrame:
    """Distinct live hashes before the run, and after adding the new ones
    (one aggregate over the union; no join)."""
    both = (seen_live.select("url_hash", F.lit(0).alias("is_new"))
            .unionByName(tagged.select(F.lit(None).cast("string").alias("url_hash"),
                                       F.col("dup").isNull().cast("int").alias("is_new"))))
    agg = both.agg(F.countDistinct("url_hash").cast("long").alias("before"),
                   F.sum("is_new").cast("long").alias("new_hashes"))
    return agg.select("before", "new_hashes", (F.col("before") + F.col("new_hashes")).alias("after"))
