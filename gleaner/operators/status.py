"""Run records (A18, G2): job status from the fetch log, and the run
manifest as one row (scalars; nested form via ``to_json`` for the sink)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import __version__
from .health import ALERT_AT, source_health
from ..schema import FILTER_REASONS
from ..spec import JobSpec


def run_id(as_of: dt.datetime) -> str:
    """UTC ``yyyyMMdd'T'HHmmss``."""
    return as_of.strftime("%Y%m%dT%H%M%S")


def job_status(log: DataFrame) -> DataFrame:
    """Per task: runs (fetch days), latest run day, sources, disabled and
    alerting sources, items fetched — one aggregate over the health rows
    unioned with the log's fetch days (no join)."""
    h = source_health(log)
    per_source = h.select(
        "task_key", F.lit(None).cast("date").alias("day"), F.lit(1).alias("is_source"),
        F.col("disabled").cast("int").alias("is_disabled"),
        ((F.col("consecutive_failures") >= ALERT_AT) | F.col("disabled")).cast("int").alias("is_alerting"),
        F.col("total_items_fetched").alias("items"))
    days = log.select("task_key", F.to_date("ts").alias("day"), F.lit(0).alias("is_source"),
                      F.lit(0).alias("is_disabled"), F.lit(0).alias("is_alerting"),
                      F.lit(0).cast("long").alias("items"))
    return per_source.unionByName(days).groupBy("task_key").agg(
        F.countDistinct("day").cast("long").alias("runs"),
        F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_run"),
        F.sum("is_source").cast("long").alias("sources"),
        F.sum("is_disabled").cast("long").alias("disabled"),
        F.sum("is_alerting").cast("long").alias("alerting"),
        F.sum("items").cast("long").alias("items_fetched"))


def manifest_row(tagged: DataFrame, seen_live: DataFrame, spec: JobSpec, as_of: dt.datetime,
                 completed_at: dt.datetime | None = None) -> DataFrame:
    """One manifest row: run identity plus run totals, filter breakdown and waterline, from a
    single aggregate over tagged rows unioned with the live seen hashes."""
    d = F.col("disposition")
    t = tagged.select(F.lit(None).cast("string").alias("seen_hash"), F.lit(1).alias("is_item"),
                      F.col("dup").isNotNull().cast("int").alias("is_dup"),
                      d.isin(*FILTER_REASONS).cast("int").alias("is_filtered"),
                      (d == "passed").cast("int").alias("is_final"), *[(d == r).cast("int").alias(r) for r in FILTER_REASONS])
    s = seen_live.select(F.col("url_hash").alias("seen_hash"), F.lit(0).alias("is_item"), F.lit(0).alias("is_dup"),
                         F.lit(0).alias("is_filtered"), F.lit(0).alias("is_final"), *[F.lit(0).alias(r) for r in FILTER_REASONS])
    agg = t.unionByName(s).agg(
        F.sum("is_item").cast("long").alias("fetched"), F.sum("is_dup").cast("long").alias("deduped"),
        F.sum("is_filtered").cast("long").alias("filtered_out"), F.sum("is_final").cast("long").alias("final"),
        *[F.coalesce(F.sum(r), F.lit(0)).cast("long").alias(r) for r in FILTER_REASONS],
        F.countDistinct("seen_hash").cast("long").alias("waterline_before"))
    return _manifest(agg, spec, as_of, completed_at)


def observed_manifest(totals: dict[str, int], seen_live: DataFrame, spec: JobSpec, as_of: dt.datetime,
                      completed_at: dt.datetime | None = None) -> DataFrame:
    """``manifest_row`` from the counters that were observed while the tagged
    rows were written: no second pass over them."""
    before = seen_live.agg(F.countDistinct("url_hash").cast("long").alias("waterline_before"))
    known = [F.lit(totals.get(c) or 0).cast("long").alias(c) for c in ("fetched", "deduped", "filtered_out", "final", *FILTER_REASONS)]
    return _manifest(before.select(*known, "waterline_before"), spec, as_of, completed_at)


def _manifest(agg: DataFrame, spec: JobSpec, as_of: dt.datetime, completed_at: dt.datetime | None) -> DataFrame:
    return agg.select(
        F.lit(spec.task_key).alias("task_key"), F.lit(run_id(as_of)).alias("run_id"),
        F.lit(as_of.strftime("%Y-%m-%dT%H:%M:%S+00:00")).alias("started_at"),
        F.lit(spec.time_window_days).cast("long").alias("window_days"),
        F.lit(spec.dedup_ttl_days).cast("long").alias("dedup_ttl_days"),
        "fetched", "deduped", "filtered_out", "final", "waterline_before",
        (F.col("waterline_before") + F.col("fetched") - F.col("deduped")).alias("waterline_after"),
        F.lit(len(spec.sources)).cast("long").alias("configured_sources"),
        F.lit(__version__).alias("version"), *FILTER_REASONS,
        F.lit((completed_at or as_of).strftime("%Y-%m-%dT%H:%M:%S+00:00")).alias("completed_at"))


def manifest_document(manifest: DataFrame, per_source: DataFrame, sources: DataFrame) -> DataFrame:
    """The manifest with its configured sources and per-source statistics
    (arrays of one struct per source, bounded by the job's sources)."""
    conf = sources.select("source_ord", *[c for c in sources.columns if c != "source_ord"])
    rows = (manifest.select(F.struct("*").alias("m"))
            .unionByName(per_source.select(F.struct("*").alias("p")), allowMissingColumns=True)
            .unionByName(conf.select(F.struct("*").alias("s")), allowMissingColumns=True))
    one = rows.agg(F.first("m", ignorenulls=True).alias("m"), F.sort_array(F.collect_list("p")).alias("per_source"),
                   F.sort_array(F.collect_list("s")).alias("sources"))
    return one.select("m.*", "per_source", "sources")


def latest_runs(manifests: DataFrame) -> DataFrame:
    """Newest manifest per task (``row_number() <= 1`` per task, a
    WindowGroupLimit: one row per task leaves each map task)."""
    from pyspark.sql import Window
    w = Window.partitionBy("task_key").orderBy(F.col("run_id").desc())
    return manifests.withColumn("_k", F.row_number().over(w)).where(F.col("_k") == 1).drop("_k")


def run_status(manifests: DataFrame, log: DataFrame) -> DataFrame:
    """Latest run of each task with its totals, waterline and source health
    summary (the status command of a job)."""
    return latest_runs(manifests).join(job_status(log), "task_key", "left")
