"""A whole curation run (I1): scan -> dedup -> gate -> score -> stats ->
report -> sinks -> state.

The tagged DataFrame is written once (a table in the shared folder) because
items, statistics, state and health all read it; the manifest's totals are
observed in that write; the seen-state append happens last, so a crash re-admits items but never
loses them.  ``use_state=False`` runs without seen state and writes none
(health is still logged).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import astuple, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import __version__, sinks
from ..operators import health, rank, report, stats, status, themes
from ..operators.order import with_global_rank
from ..schema import FETCH_LOG
from ..session import checkpoint_dir, shared_table
from ..sources.registry import Fault, scan_all
from ..sources.state import load_seen
from ..spec import JobSpec, SourceSpec
from ..streaming.scratch import path_exists
from .pipeline import survivors, tag

REPORT_THEMES = 6     # themes shown in a report
FAULTS = "source_id string, source_ord int, error string"


@dataclass
class RunResult:
    tagged: DataFrame
    ranked: DataFrame
    run_stats: DataFrame
    per_source: DataFrame
    silent: DataFrame
    manifest: DataFrame
    faults: list[Fault] = field(default_factory=list)


def disabled_sources(spark: SparkSession, spec: JobSpec, log_path: str) -> set[str]:
    """Labels of the job's sources that their fetch log disables (at most
    one a configured source)."""
    if not path_exists(spark, log_path):
        return set()
    log = spark.read.schema(FETCH_LOG).parquet(log_path).where(F.col("task_key") == spec.task_key)
    off = health.source_health(log).where(F.col("disabled") & F.col("source_id").isin([s.source_id for s in spec.sources]))
    return {r["source_id"] for r in off.select("source_id").collect()}


def run_job(spark: SparkSession, spec: JobSpec, landed: Callable[[SourceSpec], str], *, as_of: dt.datetime, out_dir: str,
            seen_path: str, log_path: str, use_state: bool = True, raw: DataFrame | None = None,
            lexicon: list[tuple[str, list[str]]] = themes.DEFAULT_THEMES) -> RunResult:
    """Run the job: ``landed`` names the folder that a source's fetched data
    lies in.  Disabled sources are neither scanned nor logged.  ``raw`` replaces
    the scan by ready rows.  Sources that failed are told in the result's
    ``faults`` and in the table ``faults`` of the run's output: their missing
    rows are not a quiet source's."""
    checkpoint_dir(spark)
    off = disabled_sources(spark, spec, log_path)
    sources = source_table(spark, spec)
    faults: list[Fault] = []
    if raw is None:
        raw = scan_all(spark, spec.sources, as_of, spec.time_window_days, landed, off, faults=faults)
    seen = load_seen(spark, seen_path, spec.task_key, spec.dedup_ttl_days, as_of) if use_state else None
    totals = Observation("run-totals")
    tagged = shared_table(tag(raw, seen, spec).observe(totals, *stats.counters()), "tagged")
    ranked = with_global_rank(survivors(tagged, spec, as_of), rank.order_cols(), "rank")

    # fetch outcomes first (health is recorded while fetching), of scanned sources only
    counts = tagged.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    scanned = sources.where(~F.col("label").isin(list(off))) if off else sources
    sinks.append_fetch_log(health.fetch_outcomes(counts, scanned, spec.task_key, as_of), log_path)

    run_stats = stats.run_stats_rollup(tagged)
    per_source = stats.per_source(tagged, sources)
    silent = stats.silent_sources(per_source)
    seen_live = seen if seen is not None else spark.createDataFrame([], "url_hash string")
    manifest = status.observed_manifest(totals.get, seen_live, spec, as_of)
    log = spark.read.schema(FETCH_LOG).parquet(log_path).where(F.col("task_key") == spec.task_key)
    alerts = health.health_alerts(health.source_health(log))
    board = themes.board(ranked, lexicon, max_themes=REPORT_THEMES)

    sinks.write_items(ranked, f"{out_dir}/items")
    lines = report.report_of(spec.report.kind, ranked, board, silent, alerts, title=report.display_title(spec.task_key),
                             as_of=as_of, window_days=spec.time_window_days, configured=len(spec.sources), version=__version__)
    sinks.write_lines(lines, f"{out_dir}/report", ["section", "part", "line_ord"])
    if spec.bundle.include_sources_md:
        sinks.write_lines(report.source_lines(ranked), f"{out_dir}/sources", ["rank", "line_ord"])
    if spec.bundle.one_md_per_item:
        report.item_docs(ranked).write.mode("overwrite").parquet(f"{out_dir}/item_docs")
    board.write.mode("overwrite").parquet(f"{out_dir}/themes")
    per_source.write.mode("overwrite").parquet(f"{out_dir}/per_source")
    spark.createDataFrame([astuple(f) for f in faults], FAULTS).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/faults")
    sinks.write_manifest(status.manifest_document(manifest, per_source, sources), f"{out_dir}/manifest")
    if use_state:
        sinks.append_seen(tagged, seen_path, spec.task_key, as_of)
    return RunResult(tagged, ranked, run_stats, per_source, silent, manifest, faults)


def source_table(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """Configured sources as a small dimension table (size = job config)."""
    rows = [(i, s.type, s.source_id, s.url, s.query, float(s.weight)) for i, s in enumerate(spec.sources)]
    return spark.createDataFrame(rows, "source_ord int, type string, label string, url string, query string, weight double")
