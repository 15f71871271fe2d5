"""Sinks (G1, G7, G8, G2): every output is a distributed write; nothing is
gathered on the driver.  Ranked items keep their ``rank`` column so order
survives the unordered file layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sources.state import new_hashes


def write_items(ranked: DataFrame, path: str, fmt: str = "json") -> None:
    """Survivors with their rank (JSON lines by default, or parquet)."""
    cols = ["rank", "url", "title", "source", "publish_date", "excerpt", "takeaway", "signals", "score", "url_hash"]
    ranked.select(*cols).write.mode("overwrite").format(fmt).save(path)


def write_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """A report as text: lines range-sorted by their order columns."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def append_seen(tagged: DataFrame, path: str, task_key: str, as_of: dt.datetime) -> None:
    """Append every first-seen hash of the run (filtered items included)."""
    (new_hashes(tagged, task_key, as_of).withColumn("seen_day", F.to_date("first_seen_ts"))
     .write.mode("append").partitionBy("task_key", "seen_day").parquet(path))


def append_fetch_log(outcomes: DataFrame, path: str) -> None:
    """Append one fetch outcome per scanned source."""
    outcomes.write.mode("append").partitionBy("task_key").parquet(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.select(F.to_json(F.struct(*manifest.columns)).alias("value")).write.mode("overwrite").text(path)
