"""Source health from an append-only fetch log.

The reference keeps a mutable per-source record; here the record is a
fold over the log, written as two partial aggregates: the last success per
source, then the failures after it (the trailing failure streak).  The
per-source table is written to shared storage and read back for the join:
AQE then broadcasts it if small, or splits a source that holds most of the
log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import ntz
from ..session import shared_table

DISABLE_AFTER = 5     # fixed: consecutive failures that disable a source
ALERT_AT = 3          # fixed: consecutive failures that raise an alert


def source_health(log: DataFrame) -> DataFrame:
    """Per (task_key, source_id): consecutive_failures, last_success,
    last_failure, disabled, total_items_fetched, fetches."""
    keys = ["task_key", "source_id"]
    ok = F.col("success")
    first = log.groupBy(*keys).agg(
        F.max(F.when(ok, F.col("ts"))).alias("last_success"),
        F.max(F.when(~ok, F.col("ts"))).alias("last_failure"),
        F.sum(F.when(ok, F.col("item_count")).otherwise(F.lit(0))).cast("long").alias("total_items_fetched"),
        F.count(F.lit(1)).cast("long").alias("fetches"))
    # one row per source joins back to the log; the per-source columns ride
    # through the second aggregate, so no third join is needed
    after_last = ~ok & (F.col("last_success").isNull() | (F.col("ts") > F.col("last_success")))
    first = shared_table(first, "source-facts")
    return (log.select(*keys, "ts", "success").join(first, keys)
            .groupBy(*keys)
            .agg(F.count_if(after_last).cast("long").alias("consecutive_failures"),
                 F.max("last_success").alias("last_success"), F.max("last_failure").alias("last_failure"),
                 F.max("total_items_fetched").alias("total_items_fetched"), F.max("fetches").alias("fetches"))
            .withColumn("disabled", F.col("consecutive_failures") >= DISABLE_AFTER))


def health_alerts(health: DataFrame, threshold: int = ALERT_AT) -> DataFrame:
    """Sources with a streak >= threshold or disabled; disabled first, then
    by streak."""
    return (health.where((F.col("consecutive_failures") >= threshold) | F.col("disabled"))
            .select("source_id", F.col("consecutive_failures").alias("failures"), "last_failure",
                    "disabled", F.when(F.col("disabled"), F.lit("disabled")).otherwise(F.lit("alert")).alias("status"))
            .orderBy(F.col("disabled").desc(), F.col("failures").desc(), F.col("source_id")))


def enabled_sources(sources: DataFrame, health: DataFrame) -> DataFrame:
    """Configured sources minus the disabled ones (left anti join)."""
    disabled = health.where("disabled").select(F.col("source_id").alias("label"))
    return sources.join(disabled, "label", "left_anti")


def fetch_outcomes(counts: DataFrame, sources: DataFrame, task_key: str, ts) -> DataFrame:
    """One fetch-log row per source in ``sources`` (those that were scanned,
    not the disabled ones) (G8): success iff items > 0."""
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return (sources.select(F.col("label").alias("source_id"))
            .join(counts.select(F.col("source").alias("source_id"), "n"), "source_id", "left")
            .select(F.lit(task_key).alias("task_key"), "source_id",
                    ntz(ts).alias("ts"), (n > 0).alias("success"),
                    n.alias("item_count")))
