"""Export state (D6, F7, E5): pending items by anti join, batches by rank
position, coverage label from min/max dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import with_global_rank

BATCH_SIZE = 20       # fixed: items per import batch


def pending(items: DataFrame, imported: DataFrame) -> DataFrame:
    """Items whose url_hash was not imported yet (left anti join)."""
    return items.join(imported.select("url_hash").distinct(), "url_hash", "left_anti")


def batches(pending_ranked: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Position among pending items in rank order, and its batch number."""
    p = with_global_rank(pending_ranked, [F.col("rank")], "pos")
    return p.withColumn("batch", F.floor((F.col("pos") - 1) / size).cast("long"))


def coverage(items: DataFrame) -> DataFrame:
    """Date range of the items and its ``MM.DD-MM.DD`` label."""
    d = F.to_date("publish_date")
    agg = items.agg(F.min(d).alias("d0"), F.max(d).alias("d1"), F.count(F.lit(1)).cast("long").alias("n"))
    label = F.when(F.col("d0").isNull(), F.lit("dates-unknown")).otherwise(
        F.concat(F.date_format("d0", "MM.dd"), F.lit("-"), F.date_format("d1", "MM.dd")))
    return agg.select(F.date_format("d0", "yyyy-MM-dd").alias("date_from"),
                      F.date_format("d1", "yyyy-MM-dd").alias("date_to"), label.alias("label"), "n")
