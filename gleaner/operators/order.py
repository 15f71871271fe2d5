"""Global rank column without a single-partition window.

``row_number()`` over an unpartitioned window moves every row into one
task.  Instead the rows are range-sorted across partitions, materialised
(checkpoint: ids stay stable even if a task is retried), numbered within
their partition, and shifted by the running count of the partitions before
them.  The offset table has one row per partition, a proven bound, so it
is broadcast.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def with_global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    checkpoint_dir(df.sparkSession)
    # The range sort samples its input and the checkpoint writes what a first
    # pass computed; persisting both sides keeps the upstream plan from
    # running three times (released once the checkpoint is written).
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    numbered = (src.orderBy(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        numbered_ck = numbered.checkpoint(eager=True)
    finally:
        numbered.unpersist()
        src.unpersist()
    numbered = numbered_ck
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + local + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write df once to the shared checkpoint folder (computed
    once through a temporary persist) and read it from there."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
