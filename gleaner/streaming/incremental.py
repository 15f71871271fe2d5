"""Incremental curation (H1, H4) and TTL dedup on a stream (H2).

H1 is the exact form of the reference's periodic run: landed items are
read as a file stream, and each micro-batch runs the batch operators
(dedup against the seen table, gate, score) inside ``foreachBatch``; new
hashes (filtered items included) are appended to the seen table, so a
later arrival of the same URL is ``dup_state``.  Every write is keyed by
the batch id and overwrites that key, so a re-executed batch replaces its
own output instead of duplicating it, and reads of the seen table exclude
the batch being written.

H2 is the scalable event-time form: ``dropDuplicatesWithinWatermark`` keeps
one row per URL hash while its state is younger than the TTL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import ntz
from ..functions.url import url_hash
from ..plans.pipeline import survivors, tag
from ..schema import RAW_ITEMS
from ..sources.state import live_seen
from ..spec import JobSpec

SEEN_COLUMNS = ["task_key", "url_hash", "first_seen_ts"]


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_ITEMS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def seed_state(seen: DataFrame, state_path: str) -> None:
    """Write existing seen rows as batch -1 of the state table."""
    (seen.select(*SEEN_COLUMNS).withColumn("batch_id", F.lit(-1).cast("long"))
     .write.mode("overwrite").partitionBy("batch_id").parquet(state_path))


def _read_state(spark: SparkSession, state_path: str, before_batch: int) -> DataFrame:
    s = spark.read.parquet(state_path)
    return s.where(F.col("batch_id") < before_batch).select(*SEEN_COLUMNS)


def run_batch(batch: DataFrame, batch_id: int, *, spec: JobSpec, as_of: dt.datetime,
              state_path: str, out_path: str) -> None:
    """One micro-batch of the curation run (also usable as a plain batch)."""
    spark = batch.sparkSession
    seen = live_seen(_read_state(spark, state_path, batch_id), spec.task_key, spec.dedup_ttl_days, as_of)
    tagged = tag(batch, seen, spec).persist()
    try:
        items = survivors(tagged, spec, as_of)
        (items.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))
        new = (tagged.where(F.col("dup").isNull())
               .select(F.lit(spec.task_key).alias("task_key"), "url_hash",
                       ntz(as_of).alias("first_seen_ts"))
               .withColumn("batch_id", F.lit(batch_id).cast("long")))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(state_path)
    finally:
        tagged.unpersist()


def run_incremental(spark: SparkSession, landing: str, *, spec: JobSpec, as_of: dt.datetime,
                    state_path: str, out_path: str, checkpoint: str) -> None:
    """Process every landed file not seen by earlier runs, then stop
    (``availableNow``: the cron-style run, restartable from the checkpoint)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        run_batch(df, batch_id, spec=spec, as_of=as_of, state_path=state_path, out_path=out_path)

    q = (landing_stream(spark, landing).writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def ttl_dedup(stream: DataFrame, event_time: str, ttl_days: int) -> DataFrame:
    """One row per url_hash while its first sighting is within ttl_days of
    the watermark (state expires with the watermark)."""
    s = stream.withColumn("url_hash", url_hash("url")) if "url_hash" not in stream.columns else stream
    # watermarks need TIMESTAMP (with zone); landed times are UTC wall-clock
    s = s.withColumn("_event_ts", F.col(event_time).cast("timestamp"))
    return (s.withWatermark("_event_ts", f"{ttl_days} days")
            .dropDuplicatesWithinWatermark(["url_hash"]).drop("_event_ts"))
