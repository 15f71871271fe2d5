"""Source health as a streaming fold with keyed state (H3).

One state record per source lives in the state store: totals, the last
success and failure, and the open failure streak.  A micro-batch reads and
writes only the records of the sources it holds rows of, and the sink gets
only those, so a batch costs what it holds however many sources there are.

Rows may arrive in any order within ``delay`` of event time: failures after
the last success are kept by their time until the watermark has passed them,
so a success that arrives late still ends exactly the failures before it.
Failures that the watermark has passed are only counted.  Rows older than the
watermark are late and are left out (H4).  With ``forget_days`` a record has a
time to live: a timer drops it when the watermark is so long past its last row.

State, watermark and the list of read files are in the checkpoint: a run
that starts again goes on where the last one stopped, and a batch that runs
again overwrites its own rows of the sink.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.common import ntz
from ..operators.health import DISABLE_AFTER
from ..schema import FETCH_LOG

HEALTH_COLUMNS = ["task_key", "source_id", "consecutive_failures", "last_success", "last_failure",
                  "total_items_fetched", "fetches"]
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_RECORD = "last_success long, last_failure long, items long, fetches long, settled long, open array<long>"
_OUT = "task_key string, source_id string, consecutive_failures long, last_success long, last_failure long, items long, fetches long"
_EPOCH = dt.datetime(1970, 1, 1)


class HealthFold(StatefulProcessor):
    """State of one (task_key, source_id): the record, with the times of the
    failures after the last success that the watermark has not passed.  It is
    one value, read and written once a batch: a source has few rows in a
    batch, so calls to the store and frames of rows would be its cost."""

    def __init__(self, forget_ms: int | None = None):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", _RECORD)

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        success, failure, items, fetches, settled, kept = self.record.get() or (None, None, 0, 0, 0, [])
        failures, ended = list(kept), success
        for _, _, at, good, count, _ in rows:
            if at < watermark:
                continue
            fetches += 1
            if good:
                items += count
                success = at if success is None or at > success else success
            else:
                failure = at if failure is None or at > failure else failure
                failures.append(at)
        if success != ended:
            settled = 0                          # all of them are older than any row that is not late
        failures = [t for t in failures if success is None or t > success]
        recent = [t for t in failures if t >= watermark]
        settled += len(failures) - len(recent)
        self.record.update((success, failure, items, fetches, settled, recent))
        if self.forget_ms is not None and fetches:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(max(t for t in (success, failure) if t is not None) // 1000 + self.forget_ms)
        if fetches:
            yield Row(task_key=key[0], source_id=key[1], consecutive_failures=settled + len(recent), last_success=success, last_failure=failure,
                      items=items, fetches=fetches)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.record.clear()
        yield from ()

    def close(self) -> None:
        pass


def _micros(c: str) -> Column:
    return F.timestamp_diff("MICROSECOND", ntz(_EPOCH), F.col(c).cast("timestamp_ntz")).cast("long")


def _time(c: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(c), ntz(_EPOCH))


def fold(log: DataFrame, delay: str, forget_days: int | None = None) -> DataFrame:
    """Streaming fetch log -> the changed health records of every batch."""
    events = (log.select("task_key", "source_id", _micros("ts").alias("at"), "success", F.coalesce("item_count", F.lit(0)).cast("long").alias("item_count"))
              .where("at IS NOT NULL AND success IS NOT NULL")
              .withColumn("event_ts", F.timestamp_micros("at")).withWatermark("event_ts", delay))
    forget = None if forget_days is None else forget_days * 86_400_000
    out = events.groupBy("task_key", "source_id").transformWithState(HealthFold(forget), _OUT, "Update", "EventTime")
    return out.select("task_key", "source_id", "consecutive_failures", _time("last_success").alias("last_success"),
                      _time("last_failure").alias("last_failure"), F.col("items").alias("total_items_fetched"), "fetches")


def run_health_stream(spark: SparkSession, landing: str, health_path: str, checkpoint: str, *, delay: str = "7 days", forget_days: int | None = None,
                      max_files: int | None = None) -> None:
    """Fold every new fetch-log file into the health table (availableNow):
    only changed records are appended, a version per batch."""
    if spark.conf.get(STORE[0], "") != STORE[1]:
        spark.conf.set(*STORE)

    def fn(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(health_path))

    reader = spark.readStream.schema(FETCH_LOG)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (fold(reader.parquet(landing), delay, forget_days).writeStream.outputMode("update").foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_health(spark: SparkSession, health_path: str) -> DataFrame:
    """The last version of every source's record."""
    rest = [c for c in HEALTH_COLUMNS if c not in ("task_key", "source_id")]
    return (spark.read.parquet(health_path).groupBy("task_key", "source_id").agg(F.max_by(F.struct(*rest), "batch_id").alias("record"))
            .select("task_key", "source_id", "record.*").withColumn("disabled", F.col("consecutive_failures") >= DISABLE_AFTER))
