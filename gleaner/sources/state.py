"""Seen state (A16, G7): an append-only table read with a TTL.

The reference rewrites one JSON map per run; a table that is read while
written cannot be overwritten, so new hashes are appended (partitioned by
``task_key`` and the day first seen) and expiry is a filter at read time
that prunes whole day folders.  A hash seen again after expiry simply
gets a second row, which reads the same as the map.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import ntz

from ..schema import SEEN


def live_seen(seen: DataFrame, task_key: str, ttl_days: int | None,
              as_of: dt.datetime) -> DataFrame:
    """Rows of this task still inside the TTL (ttl <= 0 or None keeps all)."""
    s = seen.where(F.col("task_key") == task_key)
    if ttl_days is None or ttl_days <= 0:
        return s
    cutoff = as_of - dt.timedelta(days=ttl_days)
    live = s.where(F.col("first_seen_ts") >= ntz(cutoff))
    if "seen_day" not in seen.columns:
        return live
    return live.where(F.col("seen_day").isNull() | (F.col("seen_day") >= F.lit(cutoff.date())))


def load_seen(spark: SparkSession, path: str, task_key: str, ttl_days: int | None,
              as_of: dt.datetime) -> DataFrame:
    """Read the seen table; only a missing table is empty state (any other
    fault fails the run instead of re-admitting everything)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        seen = spark.read.schema(SEEN).parquet(path)
    else:
        seen = spark.createDataFrame([], SEEN)
    return live_seen(seen, task_key, ttl_days, as_of)


def new_hashes(tagged: DataFrame, task_key: str, as_of: dt.datetime) -> DataFrame:
    """All first-seen hashes of a run, filtered items included."""
    return (tagged.where(F.col("dup").isNull())
            .select(F.lit(task_key).alias("task_key"), "url_hash",
                    ntz(as_of).alias("first_seen_ts")))
