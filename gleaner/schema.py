"""Explicit schemas of the engine's tables (never inferred)."""

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

RAW_ITEMS = StructType([
    StructField("url", StringType(), False),
    StructField("title", StringType()),
    StructField("source", StringType()),
    StructField("publish_date", DateType()),
    StructField("excerpt", StringType()),
    StructField("raw_html", StringType()),
    StructField("fetched_at", TimestampNTZType()),
    StructField("source_ord", IntegerType()),
    StructField("item_ord", LongType()),
])

SEEN = StructType([
    StructField("task_key", StringType()),
    StructField("url_hash", StringType()),
    StructField("first_seen_ts", TimestampNTZType()),
    StructField("seen_day", DateType()),
])

FETCH_LOG = StructType([
    StructField("task_key", StringType()),
    StructField("source_id", StringType()),
    StructField("ts", TimestampNTZType()),
    StructField("success", BooleanType()),
    StructField("item_count", LongType()),
])

SOURCES = StructType([
    StructField("source_ord", IntegerType()),
    StructField("type", StringType()),
    StructField("label", StringType()),
    StructField("url", StringType()),
    StructField("query", StringType()),
    StructField("weight", DoubleType()),
])

DISPOSITIONS = ["dup_state", "dup_run", "no_date", "not_included", "excluded", "low_signal", "passed"]
FILTER_REASONS = ["no_date", "not_included", "excluded", "low_signal"]
