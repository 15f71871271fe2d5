"""Shared-folder locations for stream landing, sinks, state and checkpoints.

Everything lives under the cluster's checkpoint folder (``spark.checkpoint.dir``),
never under a machine-local temp folder; each run gets its own sub-folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import checkpoint_dir


def run_folder(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (Hadoop FileSystem of the path's scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
