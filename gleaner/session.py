"""SparkSession helpers.

Library code never builds its own session; callers pass one in.  The
helpers here are for tests, benchmarks and command-line use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every gleaner job relies on.  UTC pins date arithmetic so the
# DuckDB oracle and Spark agree; AQE re-plans joins (broadcast vs sort-merge),
# coalesces small shuffle partitions and splits skewed ones at runtime.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(scratch: str, cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gleaner", driver_memory: str = "8g") -> SparkSession:
    """A local session whose checkpoints and warehouse lie under ``scratch``."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.driver.memory", driver_memory))
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage: ``spark.checkpoint.dir`` of the
    session; only where that is unset, a folder of the session's warehouse,
    which the driver and all executors share too."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.  A join
    side read this way is a bare shuffle, which AQE can split by skew."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings sized for a large input (e.g. 100 TB on ~1000 executors).

    * scan splits of 512 MB keep the task count near input / 512 MB;
    * the initial shuffle partition count gives ~256 MB per partition
      before AQE coalesces small ones (never fewer than 2 waves of cores);
    * AQE splits skewed join partitions above 5x the median / 1 GB;
    * broadcasts stay behind AQE's measured size (64 MB)."""
    partitions = max(2 * total_cores, input_bytes // (target_partition_mb << 20))
    return {
        **CORE_CONF,
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
