"""Shared pieces of the corpus operators: tables in shared storage and
connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the
    session; only where that is unset (tests), a folder of the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it from there: lineage is
    cut, and a lost executor costs only the reading tasks."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``materialise`` that nothing reads any more, also no
    frame that is still to be evaluated."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application (call it when all
    results that read them have been written)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between longs -> (node, root), root the smallest id of
    the connected component.  Nodes without links do not appear.

    Contraction: every node points to its smallest neighbour (or itself),
    pointers are doubled until they rest on local minima, and the links are
    rewritten between those roots.  A component's smallest node is always a
    local minimum, so it survives every round.  All state is in tables; the
    driver sees only emptiness checks.
    """
    cur = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .where("a < b").distinct(), "links")
    label: DataFrame | None = None
    while not cur.isEmpty():
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialise(both.groupBy(F.col("a").alias("node"))
                             .agg(F.least(F.min("b"), F.min("a")).alias("p")), "parent")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = materialise(parent.join(up, "p").select("node", F.col("pp").alias("p"),
                                                             (F.col("pp") != F.col("p")).alias("moved")), "jump")
            parent = jumped.select("node", "p")
            if jumped.where("moved").isEmpty():
                break
        if label is None:
            label = parent.select("node", F.col("p").alias("root"))
        else:
            label = materialise(label.join(parent.select(F.col("node").alias("root"), "p"), "root", "left")
                                .select("node", F.coalesce("p", "root").alias("root")), "label")
        cur = materialise(_relabel(_relabel(cur, parent, "a"), parent, "b")
                          .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                          .where("a < b").distinct(), "links")
    if label is None:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label


def _relabel(links: DataFrame, parent: DataFrame, side: str) -> DataFrame:
    return (links.join(parent.select(F.col("node").alias(side), F.col("p").alias("_p")), side)
            .drop(side).withColumnRenamed("_p", side))
