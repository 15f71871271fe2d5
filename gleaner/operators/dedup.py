"""Dedup against seen state (D1) and within a run, first wins.

The seen state is read once and never shuffled whole: a Bloom filter of the
run's hashes is tested where its rows are read (``bloom``), and only possible
hits are compared exactly.

The facts of each ``url_hash`` (its first arrival, whether it was seen) come
from a partial ``min`` / ``max`` aggregate, so a hot hash collapses map-side.
They are written to shared storage before they are joined back: AQE splits
a skewed partition only between two bare shuffles, and a join with the
aggregate itself would put all rows of a hot hash in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from ..functions.common import cached
from ..session import shared_table


@cached
def arrival(source_ord: str = "source_ord", item_ord: str = "item_ord") -> Column:
    """(source_ord, item_ord) as one decimal that sorts the same way, so
    "first" is a fixed-width ``min`` (hash aggregate, no sort); any int and
    any long fit."""
    s, i = F.col(source_ord).cast("decimal(10,0)"), F.col(item_ord).cast("decimal(19,0)")
    return s * F.lit(str(1 << 64)).cast("decimal(20,0)") + i


def hash_facts(items: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Per url_hash: the first arrival in this run and whether the hash is
    in the seen state; one partial aggregate over items unioned with seen."""
    keys = items.select("url_hash", arrival().alias("_arr"), F.lit(False).alias("_seen"))
    if seen is not None:
        nothing = F.lit(None).cast(keys.schema["_arr"].dataType)
        keys = keys.unionByName(seen.select("url_hash", nothing.alias("_arr"), F.lit(True).alias("_seen")))
    return keys.groupBy("url_hash").agg(F.min("_arr").alias("_first"), F.max("_seen").alias("_in_seen"))


def tag_duplicates(items: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Add ``dup`` in {'dup_state', 'dup_run', None}.

    ``items`` needs url_hash, source_ord, item_ord.  A hash present in
    ``seen`` marks all its rows dup_state; otherwise every row but the first
    in (source_ord, item_ord) order is dup_run."""
    near = None if seen is None else bloom.candidates(seen.select("url_hash"), items)
    facts = shared_table(hash_facts(items, near), "hash-facts")
    out = items.join(facts, "url_hash", "left")
    dup = (F.when(F.col("_in_seen"), F.lit("dup_state"))
           .when(arrival() != F.col("_first"), F.lit("dup_run")))
    return out.select(*items.columns, dup.alias("dup"))


def first_wins(items: DataFrame) -> DataFrame:
    """Rows that are the first of their url_hash (D2 alone)."""
    return tag_duplicates(items, None).where(F.col("dup").isNull()).drop("dup")


def not_seen(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose url_hash is not in the seen state (D1 alone)."""
    return items.join(bloom.candidates(seen.select("url_hash"), items), "url_hash", "left_anti")
