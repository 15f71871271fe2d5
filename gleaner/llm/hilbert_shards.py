"""Shards along a Hilbert curve over document metadata.

Source, language, size and id are quantised to a few bits each; a document's
place on the Hilbert curve through that grid keeps neighbours in every
dimension close, so a run of the curve has narrow minima and maxima in all
of them and readers can skip its files.  Documents are ordered along the
curve and cut into runs of equal row counts (law ``rows``).

The order is total (curve index, a hash of the id, id, text checksum) but
never computed by a global sort: rows are counted per (curve cell, hash
slot), running sums of those counts give every slot its offset, and
only the few rows of a slot are numbered by a window.  A hot source or cell
is spread over its slots.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BITS = 4


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Curve position of integer points; coords[dimension, point] < 2**bits.
    The transpose method: undo the excess work of each bit plane from the
    top, Gray-encode, and interleave."""
    x = coords.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _hilbert(bits: int):
    @F.pandas_udf("long")
    def index(*dims: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([d.to_numpy() for d in dims]), bits))
    return index


def cuts_of(df: DataFrame, col: str, parts: int) -> list:
    """At most parts - 1 values that cut the rows into about equal runs of
    ``col``.  The window runs over distinct values, and only the cut values
    reach the driver."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy(F.col(col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("slot", F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) * parts / F.sum("n").over(Window.partitionBy())))
    firsts = ranked.groupBy("slot").agg(F.min(col).alias("v")).where("slot > 0 AND v IS NOT NULL")
    return sorted(r["v"] for r in firsts.collect())


def _position(col: Column, cuts: list) -> Column:
    if not cuts:
        return F.lit(0)
    at = F.lit(0)
    for c in cuts:
        at = at + F.when(col >= F.lit(c), 1).otherwise(0)
    return F.coalesce(at, F.lit(0))


def shards(docs: DataFrame, *, count: int = 16, bits: int = BITS, slots: int = 1 << 12, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, columns of ``keep``, size (UTF-8
    bytes + 1), text_crc32, law ('rows'), shard (0 to count - 1), slot (place
    in its shard, gapless from 0), grown_shard (null), curve (Hilbert index).

    Null text has no bytes (checksum of the empty text); nulls in source,
    language or id take the lowest coordinate; rows that repeat in everything
    are numbered in any order, which leaves the same rows; an empty table
    gives an empty result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), *keep, F.col(source_col).cast("string").alias("_source"),
                       F.col(lang_col).cast("string").alias("_lang"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    narrow = materialise(rows, "shard-rows")
    parts = 1 << bits
    id_cuts = sorted(set(narrow.where(F.col("_id").isNotNull()).agg(
        F.percentile_approx("_id", [(i + 1) / parts for i in range(parts - 1)], 10_000).alias("q")).first()["q"] or []))
    dims = [_position(F.col("_source"), cuts_of(narrow, "_source", parts)),
            _position(F.col("_lang"), cuts_of(narrow, "_lang", parts)),
            F.least(F.floor(F.log2(F.col("size"))), F.lit(parts * 2 - 1)) / 2,
            _position(F.col("_id"), id_cuts)]
    placed = narrow.select("*", _hilbert(bits)(*[d.cast("long") for d in dims]).alias("curve"),
                           F.pmod(F.xxhash64("_id"), F.lit(slots)).alias("part"))
    placed = materialise(placed.drop("_source", "_lang"), "shard-placed")
    return _numbered(placed, count, id_col, keep)


def _numbered(placed: DataFrame, count: int, id_col: str, keep: tuple[str, ...]) -> DataFrame:
    cells = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialise(cells.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))), "shard-cells")
    # one row per curve cell: at most 2**(bits x dimensions), whatever the corpus
    upto = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    curve = (cells.groupBy("curve").agg(F.sum("n").alias("n"))
             .select("curve", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("rows")))
    offsets = cells.join(F.broadcast(curve), "curve").select("curve", "part", (F.col("start") + F.col("before")).alias("start"), "rows")
    within = Window.partitionBy("curve", "part").orderBy(F.col("_id").asc_nulls_first(), "text_crc32", "size")
    ranked = (placed.withColumn("_n", F.row_number().over(within) - 1).join(offsets, ["curve", "part"])
              .withColumn("rank", F.col("start") + F.col("_n")))
    # shard k holds ranks ceil(k * rows / count) to ceil((k + 1) * rows / count) - 1
    shard = F.expr(f"int((rank * {count}) div rows)")
    first = F.expr(f"(shard * rows + {count - 1}) div {count}")
    return (ranked.withColumn("shard", shard)
            .select(F.col("_id").alias(id_col), *keep, "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"))
