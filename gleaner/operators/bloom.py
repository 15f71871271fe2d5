"""A Bloom filter as a table: the few hashes of a run against a large state.

The filter of a run's url hashes is a bitmap of fixed width, one row per 64
bits, made by a partial ``bit_or``; it is broadcast, and every row of the
state is tested where it is read.  Only the possible hits go on to the exact
comparison, so a run shuffles its own items and a few rows of the state, not
the state.

The width follows from the number of items, up to ``MOST_BITS`` (about a
million rows).  A run with more items than that can tell apart gets the state
as it is: the exact comparison stands alone then.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Probes a hash, bits an item aimed at, and the least and largest width (powers of two).
PROBES, BITS_AN_ITEM, LEAST_BITS, MOST_BITS = 3, 8, 16, 26


def width_for(items: int) -> int | None:
    """Width of the filter as a power of two; None beyond ``MOST_BITS``."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(items, 1) * BITS_AN_ITEM)))
    return bits if bits <= MOST_BITS else None


def _places(url_hash: Column, bits: int) -> list[Column]:
    """Bit places of a hash, one a probe."""
    return [F.xxhash64(url_hash, F.lit(i)).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(PROBES)]


def bitmap(hashes: DataFrame, bits: int, col: str = "url_hash") -> DataFrame:
    """(slot, marks): 64 bits a row; slots without a bit have no row."""
    place = hashes.select(F.explode(F.array(*_places(F.col(col), bits))).alias("place"))
    return place.groupBy(F.shiftright("place", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("marks"))


def possible(state: DataFrame, filter_: DataFrame, bits: int, col: str = "url_hash") -> DataFrame:
    """Rows of ``state`` whose every probe is marked: all true hits, and few
    others.  One map-side join a probe."""
    out = state
    for i, place in enumerate(_places(F.col(col), bits)):
        marked = F.broadcast(filter_.select(F.col("slot").alias(f"slot__{i}"), F.col("marks").alias(f"marks__{i}")))
        out = (out.withColumn("place__", place).join(marked, F.shiftright("place__", 6) == F.col(f"slot__{i}"))
               .where(F.expr(f"(shiftright(marks__{i}, int(place__ & 63)) & 1L) = 1")).drop("place__", f"slot__{i}", f"marks__{i}"))
    return out


def candidates(state: DataFrame, items: DataFrame, col: str = "url_hash", bits: int | None = None) -> DataFrame:
    """Rows of ``state`` that may hold a hash of ``items``; the whole state
    if the items are too many for the filter.  Rows without a hash are never
    candidates."""
    bits = bits or width_for(items.count())
    if bits is None:
        return state
    known = items.select(col).where(F.col(col).isNotNull())
    return possible(state.where(F.col(col).isNotNull()), bitmap(known, bits, col), bits, col)
