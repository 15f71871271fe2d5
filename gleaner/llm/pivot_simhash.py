"""Near-duplicate documents by SimHash, compared through pivot distance tables.

A document's fingerprint has 64 bits: bit b is set if more than half of its
word shingles' XXH64 hashes have it set.  Two fingerprints link if they
differ in at most ``bits`` bits; the result is the connected groups.

The pivot table of a fingerprint holds its Hamming distances to
``references`` fixed reference fingerprints.  By the triangle inequality two
linked fingerprints differ by at most ``bits`` in every coordinate, so a pair
whose largest coordinate difference is above is discarded; survivors are
verified on the fingerprints.

Which pairs meet: equal fingerprints are one row first.  The 64 bits are cut
into m blocks; linked fingerprints agree in m - bits of them, so every choice
of so many blocks is a list key, m chosen such that a key has at least as
many values as there are fingerprints (lists stay short by chance at any
size).  A list that is long all the same, because a corpus crowds there, is
replaced by the lists of further blocks of its free bits, again and again:
exact, and no list is handled by one task that grows with the corpus.
Within a list the links are walked breadth first, each step a window of the
first coordinate, the other coordinates, then the survivors; found
fingerprints leave the list, so a crowd of m near copies costs about m steps
and gives m - 1 links, not all pairs.

Recovery: fingerprints, distinct fingerprints and links are tables in shared
storage; every other step is recomputed from them by the task that was lost.

Defined results: null texts and texts without words have fingerprint zero and
link like any other; texts of fewer than k words have their whole sequence as
one shingle; rows that repeat an id are judged by their own texts; rows
without an id have a fingerprint and a null component and link nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise
from .textbuf import mix64, slices, words

SEED = 42
REFERENCES = 32
#: Lists of more members are split by further blocks.
LONG = 4096
#: Lists with so few free bits are not split: they have 2**FEW_FREE members at most.
FEW_FREE = 12
_CHUNK = 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALL = (1 << 64) - 1


def shingle_hashes(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): XXH64 of the k-word shingles of every row, words
    lower-cased in A-Z and joined by single spaces."""
    starts, ends, bounds = words(data, offs)
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])[:-1] + np.arange(len(size))      # word places when joined
    joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.repeat(starts - at, size) + (place := np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size))
    joined[place] = _LOWER[data[inside]]
    n = np.diff(bounds)
    shingles = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    upto = np.concatenate([[0], np.cumsum(shingles)])
    first = np.repeat(bounds[:-1], shingles) + np.arange(upto[-1]) - np.repeat(upto[:-1], shingles)
    last = first + np.repeat(np.minimum(n, k), shingles) - 1
    raw, one = joined.tobytes(), xxhash.xxh64_intdigest
    out = np.empty(len(first), np.uint64)
    for lo in range(0, len(first), _CHUNK):
        a, b = at[first[lo:lo + _CHUNK]], at[last[lo:lo + _CHUNK]] + size[last[lo:lo + _CHUNK]]
        out[lo:lo + _CHUNK] = np.fromiter((one(raw[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())), np.uint64, len(a))
    return out, upto


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a document's shingle hashes (none: zero)."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _CHUNK):
        part = hashes[lo:lo + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(1)):
                hashes, bounds = shingle_hashes(data, offs, k)
                found = np.array([majority(hashes[a:b]) for a, b in zip(bounds, bounds[1:])], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found.view(np.int64))], names=["id", "fp"])
    return run


def blocks_for(count: int, bits: int) -> int:
    """The least number of blocks whose keys have ``count`` values or more."""
    m = bits + 2
    while m < 16 and 2 ** (64 * (m - bits) / m) < count:
        m += 1
    return m


def masks(free: int, blocks: int, bits: int) -> list[int]:
    """Bit masks of every choice of ``blocks - bits`` blocks of the free bits."""
    places = [b for b in range(64) if free >> b & 1]
    cuts = [round(i * len(places) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in places[x:y]) for x, y in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(parts, blocks - bits)]


def _post(blocks: int, bits: int):
    """(fp, mask) -> (key, fp, mask): the lists that a fingerprint is in, by
    further blocks of the bits that its mask leaves free."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, held = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            for used in np.unique(held).tolist():
                some = fp[held == used]
                for more in masks(~used & _ALL, blocks, bits):
                    mask = np.uint64(used | more)
                    key = mix64(mix64(some & mask) ^ mix64(np.full(1, mask)))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(some.view(np.int64)),
                                                      pa.array(np.full(len(some), mask).view(np.int64))], names=["key", "fp", "mask"])
    return run


def pivots(count: int) -> np.ndarray:
    return mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def tree(fp: np.ndarray, table: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (places) that connect a list as all its links would."""
    rest = np.argsort(table[:, 0], kind="stable")
    near, links = [], []
    while len(rest):
        if not near:
            near.append(int(rest[0]))
            rest = rest[1:]
            continue
        x = near.pop()
        lo, hi = np.searchsorted(table[rest, 0], [int(table[x, 0]) - bits, int(table[x, 0]) + bits + 1])
        some = np.arange(lo, hi)
        some = some[np.abs(table[rest[some]] - table[x]).max(axis=1, initial=0) <= bits]        # pivot distances
        some = some[np.bitwise_count(fp[rest[some]] ^ fp[x]) <= bits]                            # verification
        if len(some):
            found = rest[some]
            links += [(x, int(y)) for y in found]
            near += found.tolist()
            rest = np.delete(rest, some)
    return links


def _links(bits: int, references: int):
    """Rows in key order -> links; a list may go on in the next batch."""
    refs = pivots(references)

    def distances(fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, None] ^ refs).astype(np.int8)

    def walked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.diff(key)) + 1
        start, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
        several = end - start > 1
        start, end = start[several], end[several]
        pair = start[end - start == 2]                                   # most lists: all at once
        pair = pair[np.abs(distances(fp[pair]) - distances(fp[pair + 1])).max(axis=1, initial=0) <= bits]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= bits]
        a, b = [fp[pair]], [fp[pair + 1]]
        for x, y in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist()):
            part = np.unique(fp[x:y])
            at = np.array(tree(part, distances(part), bits), np.int64).reshape(-1, 2)
            a.append(part[at[:, 0]])
            b.append(part[at[:, 1]])
        out = [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)]
        return pa.RecordBatch.from_arrays(out, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            if whole:
                yield walked(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
        if len(key):
            yield walked(key, fp)
    return run


def links(found: DataFrame, *, bits: int = 4, references: int = REFERENCES, long: int = LONG) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``fp``) that
    connect them as all pairs within ``bits`` bits would."""
    blocks, posted = blocks_for(found.count(), bits), "key long, fp long, mask long"
    rows = found.select("fp", F.lit(0).cast("long").alias("mask"))
    out = None
    while True:
        lists = rows.mapInArrow(_post(blocks, bits), posted)
        crowded = materialise(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("mask").alias("mask"))
                              .where((F.col("n") > long) & (F.bit_count("mask") < 64 - FEW_FREE)).select("key"), "simhash-long")
        more = not crowded.isEmpty()
        short = lists.join(crowded, "key", "left_anti") if more else lists
        part = short.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_links(bits, references), "a long, b long")
        part = materialise(part, "simhash-links")
        out = part if out is None else out.union(part)
        if not more:
            return out
        rows = materialise(lists.join(crowded, "key", "left_semi").select("fp", "mask"), "simhash-crowded")
        blocks = bits + 2


def simhash_components(docs: DataFrame, *, k: int = 4, bits: int = 4, references: int = REFERENCES, long: int = LONG, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, fingerprint (16 hexadecimal
    digits), component_id (the smallest id reachable by links, itself
    included)."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marked = materialise(src.mapInArrow(_fingerprints(k), "id long, fp long"), "simhash-docs")
    found = materialise(marked.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("id")), "simhash-distinct")
    roots = components(links(found, bits=bits, references=references, long=long)).select(F.col("node").alias("fp"), "root")
    grouped = materialise(roots.join(found, "fp"), "simhash-groups")
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    named = grouped.select("fp", "root").join(least, "root").select("fp", "component_id")
    names = materialise(found.join(named, "fp", "left").select("fp", F.coalesce("component_id", "id").alias("component_id")), "simhash-names")
    joined = marked.where("id IS NOT NULL").join(names, "fp").select("id", "fp", "component_id")
    alone = marked.where("id IS NULL").select("id", "fp", F.lit(None).cast("long").alias("component_id"))
    return joined.union(alone).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
