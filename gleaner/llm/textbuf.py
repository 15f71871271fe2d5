"""Numpy helpers over Arrow text columns: bounded slices and word hashes.

All word operators agree on one definition: words are the maximal runs of
bytes other than space and 0x09-0x0D (which are never part of a longer
UTF-8 sequence), compared after lower-casing A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Bytes hashed at once (a longer word counts as one): the tables of powers stay small in every worker.
SEGMENT = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_state: dict = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offs = offs.astype(np.int64)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``most`` bytes (one row at least): (lo, hi, bytes,
    offsets).  Texts are never cut."""
    data, offs = buffer(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_state.get("pow", ())) < n:
        size = max(n, SEGMENT)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("pow", _BASE), ("inv", inverse)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _state[name] = np.multiply.accumulate(t)
        low = np.arange(256)
        low[65:91] += 32
        _state["letters"] = mix64(low.astype(np.uint64) + np.uint64(1))
    return _state["pow"], _state["inv"], _state["letters"]


def words(data: np.ndarray, offs: np.ndarray, parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): byte ranges of all words; words
    bounds[i]:bounds[i + 1] belong to row i.  ``parts`` marks the bytes
    between words."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    space = parts[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offs[:-1][offs[:-1] < len(data)]] = True
    after[offs[1:][offs[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial over its bytes from running
    sums, then mixed with its length."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        seg = data[base:ends[j - 1]]
        power, inverse, letters = _tables(len(seg))
        run = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(letters[seg] * power[:len(seg)], out=run[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((run[e] - run[s]) * inverse[s] + (e - s).astype(np.uint64) * _MIX[1])
        i = j
    return out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive word hashes (rows not respected)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc += h[j:j + n] * _odd(j)
    return mix64(acc)


def short_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole sequence shorter than a shingle."""
    acc = np.zeros(1, np.uint64)
    for j in range(len(h)):
        acc += h[j:j + 1] * _odd(j)
    return mix64(mix64(acc) + np.uint64(len(h)))[0]


def _odd(j: int) -> np.uint64:
    """Unrelated odd multipliers, one a position (related ones, such as an
    arithmetic series, let different runs of repeated words collide)."""
    return mix64(np.full(1, j + 1, np.uint64) * _BASE)[0] | np.uint64(1)
