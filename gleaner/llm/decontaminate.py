"""Benchmark decontamination: n-gram seeds, then local alignment.

The test items are a stated query set.  Repeated items count once; the rest
are taken in blocks of ``BLOCK_BYTES`` of text at most (a longer item is a
block of its own); each block goes to every task, and all documents are read
against it, so no document text is ever shuffled.

1. Every word n-gram of an item is a seed, however many documents hold it:
   an edited copy keeps only some of the item's n-grams, and those may be
   the common ones.
2. Where a document holds a seed and the passage around it enough of the
   item's words, the passage is aligned with the item (Smith-Waterman over words: match 1, mismatch and gap -1/2).  The
   score is the best alignment divided by the item's length: 1 for a verbatim
   copy, about 0.7 with every fifth word changed; a document is leaked at
   0.5 or more.

3. An item of fewer than n words is found by its whole sequence.

Words are runs of letters, marks and digits of the lower-cased text, so case
and punctuation of any kind (dashes, quotes, no-break spaces) do not hide a
copy; in scripts that are written without spaces a character is a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import buffer, gram_hashes, slices, word_hashes, words

#: Bytes of test items that go to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Pairs of a hit and a place in an item that are looked at together.
SPOTS = 1 << 20
_MASK = (1 << 22) - 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PART = np.zeros(256, bool)
_PART[:128] = [not chr(c).isalnum() for c in range(128)]
_BETWEEN = r"[^\p{L}\p{M}\p{N}]+"
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def _words(col: pa.Array):
    """Slices of a column: (row range, word hashes, bounds by row)."""
    for lo, hi, data, offs in slices(col):
        if len(data) and int(data.max()) >= 128:             # beyond ASCII: borders by kind of character
            part = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(col.slice(lo, hi - lo), "")), _BETWEEN, " ")
            if pc.any(pc.match_substring_regex(part, _UNSPACED)).as_py():
                part = pc.replace_substring_regex(part, _UNSPACED, r" \1 ")
            data, offs = buffer(part)
        else:
            data = _LOWER[data]
        starts, ends, bounds = words(data, offs, _PART)
        yield lo, hi, word_hashes(data, starts, ends), bounds


@dataclass
class Items:
    """A block of test items: ids, word hashes, and their distinct n-grams
    (sorted) with the (item, place) of every occurrence."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray
    owner: np.ndarray       # gram number of each occurrence
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None], n: int) -> Items:
        seqs: list[np.ndarray] = []
        for _, _, h, bounds in _words(pa.array(texts, pa.string())):
            seqs += [h[a:b] for a, b in zip(bounds, bounds[1:])]
        grams = [gram_hashes(s, n) for s in seqs]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        names, owner = np.unique(flat, return_inverse=True)
        return cls(ids, seqs, names, owner, np.repeat(np.arange(len(grams)), [len(g) for g in grams]),
                   np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64))


class _Finder:
    """Places of a block's n-grams in word sequences: a small bit table,
    then a search among the sorted n-grams."""

    def __init__(self, items: Items, n: int):
        self.grams, self.n = items.grams, n
        self.table = np.zeros(_MASK + 1, bool)
        self.table[(items.grams & np.uint64(_MASK)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, word place, gram number), n-grams within one row only."""
        g = gram_hashes(h, self.n)
        at = np.flatnonzero(self.table[(g & np.uint64(_MASK)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            none = np.zeros(0, np.int64)
            return none, none, none
        no = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        row = np.searchsorted(bounds, at, "right") - 1
        good = (self.grams[no] == g[at]) & (at + self.n <= bounds[row + 1])
        return row[good], at[good], no[good]


def align(item: np.ndarray, window: np.ndarray, miss: float = 0.5, gap: float = 0.5) -> float:
    """Best local alignment score (match 1), a row of the table at a time."""
    slope = np.arange(len(window)) * gap
    score = np.zeros(len(window) + 1)
    best = 0.0
    for w in item:
        step = np.maximum(score[:-1] + np.where(window == w, 1.0, -miss), np.maximum(score[1:] - gap, 0))
        score[1:] = np.maximum.accumulate(step + slope) - slope
        best = max(best, float(score.max()))
    return best


def _spots(items: Items, order: np.ndarray, cuts: np.ndarray, row: np.ndarray, at: np.ndarray, no: np.ndarray):
    """(row, item, begins) of every pair that shares a seed, by row and item;
    begins are the places where the item would start.  Hits are expanded a
    bounded number at a time, whole rows together."""
    n = cuts[no + 1] - cuts[no]
    upto = np.concatenate([[0], np.cumsum(n)])
    ends = np.append(np.flatnonzero(row[1:] != row[:-1]) + 1, len(row)) if len(row) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(row):
        hi = int(ends[max(np.searchsorted(upto[ends], upto[lo] + SPOTS, "right") - 1, np.searchsorted(ends, lo, "right"))])
        m = n[lo:hi]
        own = order[np.arange(int(m.sum())) + np.repeat(cuts[no[lo:hi]] - (upto[lo:hi] - upto[lo]), m)]
        r, i, begin = np.repeat(row[lo:hi], m), items.item[own], np.repeat(at[lo:hi], m) - items.place[own]
        by = np.lexsort((begin, i, r))
        r, i, begin = r[by], i[by], begin[by]
        starts = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (i[1:] != i[:-1])))
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(r)]):
            yield int(r[a]), int(i[a]), begin[a:z].tolist()
        lo = hi


def _short(items: Items, n: int) -> list[tuple[_Finder, np.ndarray]]:
    """For every length under n: a finder of whole sequences and, by gram
    number, the items of that length (their numbers)."""
    out = []
    for k in range(1, n):
        of = [i for i, s in enumerate(items.words) if len(s) == k]
        if of:
            grams = np.array([gram_hashes(items.words[i], k)[0] for i in of], np.uint64)
            names, owner = np.unique(grams, return_inverse=True)
            out.append((_Finder(Items([], [], names, owner, owner, owner), k), [np.array(of)[owner == g].tolist() for g in range(len(names))]))
    return out


def _search(sent, n: int, threshold: float, where: int, schema: pa.Schema):
    """Adds a block's findings to the last three columns."""
    def run(batches):
        items: Items = sent.value
        find, whole = _Finder(items, n), _short(items, n)
        order = np.argsort(items.owner, kind="stable")
        cuts = np.searchsorted(items.owner[order], np.arange(len(items.grams) + 1))
        for batch in batches:
            *columns, count, name, best = batch.columns
            count, name, best = count.to_numpy().copy(), name.to_pylist(), best.to_numpy().copy()
            for lo, hi, h, bounds in _words(batch.column(where)):
                for short, of in whole:
                    row, _, no = short(h, bounds)
                    for r, g in sorted(set(zip(row.tolist(), no.tolist()))):
                        count[lo + r] += len(of[g])
                        if best[lo + r] < 1:
                            best[lo + r], name[lo + r] = 1.0, items.ids[of[g][0]]
                row, at, no = find(h, bounds)
                for r, i, begins in _spots(items, order, cuts, row, at, no):
                    score = _best(items.words[i], h, begins, bounds[r], bounds[r + 1], threshold)
                    if score >= threshold:
                        count[lo + r] += 1
                        if score > best[lo + r]:
                            best[lo + r], name[lo + r] = score, items.ids[i]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count), pa.array(name, schema.field("item_id").type), pa.array(best)],
                                             schema=schema)
    return run


def _best(item: np.ndarray, h: np.ndarray, begins: list[int], first: int, last: int, threshold: float) -> float:
    """Best score over the passages that the seeds point at, merged where
    they overlap; a passage with too few of the item's words is not aligned."""
    size, best = len(item), 0.0
    slack = size // 2 + 2
    spans: list[list[int]] = []
    for b in sorted(set(begins)):
        a, z = max(first, b - slack), min(last, b + size + slack)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], z)
        else:
            spans.append([a, z])
    for a, z in spans:
        window = h[a:z]
        if np.isin(item, window).sum() >= threshold * size:
            best = max(best, align(item, window) / size)
    return best


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, n: int = 3, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, columns of ``keep``, leaked, n_items
    (test items found), item_id (the best; the first of equals), score.

    Null or empty texts hold nothing, and items without a word match nothing;
    items of fewer than ``n`` words match where their whole sequence stands;
    repeated rows of either table are judged alike, and repeated items count
    once; an empty benchmark leaves every document clean."""
    from pyspark.sql.pandas.types import to_arrow_schema
    sc = docs.sparkSession.sparkContext
    items = (benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL").distinct())
    parts = 1 + 2 * (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    kept = [id_col, *keep]
    # findings gather in three columns that every block of items passes on
    found = docs.select(*kept, *([] if text_col in kept else [text_col]), F.lit(0).alias("n_items"),
                        F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("score"))
    where = found.columns.index(text_col)
    for b in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == b).orderBy("item_id", "text").collect()
        for some in _bounded(rows):
            block = Items.of([r["item_id"] for r in some], [r["text"] for r in some], n)
            found = found.mapInArrow(_search(sc.broadcast(block), n, threshold, where, to_arrow_schema(found.schema)), found.schema)
    return found.select(*kept, (F.col("n_items") > 0).alias("leaked"), "n_items", "item_id", "score")


def _bounded(rows: list):
    """Runs of rows of ``BLOCK_BYTES`` of text at most, one row at least."""
    some, size = [], 0
    for r in rows:
        n = len(r["text"].encode())
        if some and size + n > BLOCK_BYTES:
            yield some
            some, size = [], 0
        some.append(r)
        size += n
    if some:
        yield some
