"""How far the sources of a language diverge in their use of terms, exactly.

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased.
A language keeps its V terms found in at least ``least_docs`` of its
documents.  A (lang, source) group, and the language, gives a kept term of
``count`` occurrences there the share p = 1 + floor(10^9 (count + 1) / (N + V)),
N its occurrences of kept terms; two shares are priced
f(p, q) = floor((p - q)^2 / q).

The sum of f over all kept terms for two groups depends only on how many
terms have count level a in the one and b in the other: their joint table.
With a one-hot column for every (group, level), the matrix of kept terms by
columns, multiplied by its transpose, holds all joint tables of a language at
once.  The product is taken in blocks of terms (rows) and tiles of groups
(columns), the matrix sparse: level 0 has no column, its cells follow from
the column sums and the number of terms.  Every block prices its part of the
tables; whole numbers add up, so the order of blocks does not matter.

Plan: texts become (lang, source, term, n, docs) inside an Arrow pass (one
dictionary a slice), partial sums before one shuffle; the kept entries (a
row per group and term) are all that later steps see.  A block of a tile
pair holds about ``BLOCK`` entries however large the input; a group of a
third of all rows is no more than its share of the vocabulary.  No step
gathers a language, a group or a vocabulary in one task or in the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .textbuf import slices, words

UNIT = 1_000_000_000
#: Entries a block (about), groups a tile (about), term pairs expanded at once.
BLOCK, TILE, PAIRS = 1 << 17, 256, 1 << 21
_SLICE = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BETWEEN = np.ones(256, bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = False
_BETWEEN[128:] = False
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term of every group in a slice,
    and a row without a term for every group."""
    for batch in batches:
        lang, source = (pc.fill_null(batch.column(i), "").dictionary_encode() for i in (0, 1))
        wide = len(source.dictionary)
        groups, group = np.unique(lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy(), return_inverse=True)
        names = [lang.dictionary.take(pa.array(groups // wide)), source.dictionary.take(pa.array(groups % wide))] if len(groups) else [pa.array([], pa.string())] * 2
        zero = pa.array(np.zeros(len(groups), np.int64))
        yield pa.RecordBatch.from_arrays([*names, pa.nulls(len(groups), pa.string()), zero, zero], schema=_COUNTS)
        for lo, hi, data, offs in slices(batch.column(2), _SLICE):
            starts, ends, bounds = words(data, offs, _BETWEEN)
            if not len(starts):
                continue
            at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            letters = _LOWER[data[~_BETWEEN[data]]]
            coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters)).dictionary_encode()
            v = len(coded.dictionary)
            of_doc, n = np.unique(np.repeat(np.arange(hi - lo), np.diff(bounds)) * v + coded.indices.to_numpy(), return_counts=True)
            key, where = np.unique(group[lo:hi][of_doc // v] * v + of_doc % v, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, where, n)
            held = pa.array(key // v)
            yield pa.RecordBatch.from_arrays([names[0].take(held), names[1].take(held), coded.dictionary.take(pa.array(key % v)).cast(pa.string()),
                                              pa.array(total), pa.array(np.bincount(where, minlength=len(key)))], schema=_COUNTS)


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / whole) by long division in base 1000:
    exact while whole is under 9 x 10^15."""
    rest, out = count + 1, np.zeros(np.broadcast(count, whole).shape, np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _share(count: str, whole: str) -> str:
    """``shares`` in SQL."""
    rest, digits = f"({count} + 1)", []
    for _ in range(3):
        digits.append(f"({rest} * 1000L) div {whole}")
        rest = f"(({rest} * 1000L) % {whole})"
    return "(1 + ({0}) * 1000000 + ({1}) * 1000 + {2})".format(*digits)


def _price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Side:
    """The one-hot columns of a tile's groups within a block of terms."""

    def __init__(self, source: np.ndarray, term: np.ndarray, level: np.ndarray, total: np.ndarray, members: np.ndarray, v: int):
        order = np.argsort(term, kind="stable")
        self.members, self.term = members, term[order]
        key, column, self.height = np.unique(np.stack([source[order], level[order]]), axis=1, return_inverse=True, return_counts=True)
        self.column = column.ravel()
        self.source, self.p = key[0], shares(key[1], np.maximum(total[key[0]] + v, 1))
        self.zero = shares(np.zeros(len(total), np.int64), np.maximum(total + v, 1))


def _joint(a: _Side, b: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The product of a's columns, transposed, with b's: (column of a, column
    of b, terms that have both), only cells above zero.  A term with x
    columns in a and y in b adds x times y ones."""
    lo, hi = np.searchsorted(b.term, a.term, "left"), np.searchsorted(b.term, a.term, "right")
    upto = np.concatenate([[0], np.cumsum(hi - lo)])
    wide, keys, cells, i = max(len(b.height), 1), [], [], 0
    while i < len(a.term):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + PAIRS, "right")) - 1)
        n = (hi - lo)[i:j]
        other = np.arange(upto[j] - upto[i]) + np.repeat(lo[i:j] - (upto[i:j] - upto[i]), n)
        key, cell = np.unique(np.repeat(a.column[i:j], n) * wide + b.column[other], return_counts=True)
        keys.append(key)
        cells.append(cell)
        i = j
    key, where = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.zeros(0, np.int64),) * 2
    total = np.zeros(len(key), np.int64)
    if keys:
        np.add.at(total, where, np.concatenate(cells))
    return key // wide, key % wide, total


def _value(a: _Side, b: _Side, joint: tuple[np.ndarray, np.ndarray, np.ndarray], terms: int) -> np.ndarray:
    """Sums of f(share in s, share in t) over the block's terms, for the
    groups s of a and t of b.  Cells with a zero level are the column sums
    less what the product has; their corrections are exact in 64 bits."""
    ca, cb, n = joint
    row, col = np.full(len(a.zero), -1), np.full(len(b.zero), -1)
    row[a.members], col[b.members] = np.arange(len(a.members)), np.arange(len(b.members))
    p0, q0 = a.zero[a.members], b.zero[b.members]
    none = _price(p0[:, None], q0[None, :])
    out = terms * none
    for at in range(0, len(a.p), 4096):                      # columns of a against level 0 of b
        some = slice(at, at + 4096)
        np.add.at(out, row[a.source[some]], a.height[some, None] * (_price(a.p[some, None], q0[None, :]) - none[row[a.source[some]]]))
    for at in range(0, len(b.p), 4096):
        some = slice(at, at + 4096)
        np.add.at(out.T, col[b.source[some]], b.height[some, None] * (_price(p0[None, :], b.p[some, None]) - none.T[col[b.source[some]]]))
    s, t = a.source[ca], b.source[cb]
    both = _price(a.p[ca], b.p[cb]) - _price(a.p[ca], b.zero[t]) - _price(a.zero[s], b.p[cb]) + none[row[s], col[t]]
    np.add.at(out, (row[s], col[t]), n * both)
    return out


def _product(key, groups: pa.Table, entries: pa.Table) -> pa.Table:
    """Values of all pairs of groups of two tiles over one block of terms."""
    lang, _, left, right = (k.as_py() for k in key)
    names = groups.column("source").combine_chunks()
    tile, total = groups.column("tile").to_numpy(), groups.column("total").to_numpy()
    v, terms = groups.column("v")[0].as_py(), groups.column("terms")[0].as_py()
    source = pc.index_in(entries.column("source"), names).to_numpy().astype(np.int64)
    term = pa.chunked_array(entries.column("term").chunks, pa.string()).combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    level = entries.column("n").to_numpy()

    def side(k: int) -> _Side:
        mine = tile[source] == k
        return _Side(source[mine], term[mine], level[mine], total, np.flatnonzero(tile == k), v)

    a = side(left)
    b = a if left == right else side(right)
    joint = _joint(a, b)
    found = [(a.members, b.members, _value(a, b, joint, terms))]
    if left != right:
        found.append((b.members, a.members, _value(b, a, (joint[1], joint[0], joint[2]), terms)))
    s = np.concatenate([np.repeat(x, len(y)) for x, y, _ in found])
    t = np.concatenate([np.tile(y, len(x)) for x, y, _ in found])
    value = np.concatenate([w.ravel() for _, _, w in found])
    keep = s != t
    return pa.table({"lang": pa.array([lang] * int(keep.sum()), pa.string()), "source": names.take(pa.array(s[keep])),
                     "item": names.take(pa.array(t[keep])), "value": pa.array(value[keep])})


def _pairs(groups: DataFrame, langs: DataFrame, kept: DataFrame, entries: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of groups of a
    language: blocked product, priced where it is made."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    shape = langs.select("lang", "v", "blocks", "tiles")
    terms = kept.join(shape, "lang").groupBy("lang", block.alias("block")).agg(F.count(F.lit(1)).alias("terms"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))

    def tiled(rows: DataFrame, *cols: str) -> DataFrame:
        return (rows.withColumn("tile", tile).withColumn("other", other)
                .select("lang", "block", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"), "tile", *cols))

    spread = groups.join(shape, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    left = tiled(spread.join(terms, ["lang", "block"], "left").withColumn("terms", F.coalesce("terms", F.lit(0))), "source", "total", "v", "terms")
    right = tiled(entries.join(shape, "lang").withColumn("block", block), "source", "term", "n")
    key = ["lang", "block", "ti", "tj"]
    return (left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_product, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, *, least_docs: int = 3, top: int = 200, block: int = BLOCK, tile: int = TILE, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group.

    Part ``pair``: each other source of the language, its distance from the
    group summed over all kept terms, all ranks.  Part ``term``: the kept
    terms that the group uses more than its language, ranks to ``top``.  Ranks
    go by value descending, then item ascending in UTF-8.

    Null text, language and source count as ''.  A document is a row (repeated
    ids are documents of their own).  A group without terms is compared like
    any other (count 0 everywhere); a language that keeps no term has pairs of
    value 0 and no term rows; the only source of a language has no pairs; an
    empty table gives an empty result."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    counts = materialise(src.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
                         .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts")
    used = counts.where("term IS NOT NULL")
    kept = materialise(used.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs"))
                       .where(F.col("docs") >= least_docs).select("lang", "term", "whole"), "audit-kept")
    entries = materialise(used.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole"), "audit-entries")

    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("entries"))
    groups = materialise(counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left")
                         .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("entries", F.lit(0)).alias("entries")), "audit-groups")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    langs = (groups.groupBy("lang").agg(F.sum("total").alias("whole_total"), F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("sources"))
             .join(vocabulary, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0)))
             .withColumn("tiles", F.ceil(F.col("sources") / tile).cast("long"))
             # a tile pair sees two tiles' entries of a block
             .withColumn("blocks", F.ceil(F.greatest(F.col("entries") * F.least(F.col("tiles"), F.lit(2)) / F.col("tiles"), F.lit(1)) / block).cast("long")))
    langs = materialise(langs, "audit-langs")

    pairs = _pairs(groups.select("lang", "source", "total"), langs, kept, entries).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    known = groups.select("lang", "source", "total").join(langs.select("lang", "v", "whole_total"), "lang")
    both = (entries.join(known, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), F.expr(_share("n", "(total + v)")).alias("p"), F.expr(_share("whole", "(whole_total + v)")).alias("q"))
            .where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)


#: DuckDB twin of ``audit`` with its defaults, over the view ``documents``.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(whole) AS whole_total FROM kept GROUP BY lang),
a AS (SELECT g.lang, g.source, kept.term, kept.whole, coalesce(c.n, 0) AS n
      FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT lang, source, sum(n) AS total FROM a GROUP BY ALL),
p AS (SELECT a.lang, a.source, a.term, a.n, 1 + (1000000000::HUGEINT * (a.n + 1)) // (s.total + v.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (a.whole + 1)) // (v.whole_total + v.v)::HUGEINT AS q
      FROM a JOIN s USING (lang, source) JOIN v USING (lang)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= 200
"""
