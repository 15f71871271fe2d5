"""Jaccard self-join of documents on word shingles by vertical partitioning.

Documents are sets of distinct 5-word shingles (64-bit hashes).  All
shingles are put in one global order, rare before frequent, so that:

* a document in which more than a fifth of the shingles occur nowhere else
  cannot reach 0.8 with any other; it is done after the counting step;
* two linked documents share a shingle within their first
  n - ceil(0.8 n) + 1 (prefix), and the positions of the first one they share
  bound what they can have in common (length and position filters);
* the order is cut into fragments of about equal weight.  A candidate pair's
  common shingles are counted fragment by fragment and the partial overlaps
  summed per pair; the sum decides 100 x intersection >= 80 x union exactly.

Counting without shuffling shingles with document ids: documents are dealt
into blocks by a hash of their id; a block sends each of its distinct
shingles once (48 leading bits, sorted, differences in byte planes, about
four bytes each) to a hash range, with the number of its documents that
hold it; the range sums the blocks' counts and answers each block with one
byte a shingle.  A shingle of a third of all documents is one entry a block.

Equal sets form classes first (by n and a 128-bit digest), so copies are
joined once; a class, not an id, is what is joined.  Sets that agree in all
shingles that anyone shares have a core in common: the smallest of them
stands for those it links with, because whatever they link with links with
it too.  Candidates within a long posting list are tested by pivots, those
with the fewest shingles of their own first, and what is left by bitmaps of
the shared shingles before it becomes pairs (see ``linking``): components
are exact, groups of copies never make all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_width
from .linking import connect
from .textbuf import gram_hashes, mix64, short_hash, slices, word_hashes, words

FRAGMENTS = 8
#: Longs in a bitmap of a set's shared shingles.
MAP_LONGS = 16
_CELL_BITS = 3
_OTHER = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(col: pa.Array, k: int):
    """The sorted distinct shingle hashes of every row."""
    for lo, hi, data, offs in slices(col):
        starts, ends, bounds = words(data, offs)
        h = word_hashes(data, starts, ends)
        grams = gram_hashes(h, k)
        for i in range(hi - lo):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            else:
                yield np.array([short_hash(h[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64)


def pack(sorted_values: np.ndarray) -> bytes:
    """Ascending integers as differences, in planes of equal bytes."""
    if not len(sorted_values):
        return b""
    gap = np.diff(sorted_values, prepend=np.uint64(0)).astype("<u8")
    width = (int(gap.max()).bit_length() + 7) // 8 or 1
    return bytes([width]) + gap.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    gap = np.zeros((planes.shape[1], 8), np.uint8)
    gap[:, :width] = planes.T
    return np.cumsum(gap.view("<u8").ravel(), dtype=np.uint64)


def _key(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(16)


def _block_keys(table: pa.Table, k: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    sets = [s for chunk in table.column("text").chunks for s in shingle_sets(chunk, k)]
    keys, n = np.unique(np.concatenate([_key(s) for s in sets]) if sets else np.zeros(0, np.uint64), return_counts=True)
    return sets, keys, n


def _ask(k: int, ranges: int):
    """A block's distinct shingles, by hash range."""
    def run(table: pa.Table) -> pa.Table:
        _, keys, n = _block_keys(table, k)
        place = ((keys >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(cuts))
        block = table.column("block")[0].as_py()
        return pa.table({"part": pa.array(used, pa.int64()), "block": pa.array([block] * len(used), pa.int64()),
                         "keys": pa.array([pack(keys[cuts[r]:cuts[r + 1]]) for r in used], pa.binary()),
                         "n": pa.array([n[cuts[r]:cuts[r + 1]].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                                        for r in used], pa.binary())})
    return run


def _answer(table: pa.Table) -> pa.Table:
    """The class of every asked shingle: 0 if one document holds it, else
    the bit length of the number that do."""
    asked = [unpack(b) for b in table.column("keys").to_pylist()]
    n = [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel() for b in table.column("n").to_pylist()]
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(at, np.concatenate(n), len(keys)).astype(np.int64)
    rank = np.where(total < 2, 0, np.frexp(total.astype(float))[1]).astype(np.uint8)[at]
    cuts = np.cumsum([0, *map(len, asked)])
    return pa.table({"block": table.column("block"), "part": table.column("part"),
                     "ranks": pa.array([rank[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _judge(k: int, percent: int):
    """Documents of a block, with their shared shingles in global order where
    enough are shared."""
    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        sets, keys, _ = _block_keys(docs, k)
        answers = answers.sort_by("part")
        ranks = np.frombuffer(b"".join(answers.column("ranks").to_pylist()), np.uint8)
        out = {"n": [], "d1": [], "d2": [], "c1": [], "c2": [], "tokens": [], "ranks": []}
        for s in sets:
            n = len(s)
            rank = ranks[np.searchsorted(keys, _key(s))] if n else np.zeros(0, np.uint8)
            alive = n and 100 * int((rank > 0).sum()) >= percent * n
            out["n"].append(n)
            for name, part in (("d", s), ("c", s[rank > 0])):
                for i, salt in (("1", np.uint64(0)), ("2", _OTHER)):
                    out[name + i].append(int(mix64(part ^ salt).sum(dtype=np.uint64).view(np.int64)) if alive else None)
            if alive:
                order = np.lexsort((s, rank))[n - int((rank > 0).sum()):]
                out["tokens"].append(s[order].view(np.int64))
                out["ranks"].append(rank[order].tobytes())
            else:
                out["tokens"].append(None)
                out["ranks"].append(None)
        return pa.table({"id": docs.column("id"), "tag": docs.column("tag"), "n": pa.array(out["n"], pa.int64()), **{c: pa.array(out[c], pa.int64()) for c in ("d1", "d2", "c1", "c2")},
                         "tokens": pa.array(out["tokens"], pa.list_(pa.int64())),
                         "ranks": pa.array(out["ranks"], pa.binary())})
    return run


def _cells(ranks: bytes, tokens: np.ndarray) -> np.ndarray:
    """Coarse place in the global order: rarity class, then leading hash bits."""
    return (np.frombuffer(ranks, np.uint8).astype(np.int64) << _CELL_BITS) | (tokens.view(np.uint64) >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _histogram(batches):
    total = np.zeros(65 << _CELL_BITS, np.int64)
    for batch in batches:
        for ranks, tokens in zip(batch.column(0).to_pylist(), batch.column(1)):
            total += np.bincount(_cells(ranks, tokens.values.to_numpy()), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["cell", "n"])


def _fragment(cuts: list[int]):
    def run(batches):
        for batch in batches:
            ids, frags, parts = [], [], []
            for id_, ranks, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                t = tokens.values.to_numpy()
                edge = [0, *np.searchsorted(_cells(ranks, t), cuts).tolist(), len(t)]
                for f, (a, b) in enumerate(zip(edge, edge[1:])):
                    if b > a:
                        ids.append(id_)
                        frags.append(f)
                        parts.append(t[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(frags, pa.int32()),
                                              pa.array(parts, pa.list_(pa.int64()))], names=["node", "frag", "tokens"])
    return run


def fragments_of(reps: DataFrame, count: int = FRAGMENTS) -> DataFrame:
    """(node, frag, tokens): every set's shingles cut at common bounds of
    the global order.  The bounds come from a histogram of at most 520 cells."""
    hist = sorted((r["cell"], r["n"]) for r in reps.select("ranks", "tokens").mapInArrow(_histogram, "cell int, n long")
                  .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    total, run, cuts = sum(n for _, n in hist), 0, []
    for cell, n in hist:
        if run * count >= total * (len(cuts) + 1) and len(cuts) < count - 1:
            cuts.append(cell)
        run += n
    return reps.select("node", "ranks", "tokens").mapInArrow(_fragment(cuts), "node long, frag int, tokens array<long>")


def _bitmaps(batches):
    """Bitmaps of the shared shingles: a bit that one set has and the other
    lacks is a shingle that the other lacks."""
    for batch in batches:
        maps = np.zeros((batch.num_rows, MAP_LONGS * 64), np.uint8)
        for i, tokens in enumerate(batch.column(1)):
            maps[i, (mix64(tokens.values.to_numpy().view(np.uint64)) >> np.uint64(32)) % np.uint64(MAP_LONGS * 64)] = 1
        longs = np.packbits(maps, axis=1).view("<i8")
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(longs[:, i]) for i in range(MAP_LONGS)]],
                                         names=["node", *[f"m{i}" for i in range(MAP_LONGS)]])


def _lacks(x: Column, y: Column) -> Column:
    """At least so many shared shingles of x are not in y."""
    return sum((F.bit_count(x[f"m{i}"].bitwiseAND(F.bitwise_not(y[f"m{i}"]))) for i in range(1, MAP_LONGS)),
               F.bit_count(x["m0"].bitwiseAND(F.bitwise_not(y["m0"]))))


def _least(n: Column, percent: int) -> Column:
    """ceil(percent * n / 100) in whole numbers."""
    return F.floor((n * percent + 99) / 100).cast("long")


def _need(both: Column, percent: int) -> Column:
    """The least intersection that links two sets of ``both`` shingles in all."""
    return F.floor((both * percent + 99 + percent) / (100 + percent)).cast("long")


def jaccard_components(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                       tag_col: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles (size of the distinct
    k-word shingle set of the whole text), component_id (smallest id
    reachable by links, itself included) and, if given, ``tag_col`` (a long
    that the caller knows the row by).

    Words are lower-cased in A-Z and split at space and 0x09-0x0D.  Texts of
    fewer than k words have their whole sequence as one shingle; null texts
    and texts without words have none and link with nothing.  Rows without an
    id get a null component.  Rows that repeat an id are judged by their own
    texts, each of which may link; groups are of texts, and a group's id is
    the least of all its rows.  Ties cannot occur; an empty table gives an
    empty result."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       (F.col(tag_col) if tag_col else F.lit(None)).cast("long").alias("tag"))
    judged = materialise(_judged(rows, k, percent), "jaccard-docs")
    alive = judged.where("d1 IS NOT NULL AND id IS NOT NULL")
    classes = materialise(alive.groupBy("n", "d1", "d2").agg(F.min("id").alias("id")).withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    sets = alive.join(classes, ["n", "d1", "d2", "id"]).dropDuplicates(["node"])
    sets = materialise(sets.select("node", "n", "c1", "c2", "tokens", "ranks"), "jaccard-sets")
    stands, reps = _cores(sets, percent)
    segments = materialise(fragments_of(reps), "jaccard-segments")

    single = F.col("n") - F.size("tokens")
    head = F.col("n") - _least(F.col("n"), percent) + 1 - single
    first = F.slice("tokens", F.lit(1), head.cast("int"))
    before = F.concat(F.array(F.lit(None).cast("long")), first)      # each token with the one before it in the set's order
    postings = (reps.where(head > 0).select("node", "n", single.alias("s"), F.posexplode(F.arrays_zip(first.alias("key"), before.alias("prev"))).alias("i", "t"))
                .where("t.key IS NOT NULL")
                .select("t.key", "node", F.struct("n", "s", (F.col("s") + F.col("i")).alias("pos"), "t.prev").alias("att")))

    def fits(x: Column, y: Column) -> Column:
        return ((F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent)
                & (F.least(x["n"] - x["pos"], y["n"] - y["pos"]) >= _need(x["n"] + y["n"], percent)))

    def alike(x: Column, y: Column, mx: Column, my: Column) -> Column:
        need = _need(x["n"] + y["n"], percent)
        return (x["s"] + _lacks(mx, my) <= x["n"] - need) & (y["s"] + _lacks(my, mx) <= y["n"] - need)

    def sketch(nodes: DataFrame) -> DataFrame:
        names = [f"m{i}" for i in range(MAP_LONGS)]
        maps = reps.join(nodes, "node", "left_semi").select("node", "tokens").mapInArrow(_bitmaps, "node long, " + ", ".join(f"{m} long" for m in names))
        return maps.select("node", F.struct(*names).alias("sketch"))

    def verify(pairs: DataFrame) -> DataFrame:
        left = segments.select(F.col("node").alias("a"), "frag", F.col("tokens").alias("ta"))
        right = segments.select(F.col("node").alias("b"), "frag", F.col("tokens").alias("tb"))
        size = reps.select("node", "n")
        partial = (pairs.join(left, "a").join(right, ["b", "frag"])
                   .select("a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common")))
        total = partial.groupBy("a", "b").agg(F.sum("common").alias("common"))
        return (total.join(size.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
                .join(size.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
                .where(F.col("common") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b"))

    # sets that share the token before, too, fit in its list as well: both stand earlier there
    roots = connect(postings, fits, verify, elsewhere=lambda x, y: F.coalesce(x["prev"] == y["prev"], F.lit(False)),
                    order=lambda att: att["pos"], sketch=sketch, alike=alike)
    # a set that another stands for is in that one's group
    groups = (classes.join(stands, "node", "left").withColumn("stand", F.coalesce("stand", "node"))
              .join(roots.withColumnRenamed("node", "stand"), "stand", "left").select("n", "d1", "d2", "id", F.coalesce("root", "stand").alias("root")))
    groups = materialise(groups, "jaccard-groups")
    named = materialise(groups.join(groups.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("n", "d1", "d2", "component_id"), "jaccard-named")
    out = judged.select("id", "n", "d1", "d2", "tag")
    linked = (out.where("d1 IS NOT NULL").join(named, ["n", "d1", "d2"])
              .select("id", "n", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"), "tag"))
    alone = out.where("d1 IS NULL").select("id", "n", F.col("id").alias("component_id"), "tag")
    return linked.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                      *([F.col("tag").alias(tag_col)] if tag_col else []))


def _cores(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(node, stand) of the sets that the smallest set of their core links
    with, and the other sets.  Two sets of one core share it and no more, so
    sizes decide."""
    core, size = ["c1", "c2", "core"], F.size("tokens").cast("long").alias("core")
    known = sets.select("node", "n", "c1", "c2", size)
    least = known.groupBy(*core).agg(F.min(F.struct("n", "node")).alias("least"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    stands = materialise(known.join(least, core).where((F.col("node") != F.col("least.node"))
                                                       & (F.col("core") * (100 + percent) >= (F.col("n") + F.col("least.n")) * percent))
                         .select("node", F.col("least.node").alias("stand")), "jaccard-stands")
    rest = sets.join(stands.select("node"), "node", "left_anti").select("node", "n", "tokens", "ranks")
    return stands, materialise(rest, "jaccard-reps")


def _judged(rows: DataFrame, k: int, percent: int) -> DataFrame:
    width = 2 * shuffle_width(rows.sparkSession)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(width)))
    asked = dealt.groupBy("block").applyInArrow(_ask(k, width), "part long, block long, keys binary, n binary")
    answers = asked.groupBy("part").applyInArrow(_answer, "block long, part long, ranks binary")
    return (dealt.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_judge(k, percent), "id long, tag long, n long, d1 long, d2 long, c1 long, c2 long, tokens array<long>, ranks binary"))
