"""Document fingerprints from content-defined chunks.

A gear hash runs over the UTF-8 bytes; a chunk ends where its leading bits
are zero.  Chunking is normalised: more zero bits are asked for before the
normal size than after it, within a least and a largest size, so sizes stay
close to normal.  A boundary depends on the 64 bytes before it, so an edit
disturbs only the chunks around it and later ones fall into step again.

The fingerprint is the set of chunk digests, each with its chunk's length;
the likeness of A to B is the length-weighted share of A's chunks that B
holds (containment).

Each document is compared with its edited text and with the next document in
descending id, so neighbours must meet: ids are cut at approximate
percentiles into buckets, the first document of every bucket is also sent to
the bucket that ends before it, and each bucket is sorted and streamed.  One
exchange of the texts; only bucket bounds and first ids reach the driver.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width
from .textbuf import mix64

#: Bytes of a chunk: least, normal, largest; bits asked for before and after the normal size.
LEAST, NORMAL, LARGEST = 16, 64, 512
HARD, EASY = 7, 5
_GEAR = mix64(np.arange(1, 257, dtype=np.uint64))
_RUN = 1 << 20
_MOST_BUCKETS = 4096


def cut_points(data: bytes) -> tuple[list[int], list[int]]:
    """Positions after which a chunk may end: by the hard and the easy rule."""
    hard, easy = [], []
    raw = np.frombuffer(data, np.uint8)
    for lo in range(0, len(raw), _RUN):
        back = min(lo, 63)                               # the hash looks at 64 bytes
        h = _GEAR[raw[lo - back:lo + _RUN]]
        for k in (1, 2, 4, 8, 16, 32):                   # sums over 2, 4, ... 64 bytes
            longer = h.copy()
            longer[k:] += h[:-k] << np.uint64(k)
            h = longer
        at = np.flatnonzero(h[back:] >> np.uint64(64 - EASY) == 0)
        easy += (at + lo + 1).tolist()
        hard += (at[h[back:][at] >> np.uint64(64 - HARD) == 0] + lo + 1).tolist()
    return hard, easy


def chunks(data: bytes) -> list[tuple[int, int]]:
    """(start, end) of the chunks, in order."""
    hard, easy = cut_points(data)
    out, start, n, i, j = [], 0, len(data), 0, 0
    while n - start > LEAST:
        i = bisect_left(hard, start + LEAST, i)
        if i < len(hard) and hard[i] < start + NORMAL:
            end = hard[i]
        else:
            j = bisect_left(easy, start + NORMAL, j)
            end = min(easy[j] if j < len(easy) else n, start + LARGEST, n)
        out.append((start, end))
        start = end
    if start < n:
        out.append((start, n))
    return out


def fingerprint(text: str) -> dict[str, int]:
    """chunk digest -> chunk length."""
    data = text.encode("utf-8", "surrogatepass")
    return {f"{xxhash.xxh3_64_intdigest(data[a:b]) >> 24:010x}{b - a:03x}": b - a for a, b in chunks(data)}


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of a's chunk bytes that b holds; two empty texts are alike."""
    if not a:
        return 0.0 if b else 1.0
    return sum(n for k, n in a.items() if k in b) / sum(a.values())


def edited(text: str, other: str) -> str:
    m = len(text) // 3
    return text[:len(text) - m] + other[:m]


def _stream(schema: pa.Schema):
    def run(batches):
        held, rows, size = None, [], 0
        for batch in batches:
            for id_, text, bucket, ahead in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if ahead and (held is None or held[2] != bucket):
                    continue
                text = text or ""
                now = (id_, text, bucket, fingerprint(text))
                if held is not None and held[2] == bucket:
                    rows.append(_row(held, now))
                    size += len(rows[-1][3]) + len(rows[-1][4])
                held = None if ahead else now
            if size > 4 << 20 or len(rows) > 5000:
                yield _batch(rows, schema)
                rows, size = [], 0
        if rows:
            yield _batch(rows, schema)
    return run


def _row(doc, following) -> tuple:
    id_, text, _, print_ = doc
    new = edited(text, following[1])
    changed = print_ if new == text else fingerprint(new)
    return (id_, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), "".join(sorted(print_)),
            "".join(sorted(changed)), containment(print_, changed), containment(print_, following[3]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (digests of 10 and lengths of 3 hexadecimal digits,
    sorted and joined), near_edited, near_next.

    The edited text is the text with its last third (rounded down) replaced by
    the first as many characters, or all, of the next document in descending
    id; the last is followed by the first, a single document by itself.  Null
    text is empty; null ids come last; rows that repeat an id are ordered by
    text; an empty table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    width = min(_MOST_BUCKETS, 2 * shuffle_width(docs.sparkSession))
    marks = [(i + 1) / width for i in range(width - 1)] or [0.5]
    cuts = sorted(set(rows.where("id IS NOT NULL").agg(F.percentile_approx("id", marks, 100 * width).alias("q")).first()["q"] or []))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    placed = rows.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(above))
    first = {r["bucket"]: r["id"] for r in placed.groupBy("bucket").agg(F.max("id").alias("id")).collect()}
    order = sorted(first, reverse=True)
    # the bucket before in descending order reads this bucket's first document ahead
    before = {b: order[i - 1] for i, b in enumerate(order)}
    target = F.lit(None).cast("int")
    if order:
        pairs = F.create_map(*[F.lit(x) for b in order if first[b] is not None for x in (first[b], before[b])]) \
            if any(v is not None for v in first.values()) else None
        target = F.when(F.col("id").isNull(), F.lit(before.get(-1, -1)))
        if pairs is not None:
            target = target.otherwise(pairs[F.col("id")])
    copies = F.when(target.isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ahead")))) \
        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ahead")), F.struct(target.cast("int").alias("b"), F.lit(1).alias("ahead"))))
    dealt = (placed.select("id", "text", F.explode(copies).alias("c")).select("id", "text", F.col("c.b").alias("bucket"), F.col("c.ahead").alias("ahead"))
             .repartition("bucket").sortWithinPartitions("bucket", "ahead", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first()))
    schema = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    out = dealt.mapInArrow(_stream(schema), "id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                   "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
