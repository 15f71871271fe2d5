r"""Mixing sources to target weights without sorting documents.

Sources are weighed, their shares water-filled under a cap on repeats, and
each document is assigned how many of its words the mix takes:

* every whole pass a target holds takes each document of the source once;
* the rest of the budget takes the documents whose hash lies under the
  source's threshold.  The threshold is found by histograms: words summed by
  source and leading hash bits give the bucket in which the budget ends;
  only that bucket's documents are summed again by the next bits, and so on
  to the last bit.  No document is ever sorted.
* the document at the threshold gives the words that are still missing
  (rows with that very hash share them), so a source ends at its target.

Thresholds are nested: a larger budget takes a superset of documents.  Every
join is on (source, hash bucket), so a hot source is spread over its buckets.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Weights by position of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Bits of the 60-bit hash that each level of the histogram adds.
LEVELS = (12, 16, 16, 16)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def mix_hash(id_: Column, text: Column) -> Column:
    """60 leading bits of an MD5 over id and text."""
    key = F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """(source, source_size) -> the same with ``target``: shares of the whole
    size by weight, none above cap x its source's size, the excess reshared
    by weight until none is above.  One row per source; the windows run over
    that table alone.

    The common level L with sum(min(cap x size, L x weight)) = whole is found
    in one pass: in order of cap x size / weight, the first sources are full;
    the rest share what those leave."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_source) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("w", weight).withColumn("full", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy((F.col("full") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    t = (t.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
                      / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
         .withColumn("is_full", F.col("full") <= F.col("level") * F.col("w")))
    # the first source that is not full fixes the level of all after it
    level = F.min(F.when(~F.col("is_full"), F.struct((F.col("full") / F.col("w")).alias("o"), F.col("source").isNull().alias("z"),
                                                     F.col("source"), F.col("level").alias("l")))).over(whole)["l"]
    return (t.withColumn("common", level)
            .withColumn("target", F.when(F.col("common").isNull(), F.col("full"))
                        .otherwise(F.least(F.col("full"), F.col("common") * F.col("w"))))
            .select("source", "source_size", "target"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id_col``, size (words), source_size, target
    (its source's), taken (words the mix takes, repeats counted; at most
    cap x size).  Null text has size 0; null sources form a source of their
    own, last in order; rows that repeat id and text share a hash and are
    treated alike; an empty table gives an empty result."""
    return mixed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")),
                 weights, cap).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """``mix`` of (id, text, source), with the source and the hash ``h``."""
    top = LEVELS[0]
    total_bits = sum(LEVELS)
    rows = docs.select("id", "source", word_count(F.col("text")).alias("size"),
                       mix_hash(F.col("id"), F.col("text")).alias("h"))
    rows = materialise(rows.withColumn("b0", F.shiftright("h", total_bits - top)), "mix-rows")

    hist = materialise(rows.groupBy("source", "b0").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")), "mix-hist")
    targets = materialise(
        water_fill(hist.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("need", F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "mix-targets")

    # level 0 decides whole buckets; deeper levels only see the bucket in which the budget ends
    buckets = _cut(hist.withColumnRenamed("b0", "bucket"), targets)
    decided = materialise(buckets.select("source", F.col("bucket").alias("b0"), "source_size", "target", "passes", "state", "left"),
                          "mix-level")
    joined = rows.join(decided, (rows["source"].eqNullSafe(decided["source"])) & (rows["b0"] == decided["b0"]), "inner") \
        .drop(decided["source"]).drop(decided["b0"])
    joined = materialise(joined.drop("b0"), "mix-joined")
    done, open_, shift = [joined.where("state <> 0")], joined.where("state = 0"), total_bits - top
    for bits in LEVELS[1:]:
        shift -= bits
        open_ = open_.withColumn("bucket", F.shiftright("h", shift)).drop("state")
        sums = open_.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"),
                                                     F.max("left").alias("need"))
        level = materialise(_states(sums).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "state",
                                                 F.col("left").alias("l"), F.col("docs").alias("n")), "mix-level")
        open_ = materialise(open_.join(level, open_["source"].eqNullSafe(level["s"]) & (open_["bucket"] == level["b"]))
                            .drop("s", "b", "left", "bucket").withColumnRenamed("l", "left").withColumnRenamed("n", "ties"), "mix-open")
        if shift:
            done.append(open_.where("state <> 0").drop("ties"))
            open_ = open_.where("state = 0").drop("ties")
    last = F.when(F.col("state") == 0, F.least("size", F.floor(F.col("left") / F.col("ties")).cast("long")))
    out = open_.withColumn("part", last)
    for d in done:
        out = out.unionByName(d.withColumn("ties", F.lit(1).cast("long")).withColumn("part", F.lit(None).cast("long")))
    return out.select("id", "source", "h", "size", "source_size", "target",
                      (F.col("passes") * F.col("size")
                       + F.coalesce(F.col("part"), F.when(F.col("state") == 1, F.col("size")).otherwise(F.lit(0)))).cast("long").alias("taken"))


def _cut(hist: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.select(F.col("source").alias("s"), "source_size", "target", "passes", "need")
    return _states(hist.join(t, hist["source"].eqNullSafe(t["s"])).drop("s"))


def _states(sums: DataFrame) -> DataFrame:
    """state 1: the bucket is taken whole, 0: the budget ends in it, -1: not
    taken; left: what is missing before it.  A window row is a bucket."""
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (sums.withColumn("left", F.col("need") - before)
            .withColumn("state", F.when(F.col("left") >= F.col("words"), 1).when(F.col("left") > 0, 0).otherwise(-1)))


#: DuckDB twin of ``mix`` with its defaults, over the view ``documents``.
SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
              source_size * 3.0::DOUBLE AS fil FROM s0),
s2 AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS whole,
              coalesce(sum(fil) OVER (ORDER BY fil / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fb,
              sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY fil / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl
       FROM s1),
lv AS (SELECT min(lev) AS common FROM (
         SELECT (whole - fb) / wl AS lev, row_number() OVER (ORDER BY fil / w, source NULLS LAST) AS rn
         FROM s2 WHERE fil > (whole - fb) / wl * w) WHERE rn = 1),
t AS (SELECT source, source_size, CASE WHEN common IS NULL THEN fil ELSE least(fil, common * w) END AS target FROM s2, lv),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
c AS (SELECT d.*, p.source_size, p.target, p.passes,
             floor(p.target - p.passes * p.source_size)::BIGINT
               - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING), 0)
               + sum(d.size) OVER (PARTITION BY d.source, d.h) AS remains,
             sum(d.size) OVER (PARTITION BY d.source, d.h) AS tied, count(*) OVER (PARTITION BY d.source, d.h) AS ties
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (passes * size + CASE WHEN remains >= tied THEN size WHEN remains <= 0 THEN 0
                             ELSE least(size, remains // ties) END)::BIGINT AS taken
FROM c
"""
