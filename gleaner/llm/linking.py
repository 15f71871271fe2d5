"""Connected groups from posting lists without listing all pairs of a list.

Candidates are the pairs that share a posting key and fit together; links
are the candidates that a verifier confirms.  Only the connected components
of the links are asked for, so pairs whose ends are connected already need
no test, and lists that lie within one component are dropped at once:

1. Star rounds: every open list names a pivot, the member of least ``order``
   (the most central one), from the second round on outside the component
   that holds the least label; every node is paired with one of the pivots
   that its lists name.  A round costs a pair a node at most, however many
   lists a node is in.  A round without a link does not end the phase.
2. The cross round: in every list that is still open the members outside its
   largest component are paired with all members of other components.  Every
   pair that was not tested and might join two components is tested here, so
   the components are exactly those of all links.  ``sketch`` gives these few
   nodes a finer filter than postings can carry, so that members of a crowd
   that no link joins are told apart before they become pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, materialise

STAR_ROUNDS = 4


def connect(postings: DataFrame, fits: Callable, verify: Callable[[DataFrame], DataFrame], star_rounds: int = STAR_ROUNDS,
            elsewhere: Callable = lambda x, y: F.lit(False), order: Callable[[Column], Column] = lambda att: F.lit(0),
            sketch: Callable[[DataFrame], DataFrame] | None = None, alike: Callable = lambda x, y, sx, sy: F.lit(True)) -> DataFrame:
    """postings(key, node, att) -> (node, root) for linked nodes.

    fits(att1, att2) -> Column prunes candidates; verify(pairs(a, b)) ->
    links(a, b) decides them; elsewhere(att1, att2) -> Column may say that a
    pair surely fits in another list too, where the cross round meets it;
    order(att) -> Column is least for the members most likely to link with
    many.  sketch(nodes(node)) -> (node, sketch) and alike(att1, att2,
    sketch1, sketch2) -> Column prune the cross round further; they must
    admit every link."""
    held = postings.select("key", "node", "att", F.col("node").alias("label"))
    labels: DataFrame | None = None
    stored: list[DataFrame] = []  # open lists of the round before, and then the cross round's table
    for turn in range(star_rounds):
        held = _open(held, stored)
        if held.isEmpty():
            break
        found = _links(_star(held, turn, fits, order), verify)
        if not found.isEmpty():
            held, labels = _merge(held, labels, found)
    held = _open(held, stored)
    if not held.isEmpty():
        found = _links(_cross(held, fits, elsewhere, sketch, alike, stored), verify)
        if not found.isEmpty():
            held, labels = _merge(held, labels, found)
    for table in stored:
        discard(table)
    if labels is None:
        return postings.select("node", F.col("node").alias("root")).limit(0)
    return labels


def _open(held: DataFrame, stored: list[DataFrame]) -> DataFrame:
    """Postings of the lists that hold two components or more, with the
    least label of the list.  They replace the table in ``stored``."""
    lists = (held.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("key", "least"))
    held = materialise(held.select("key", "node", "att", "label").join(lists, "key"), "postings")
    while stored:
        discard(stored.pop())
    stored.append(held)
    return held


def _star(held: DataFrame, turn: int, fits: Callable, order: Callable) -> DataFrame:
    rank = F.struct(order(F.col("att")).alias("order"), F.xxhash64("node", F.lit(turn)).alias("h"), "node", "label", "att")
    who = held if turn == 0 else held.where("label <> least")
    pivots = who.groupBy("key").agg(F.min(rank).alias("pivot"))
    pair = held.join(pivots, "key").where((F.col("label") != F.col("pivot.label")) & fits(F.col("att"), F.col("pivot.att")))
    one = pair.groupBy("node", "label").agg(F.min(F.struct("pivot.order", "pivot.h", "pivot.node", "pivot.label")).alias("p"))
    return one.select("node", F.col("p.node").alias("other"), "label", F.col("p.label").alias("other_label"))


def _cross(held: DataFrame, fits: Callable, elsewhere: Callable, sketch: Callable | None, alike: Callable,
           stored: list[DataFrame]) -> DataFrame:
    if sketch is not None:
        held = held.join(sketch(held.select("node").distinct()), "node")
    else:
        held = held.withColumn("sketch", F.lit(None).cast("int"))
    size = held.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = size.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top")).select("key", F.col("top.label").alias("top"))
    some = materialise(held.drop("least").join(largest, "key"), "cross")
    stored.append(some)
    minor = some.where("label <> top").select("key", F.col("node").alias("other"), F.col("att").alias("other_att"),
                                              F.col("label").alias("other_label"), F.col("sketch").alias("other_sketch"))
    return (some.join(minor, "key")
            .where((F.col("label") != F.col("other_label")) & ((F.col("label") == F.col("top")) | (F.col("node") < F.col("other")))
                   & fits(F.col("att"), F.col("other_att")) & ~elsewhere(F.col("att"), F.col("other_att"))
                   & alike(F.col("att"), F.col("other_att"), F.col("sketch"), F.col("other_sketch")))
            .select("node", "other", "label", "other_label"))


def _links(pairs: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Confirmed pairs as (a, b, la, lb), a < b, la and lb their components."""
    swap = F.col("node") > F.col("other")
    pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"),
                         F.when(swap, F.col("other_label")).otherwise(F.col("label")).alias("la"),
                         F.when(swap, F.col("label")).otherwise(F.col("other_label")).alias("lb")).distinct()
    pairs = materialise(pairs, "pairs")
    return materialise(pairs.join(verify(pairs.select("a", "b")), ["a", "b"]).select("la", "lb"), "found")


def _merge(held: DataFrame, labels: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    roots = components(found.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("node").alias("label"), "root")
    held = held.join(roots, "label", "left").select("key", "node", "att", F.coalesce("root", "label").alias("label"))
    new = roots.select(F.col("label").alias("node"), "root")
    if labels is not None:
        old = labels.withColumnRenamed("root", "label").join(roots, "label", "left") \
            .select("node", F.coalesce("root", "label").alias("root"))
        new = materialise(old.union(new.join(labels.select("node"), "node", "left_anti")), "labels")
    return held, new
