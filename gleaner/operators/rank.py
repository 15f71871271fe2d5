"""Scoring and ordering.

The weight lookup is an ordered match (substring of the domain, or label
equality; first entry wins).  The weight map is job configuration: it is
held as one constant array and searched in place, whatever its size; no
join, no shuffle.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import cached, col
from ..functions.url import domain as url_domain
from ..spec import RankingSpec, as_of_date
from .patterns import INLINE, first_match

SIGNAL_BONUS_CAP = 0.3          # fixed: cap of the detail-signal bonus


def with_source_weight(df: DataFrame, entries: list[tuple[str, float]]) -> DataFrame:
    """Add ``weight``: of the first (pattern, weight) entry whose pattern is a
    substring of the URL's domain or equals the source label (any case);
    default 1.0."""
    table = F.from_json(F.lit(json.dumps([{"p": p, "l": p.lower(), "w": float(w)} for p, w in entries])),
                        "array<struct<p:string,l:string,w:double>>")
    named = df.withColumn("_dom", url_domain("url")).withColumn("_src", F.lower("source"))
    if len(entries) > INLINE:
        # least place of a pattern in the domain and of a label that is the source
        label = F.nullif(F.array_position(F.transform(table, lambda e: e["l"]), F.col("_src")), F.lit(0)) - 1
        place = F.least(first_match(F.col("_dom"), [p for p, _ in entries]), label.cast("int"))
        return named.withColumn("weight", F.coalesce(F.get(table, place)["w"], F.lit(1.0))).drop("_dom", "_src")
    hit = F.get(F.filter(table, lambda e: (F.instr(F.col("_dom"), e["p"]) > 0) | F.coalesce(F.col("_src") == e["l"], F.lit(False))), 0)
    return named.withColumn("weight", F.coalesce(hit["w"], F.lit(1.0))).drop("_dom", "_src")


@cached
def freshness(publish_date: Column | str, as_of: dt.datetime | dt.date) -> Column:
    """Age in whole days from publish date: <=1 -> 0.3, <=3 -> 0.15, else 0
    (future dates count as fresh; NULL -> 0)."""
    age = F.datediff(F.lit(as_of_date(as_of)), col(publish_date))
    return (F.when(age.isNull(), F.lit(0.0)).when(age <= 1, F.lit(0.3))
            .when(age <= 3, F.lit(0.15)).otherwise(F.lit(0.0)))


def multi_source_counts(df: DataFrame, stage: str = "post_dedup") -> DataFrame:
    """Per url_hash: rows (post_dedup, as the ranker counts) or distinct
    sources (pre_dedup).  Partial aggregation keeps hot hashes cheap."""
    if stage == "pre_dedup":
        return df.groupBy("url_hash").agg(F.countDistinct("source").alias("n_sources"))
    return df.groupBy("url_hash").agg(F.count(F.lit(1)).alias("n_sources"))


def score(df: DataFrame, spec: RankingSpec, entries: list[tuple[str, float]],
          as_of: dt.datetime | dt.date, multi: Column | None = None) -> DataFrame:
    """score = weight + min(bonus * n_signals, cap) + multi-source bonus +
    freshness, rounded to 3 places.

    ``multi`` is a boolean Column (several rows share the hash).  On
    survivors of the in-run dedup every hash is unique, so the default is
    False without counting."""
    out = with_source_weight(df, entries)
    m = multi if multi is not None else F.lit(False)
    s = (F.col("weight")
         + F.least(F.lit(spec.detail_signal_bonus) * F.size("signals"), F.lit(SIGNAL_BONUS_CAP))
         + F.when(m, F.lit(spec.multi_source_bonus)).otherwise(F.lit(0.0))
         + freshness("publish_date", as_of))
    return out.withColumn("score", F.round(s, 3))


def order_cols() -> list[Column]:
    """Rank order: score desc, publish date desc, then input order."""
    return [F.col("score").desc(), F.col("publish_date").desc_nulls_last(),
            F.col("source_ord").asc(), F.col("item_ord").asc()]


def order_items(df: DataFrame) -> DataFrame:
    """Score desc, date desc, ties in input order (range-partitioned sort)."""
    return df.orderBy(*order_cols())


def top_items(df: DataFrame, n: int = 5) -> DataFrame:
    """First n in rank order (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(*order_cols()).limit(n)
