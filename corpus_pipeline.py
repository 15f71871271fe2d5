"""The corpus pipeline: documents in, shards out.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame.  ``run``
writes every stage's result as Parquet to shared storage and reads it again
as the next stage's documents.  All stages but the last return the columns of
``documents``; the last returns each row's shard and place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, hilbert_shards, language_id, ngram_join, source_mix
from gleaner.llm.common import materialise
from gleaner.llm.queries import tokenizer_path


def _inner(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that no operator uses, and the names."""
    names = {c: f"kept__{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _outer(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(inner).alias(c) for c, inner in names.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; without text or any letter they
    are rejected (``und``).  If no labelled document teaches a language,
    nothing can be told and nothing is rejected."""
    model = language_id.train(docs, tokenizer_path())
    if not model.languages:
        return docs
    inner, names = _inner(docs)
    rest = tuple(inner for c, inner in names.items() if c != "doc_id")
    told = language_id.identify(inner, model, id_col=names["doc_id"], text_col=names["text"], keep=rest)
    return _outer(told.where("lang_pred <> 'und'"), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by shingle
    Jaccard of 0.8 or more.  Rows without an id are kept; rows that repeat an
    id are judged by their own texts."""
    tagged = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    found = ngram_join.jaccard_components(tagged, tag_col="tag")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id"), F.col("tag").alias("gone_tag")).distinct()
    inner, names = _inner(docs)
    same = (F.col(names["doc_id"]) == F.col("gone_id")) & (F.xxhash64(names["text"]) == F.col("gone_tag"))
    return _outer(inner.join(gone, same, "left_anti"), names)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, verbatim or edited."""
    inner, names = _inner(docs)
    rest = tuple(inner for c, inner in names.items() if c != "doc_id")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.decontaminate(inner, items, id_col=names["doc_id"], text_col=names["text"], keep=rest)
    return _outer(judged.where(~F.col("leaked")), names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: the words taken, in whole
    documents (to the nearest), a row each time."""
    takes = source_mix.mixed(docs.select(F.col("doc_id").alias("id"), "text", "source"), source_mix.WEIGHTS, 3.0)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    takes = (takes.select("id", F.col("source").alias("s"), F.col("h").alias("take_h"), times.alias("times"))
             .where("times > 0").dropDuplicates(["id", "s", "take_h"]))
    inner, names = _inner(docs)
    keyed = inner.withColumn("row_h", source_mix.mix_hash(F.col(names["doc_id"]), F.col(names["text"])))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("id")) & F.col(names["source"]).eqNullSafe(F.col("s")) & (F.col("row_h") == F.col("take_h"))
    return _outer(keyed.join(takes, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))), names)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every row along the Hilbert curve."""
    return hilbert_shards.shards(docs, keep=("source", "lang", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: Language models, alignments and Hilbert curves are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
