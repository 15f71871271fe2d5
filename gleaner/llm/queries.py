"""Registered queries of the corpus operators and, where SQL can say the
same, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprints, fuzzy_lines, hilbert_shards, html_extract, infill, language_id, level_audit, ngram_join, pivot_simhash, \
    secret_scan, source_mix, token_counts

TOKENIZER = "piece_bpe_32k.model"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(TOKENIZER))


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf), tokenizer_path())


def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan_secrets(_documents(spark, sf))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return language_id.identify(docs, language_id.train(docs, tokenizer_path()))


def op4_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return source_mix.mix(_documents(spark, sf))


def op5_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(_documents(spark, sf))


def op6_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(_documents(spark, sf))


def op7_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return html_extract.extract(pages, html_extract.train(pages))


def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.decontaminate(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op9_hilbert_shards(spark: SparkSession, sf: str) -> DataFrame:
    return hilbert_shards.shards(_documents(spark, sf))


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(_documents(spark, sf), grams=8)


def op11_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_simhash.simhash_components(_documents(spark, sf))


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    done = infill.restore(infill.arrange(_documents(spark, sf)))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    return level_audit.audit(_documents(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_secret_scan, op3_language_id, op4_source_mix, op5_ngram_join, op6_fingerprints, op7_html_extract,
                                 op8_decontaminate, op9_hilbert_shards, op10_line_dedup, op11_simhash_pivots, op12_fill_in_middle, op13_source_audit)}
SQL: dict[str, str] = {"op4_source_mix": source_mix.SQL, "op12_fill_in_middle": infill.SQL, "op13_source_audit": level_audit.SQL}
