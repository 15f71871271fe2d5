"""The Bloom filter of a run's hashes against the seen state."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators import bloom, dedup


def _hashes(spark, lo, hi):
    return spark.range(lo, hi, numPartitions=4).select(F.sha2(F.col("id").cast("string"), 256).alias("url_hash"))


@pytest.fixture
def tables(spark, tmp_path):
    _hashes(spark, 0, 40_000).union(_hashes(spark, 0, 10)).withColumn("day", F.lit(1)).write.parquet(str(tmp_path / "seen"))
    items = _hashes(spark, 39_800, 41_000).withColumn("source_ord", F.lit(0)).withColumn("item_ord", F.monotonically_increasing_id())
    return spark.read.parquet(str(tmp_path / "seen")), items


def test_true_hits_pass_and_few_others(spark, tables):
    seen, items = tables
    found = bloom.candidates(seen, items)
    assert found.columns == seen.columns
    hits = found.join(items, "url_hash", "left_semi").count()
    assert hits == 200 and hits <= found.count() < 200 + 0.1 * 39_800


@pytest.mark.parametrize("bits", [6, 10, None])
def test_the_result_does_not_depend_on_the_filter(spark, tables, monkeypatch, bits):
    """A filter of 64 bits lets nearly every row through, one that is too
    small for the items all of them: the exact comparison decides."""
    seen, items = tables
    if bits:
        monkeypatch.setattr(bloom, "width_for", lambda n: bits)
    else:
        monkeypatch.setattr(bloom, "MOST_BITS", 8)
        assert bloom.candidates(seen, items) is seen
    tagged = dedup.tag_duplicates(items.union(items.limit(5)), seen)
    assert {r["dup"]: r["count"] for r in tagged.groupBy("dup").count().collect()}["dup_state"] >= 200
    assert tagged.where("dup IS NULL").count() == 1000 == dedup.not_seen(items, seen).count()


def test_the_state_is_tested_where_it_is_read(spark, tables):
    """No exchange below the probes on the state's side, and one column read."""
    seen, items = tables
    plan = bloom.candidates(seen.select("url_hash"), items)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == bloom.PROBES and "SortMergeJoin" not in plan and "ReadSchema: struct<url_hash:string>" in plan


def test_empty_and_null(spark, tables):
    seen, items = tables
    assert bloom.candidates(seen.limit(0), items).collect() == [] and bloom.candidates(seen, items.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, 0, 1), ("x", 0, 2), ("x", 0, 3)], "url_hash string, source_ord int, item_ord long")
    state = spark.createDataFrame([(None,), ("y",)], "url_hash string")
    got = {(r["url_hash"], r["item_ord"]): r["dup"] for r in dedup.tag_duplicates(odd, state).collect()}
    assert got == {(None, 1): None, ("x", 2): None, ("x", 3): "dup_run"}
