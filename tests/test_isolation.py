"""One source that fails while it runs leaves the others alone."""

import datetime as dt
import gzip

import pytest

from gleaner.plans.run import run_job
from gleaner.schema import FETCH_LOG
from gleaner.sources import registry
from gleaner.spec import FilterSpec, JobSpec, RankingSpec, SourceSpec

AS_OF = dt.datetime(2026, 3, 8, 12, 0)
FEED = """<rss><channel><title>c</title>{}</channel></rss>"""
ITEM = "<item><title>Item {0} of {1}</title><link>https://ex.com/{1}/{0}</link><pubDate>Sat, 07 Mar 2026 10:00:00 GMT</pubDate><description>some words</description></item>"


@pytest.fixture
def landed(tmp_path):
    for name in ("good", "bad", "late"):
        (tmp_path / name).mkdir()
        body = FEED.format("".join(ITEM.format(i, name) for i in range(300))).encode()
        (tmp_path / name / "a.xml").write_bytes(body)
    packed = gzip.compress(body)
    (tmp_path / "bad" / "b.xml.gz").write_bytes(packed[:60] + b"\x00\xff broken" + packed[80:])
    (tmp_path / "site").mkdir()
    (tmp_path / "site" / "s.xml").write_text("<urlset><url><loc>https://ex.com/2026/03/07/from-the-sitemap</loc></url></urlset>")
    return tmp_path


SPECS = [SourceSpec(type="rss", label="good"), SourceSpec(type="rss", label="bad"), SourceSpec(type="sitemap", label="site"),
         SourceSpec(type="rss", label="gone"), SourceSpec(type="telepathy", label="odd"), SourceSpec(type="rss", label="late")]


def test_a_corrupt_file_costs_its_source_only(spark, landed):
    faults = []
    raw = registry.scan_all(spark, SPECS, AS_OF, 7, lambda s: str(landed / s.source_id), {"late"}, faults=faults)
    counts = {r["source"]: r["count"] for r in raw.groupBy("source").count().collect()}
    assert counts == {"good": 300, "site": 1}                       # the readable file of "bad" is not half taken
    assert [(f.source_id, f.source_ord) for f in faults] == [("bad", 1), ("gone", 3), ("odd", 4)] and all(f.error for f in faults)


def test_a_run_ends_and_health_logs_the_failure(spark, landed, tmp_path):
    spec = JobSpec(task_key="t", time_window_days=7, dedup_ttl_days=45, sources=SPECS, filters=FilterSpec(), ranking=RankingSpec())
    out = {k: str(tmp_path / k) for k in ("out", "seen", "log")}
    result = run_job(spark, spec, lambda s: str(landed / s.source_id), as_of=AS_OF, out_dir=out["out"], seen_path=out["seen"], log_path=out["log"])
    assert result.tagged.count() == 601
    # the manifest's totals were observed in the write of the tagged rows: equal to the rollup, without reading them again
    total = result.run_stats.where("level = 'total'").first()
    row = result.manifest.first()
    assert all(row[c] == total[c] for c in ("fetched", "deduped", "filtered_out", "final", "no_date", "excluded")) and row["fetched"] == 601
    assert "tagged-" not in result.manifest._jdf.queryExecution().executedPlan().toString()
    log = {r.source_id: r.success for r in spark.read.schema(FETCH_LOG).parquet(out["log"]).collect()}
    assert log == {"good": True, "bad": False, "site": True, "gone": False, "odd": False, "late": True}


def test_a_fault_of_the_shared_folder_fails_the_run(spark, landed, monkeypatch):
    monkeypatch.setattr(registry, "checkpoint_dir", lambda s: "nosuchscheme://x")
    with pytest.raises(Exception):
        registry.scan_all(spark, SPECS, AS_OF, 7, lambda s: str(landed / s.source_id))


def _failing(*args):
    raise ValueError("a feed that nothing can read")


def test_the_queries_fail_where_a_source_fails(spark, monkeypatch):
    from gleaner.plans import more_queries as M
    monkeypatch.setitem(registry.REGISTRY, "sitemap", _failing)
    for query in (M.source_union, M.whole_run):
        with pytest.raises(registry.ScanFailed, match="site: a feed that nothing can read"):
            query(spark, "/root/testdata/sf0.001")


def test_a_run_tells_its_failed_sources(spark, landed, tmp_path):
    spec = JobSpec(task_key="t", time_window_days=7, dedup_ttl_days=45, sources=SPECS, filters=FilterSpec(), ranking=RankingSpec())
    out = str(tmp_path / "out")
    result = run_job(spark, spec, lambda s: str(landed / s.source_id), as_of=AS_OF, out_dir=out, seen_path=str(tmp_path / "seen"), log_path=str(tmp_path / "log"))
    assert [f.source_id for f in result.faults] == ["bad", "gone", "odd"]
    told = spark.read.parquet(f"{out}/faults").orderBy("source_ord").collect()
    assert [(r.source_id, r.source_ord) for r in told] == [("bad", 1), ("gone", 3), ("odd", 4)] and all(r.error for r in told)


def test_a_fault_of_the_engine_is_not_a_source_s(spark, landed, monkeypatch):
    def out_of_memory(*args):
        raise RuntimeError("Job aborted due to stage failure: java.lang.OutOfMemoryError: Java heap space")
    monkeypatch.setitem(registry.REGISTRY, "sitemap", out_of_memory)
    with pytest.raises(RuntimeError, match="OutOfMemoryError"):
        registry.scan_all(spark, SPECS, AS_OF, 7, lambda s: str(landed / s.source_id))
