"""Source registry (A1, D8, C7): source type -> scan function.

A scan turns one configured source into raw-item rows, with the source's
position as ``source_ord``.  ``scan_all`` runs every source as a job of its
own, a few at a time, and writes its rows to the shared folder; what comes
back is one scan over the folders of the sources that came through.  An
unknown type, a scan that cannot be planned and one that fails while it runs
(a corrupt landed file) all yield no rows, a warning and a ``Fault``: one bad
source never fails the run, and rows of a source are there whole or not at
all.  A fault of the shared folder itself is not a source's: it is met first
and fails the run.  So does a fault of the engine while a source is scanned
(memory, disk, a lost executor, a cancelled job): it says nothing about the
source.  Callers whose result stands for every source use ``scan_whole``,
which raises where a source failed.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_ITEMS
from ..session import checkpoint_dir
from ..spec import SourceSpec

log = logging.getLogger(__name__)

Scan = Callable[..., DataFrame]
REGISTRY: dict[str, Scan] = {}


def register(source_type: str, fn: Scan) -> None:
    REGISTRY[source_type] = fn


def _rss(spark, spec: SourceSpec, as_of, days, ord_, landed):
    from .feeds import scan_rss
    return scan_rss(spark, landed(spec), label=spec.label, url=spec.url, as_of=as_of,
                    window_days=days, source_ord=ord_)


def _atom(spark, spec: SourceSpec, as_of, days, ord_, landed):
    from .feeds import scan_atom
    return scan_atom(spark, landed(spec), query=spec.query or "", label=spec.label, as_of=as_of,
                     window_days=days, source_ord=ord_)


def _sitemap(spark, spec: SourceSpec, as_of, days, ord_, landed):
    from .sitemap import scan_sitemap
    return scan_sitemap(spark, landed(spec), label=spec.label, url=spec.url, path_filter=spec.query,
                        as_of=as_of, window_days=days, source_ord=ord_)


def _html_list(spark, spec: SourceSpec, as_of, days, ord_, landed):
    """Landed pages (page_id, url, html): the one at the source's URL is the
    listing, which may go on over numbered pages (URL?page=N); the others are
    article pages."""
    from .pages import scan_listing
    pages = spark.read.parquet(landed(spec))
    # the number of a page of the listing: 0 at the source's URL, null elsewhere
    rest = F.substr("url", F.lit(len(spec.url or "") + 1))
    number = F.when(F.startswith("url", F.lit(spec.url)), F.when(rest == "", F.lit(0)).otherwise(
        F.nullif(F.regexp_extract(rest, r"^\?page=([0-9]{1,9})$", 1), F.lit("")).cast("long")))
    listings = pages.withColumn("listing_ord", number).where("listing_ord IS NOT NULL").select(F.col("url").alias("listing_url"), "html", "listing_ord")
    return scan_listing(listings, pages, as_of, days, label=spec.label, source_ord=ord_)


def _manual_urls(spark, spec: SourceSpec, as_of, days, ord_, landed):
    from .pages import scan_urls
    urls = ([spec.url] if spec.url else []) + list(spec.urls or [])
    listed = spark.createDataFrame(list(enumerate(urls)), "url_ord long, url string")
    return scan_urls(listed, spark.read.parquet(landed(spec)), spec.label, as_of=as_of, source_ord=ord_, with_html=True)


register("rss", _rss)
register("arxiv", _atom)
register("atom", _atom)
register("sitemap", _sitemap)
register("html_list", _html_list)
register("manual_urls", _manual_urls)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_ITEMS)


@dataclass(frozen=True)
class Fault:
    """Why a source gave no rows."""
    source_id: str
    source_ord: int
    error: str


class ScanFailed(RuntimeError):
    """Sources failed where rows of all of them were asked for."""

    def __init__(self, faults: list[Fault]) -> None:
        super().__init__("; ".join(f"{f.source_id}: {f.error.splitlines()[0]}" for f in faults))
        self.faults = faults


#: What a failure that is the engine's and not the source's says of itself.
ENGINE_FAULTS = ("OutOfMemoryError", "SparkOutOfMemoryError", "UNABLE_TO_ACQUIRE_MEMORY", "No space left on device", "Disk quota exceeded",
                 "ExecutorLostFailure", "ExecutorDeadException", "FetchFailed", "SparkContext was shut down", "stopped SparkContext",
                 "SparkContext has been shutdown", "SPARK_JOB_CANCELLED", "Py4JNetworkError")


def is_engine_fault(e: BaseException) -> bool:
    told = f"{type(e).__name__}: {e}"
    return any(mark in told for mark in ENGINE_FAULTS)


def scan_source(spark: SparkSession, spec: SourceSpec, as_of: dt.datetime, window_days: int,
                source_ord: int, landed: Callable[[SourceSpec], str]) -> DataFrame:
    """Rows of one source as a lazy plan; raises what the scan raises."""
    fn = REGISTRY.get(spec.type)
    if fn is None:
        raise LookupError(f"no scan registered for source type {spec.type!r}")
    df = fn(spark, spec, as_of, window_days, source_ord, landed)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_ITEMS.fields])


def scan_all(spark: SparkSession, specs: list[SourceSpec], as_of: dt.datetime, window_days: int,
             landed: Callable[[SourceSpec], str], disabled: set[str] | None = None, *, parallel: int = 4,
             faults: list[Fault] | None = None) -> DataFrame:
    """Rows of every enabled source (disabled sources skipped), ``parallel``
    sources at a time.  ``faults``, if given, takes what went wrong; a fault
    of the engine is raised."""
    disabled = disabled or set()
    base = f"{checkpoint_dir(spark).rstrip('/')}/scan-{uuid.uuid4().hex}"
    empty(spark).coalesce(1).write.parquet(f"{base}/none")

    def one(place: tuple[int, SourceSpec]) -> str | Fault | None:
        i, spec = place
        if spec.source_id in disabled:
            log.warning("skipping disabled source %s", spec.source_id)
            return None
        try:
            scan_source(spark, spec, as_of, window_days, i, landed).write.parquet(f"{base}/{i}")
            return f"{base}/{i}"
        except Exception as e:  # noqa: BLE001 - one source never fails the run
            if is_engine_fault(e):
                raise
            log.warning("scan failed for %s: %s", spec.source_id, str(e).splitlines()[0] if str(e) else repr(e))
            return Fault(spec.source_id, i, str(e) or repr(e))

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        done = list(pool.map(one, enumerate(specs)))
    if faults is not None:
        faults += [d for d in done if isinstance(d, Fault)]
    return spark.read.schema(RAW_ITEMS).parquet(f"{base}/none", *[d for d in done if isinstance(d, str)])


def scan_whole(spark: SparkSession, specs: list[SourceSpec], as_of: dt.datetime, window_days: int,
               landed: Callable[[SourceSpec], str], disabled: set[str] | None = None, *, parallel: int = 4) -> DataFrame:
    """``scan_all`` where rows of every enabled source are asked for: raises
    ``ScanFailed`` if one failed, instead of giving the rows of the others."""
    faults: list[Fault] = []
    rows = scan_all(spark, specs, as_of, window_days, landed, disabled, parallel=parallel, faults=faults)
    if faults:
        raise ScanFailed(faults)
    return rows
