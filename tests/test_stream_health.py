"""The streaming health fold against the batch fold: arrivals out of order,
restarts from the checkpoint, late rows."""

import datetime as dt
import random

import pytest

from gleaner.operators.health import source_health
from gleaner.schema import FETCH_LOG
from gleaner.streaming import health as H

START = dt.datetime(2026, 3, 1)
COLS = H.HEALTH_COLUMNS + ["disabled"]


def _row(source, hours, ok, n=0):
    return ("t", source, START + dt.timedelta(hours=hours), ok, n)


def _land(spark, path, rows):
    spark.createDataFrame(rows, FETCH_LOG).coalesce(1).write.mode("append").parquet(path)


def _rows(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


@pytest.fixture
def base(spark, tmp_path):
    return str(tmp_path)


def test_out_of_order_arrivals_and_restarts_equal_the_batch_fold(spark, base):
    rnd = random.Random(3)
    log = [_row(f"s{rnd.randrange(12)}", h, rnd.random() < 0.25, rnd.randrange(9)) for h in range(0, 160)] + [_row("dead", h, False) for h in range(0, 160, 9)]
    log += [_row("tie", 5, True, 2), _row("tie", 5, False), _row("tie", 6, False)]
    shuffled = sorted(log, key=lambda r: r[2] + dt.timedelta(hours=rnd.uniform(0, 40)))      # up to 40 hours out of order
    cut = len(shuffled) // 4
    for i in range(4):                                                                       # every run starts from the checkpoint
        _land(spark, f"{base}/in", shuffled[i * cut:(i + 1) * cut if i < 3 else None])
        H.run_health_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", delay="48 hours")
    assert _rows(H.latest_health(spark, f"{base}/out").select(*COLS)) == _rows(source_health(spark.createDataFrame(log, FETCH_LOG)).select(*COLS))


def test_a_batch_writes_only_what_changed_and_late_rows_are_left_out(spark, base):
    _land(spark, f"{base}/in", [_row("a", 0, False), _row("b", 0, True, 3)] + [_row("c", h, False) for h in range(6)])
    H.run_health_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", delay="10 hours")
    _land(spark, f"{base}/in", [_row("a", 100, False)])
    H.run_health_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", delay="10 hours")
    _land(spark, f"{base}/in", [_row("b", 95, False), _row("c", 3, True, 8), _row("a", 101, False)])     # c's success is late
    H.run_health_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", delay="10 hours")
    versions = [r.source_id for r in spark.read.parquet(f"{base}/out").orderBy("batch_id", "source_id").collect()]
    assert versions[:4] == ["a", "b", "c", "a"] and "c" not in versions[4:]
    got = {r.source_id: (r.consecutive_failures, r.disabled, r.total_items_fetched) for r in H.latest_health(spark, f"{base}/out").collect()}
    assert got == {"a": (3, False, 0), "b": (1, False, 3), "c": (6, True, 0)}


def test_a_record_is_forgotten_after_its_time_to_live(spark, base):
    runs = [[_row("a", 0, False), _row("a", 1, False), _row("b", 0, True, 3)], [_row("b", 24 * 40, True, 1)], [_row("a", 24 * 41, False)]]
    for rows in runs:
        _land(spark, f"{base}/in", rows)
        H.run_health_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", delay="1 day", forget_days=30)
    got = {r.source_id: (r.consecutive_failures, r.fetches) for r in H.latest_health(spark, f"{base}/out").collect()}
    assert got["a"] == (1, 1) and got["b"][0] == 0


class _Handle:
    """A state store that counts its calls."""

    def __init__(self):
        self.calls, self.values = [], {}

    def getValueState(self, name, schema):
        return _Value(self, name)

    getListState = getValueState


class _Value:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def _call(self, what):
        self.handle.calls.append((what, self.name))

    def exists(self):
        self._call("exists")
        return self.name in self.handle.values

    def get(self):
        self._call("get")
        return self.handle.values.get(self.name)

    def update(self, value):
        self._call("update")
        self.handle.values[self.name] = value

    put = update


class _Times:
    def getCurrentWatermarkInMs(self):
        return 0


def test_a_source_costs_one_read_and_one_write_of_state_a_batch(spark):
    handle, fold = _Handle(), H.HealthFold()
    fold.init(handle)
    out = []
    for at in (10, 20):
        out = list(fold.handleInputRows(("t", "a"), iter([("t", "a", at, at == 10, 3, None), ("t", "a", at + 1, False, 0, None)]), _Times()))
    assert len(handle.calls) == 4 and [tuple(r) for r in out] == [("t", "a", 3, 10, 21, 3, 4)]
