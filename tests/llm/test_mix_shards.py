"""Source mixing against its SQL twin; Hilbert shards against their law."""

import zlib

import duckdb
import numpy as np
import pytest

from gleaner.llm import hilbert_shards, source_mix

SCHEMA = "doc_id long, text string, source string, lang string, h long, target string"


def _rows():
    out = [(i, " ".join(["w"] * (i % 13)), f"s{i % 4}", "en", 0, "") for i in range(400)]
    out += [(1000 + i, "hot " * (i % 7 + 1), "hot", "de", 1, None) for i in range(600)]
    out += [(2000 + i, "a\tb c\n", None, None, 1, None) for i in range(9)]
    return out + [(3000, None, "empty", "en", 0, ""), (3001, "", "empty", "en", 0, ""), (3002, "long " * 20000, "one", "fr", 0, ""),
                  (1, "w", "s1", "en", 0, ""), (1, "w", "s1", "en", 0, ""), (None, "null id", "s2", "en", 0, "")]


def _sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    return con.execute(source_mix.SQL).fetchall()


def _key(r):
    return (r[0] is None, r[0] or 0, r[1], r[4])


def test_mix_equals_sql(spark):
    rows = _rows()
    got = sorted((tuple(r) for r in source_mix.mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()), key=_key)
    want = sorted(_sql(rows), key=_key)
    assert len(got) == len(want) == len(rows)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and g[4] == w[4] and abs(g[3] - w[3]) < 1e-6 * max(1, w[3])


def test_mix_meets_targets_and_repeats_agree(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    a = source_mix.mix(docs).collect()
    assert sorted(map(str, a)) == sorted(map(str, source_mix.mix(docs.repartition(7)).collect()))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in a)
    total = {r["source_size"]: (r["target"], 0) for r in a}
    by = {}
    for r in a:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-3 and total
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 13
    assert source_mix.mix(docs.limit(0)).collect() == []


def _filled(sizes, weights, cap=3.0):
    """Targets by rounds: share by weight, stop at the cap, reshare."""
    target, left = [0.0] * len(sizes), float(sum(sizes))
    free = [i for i in range(len(sizes)) if sizes[i]]
    while free and left > 1e-9:
        w = sum(weights[i] for i in free)
        over = [i for i in free if target[i] + left * weights[i] / w >= cap * sizes[i] - 1e-12]
        if not over:
            for i in free:
                target[i] += left * weights[i] / w
            break
        share = {i: target[i] + left * weights[i] / w for i in free}
        target = [share.get(i, t) for i, t in enumerate(target)]
        left = sum(target[i] - cap * sizes[i] for i in over)
        for i in over:
            target[i] = cap * sizes[i]
        free = [i for i in free if i not in over]
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000], [0, 5, 5, 800], [7], [1, 1, 1, 1, 1, 500], [300, 1, 1, 1]])
def test_water_fill(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_mix.water_fill(df).collect()}
    want = _filled(sizes, [source_mix.WEIGHTS[i % 3] for i in range(len(sizes))])
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want)


def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")])
        index = hilbert_shards.hilbert_index(grid, bits)
        assert sorted(index.tolist()) == list(range(grid.shape[1]))
        path = grid[:, np.argsort(index)]
        assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_shards_follow_the_rows_law(spark):
    rows = _rows()
    got = hilbert_shards.shards(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == len(rows)
    counts = {}
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 16
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1 and len(counts) == 16
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    order = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_shards_of_few_and_no_rows(spark):
    few = spark.createDataFrame(_rows()[5:8], SCHEMA)
    assert sorted((r["shard"], r["slot"]) for r in hilbert_shards.shards(few).collect()) == [(0, 0), (5, 0), (10, 0)]
    assert hilbert_shards.shards(few.limit(0)).collect() == []
    same = spark.createDataFrame([(None, None, None, None, 0, "")] * 40, SCHEMA)
    got = hilbert_shards.shards(same).collect()
    assert sorted(r["slot"] for r in got) == sorted([0, 1] * 16 + [2] * 8)
