"""SimHash groups against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import pivot_simhash, queries


def _fingerprint(text, k=4):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(fps, bits=4):
    """fps: {node: fingerprint} -> {node: least node of its group}."""
    root = {n: n for n in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = sorted(fps)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def _texts():
    rnd = random.Random(6)
    words = [f"Word{i}" for i in range(500)]
    out = [None, "", " \t\n", "one", "two words", "ONE", "a  b c d", "three little words", "é É ﬁ 中文 \U0001F600 x", "w " * 70_000]
    for _ in range(40):
        base = [rnd.choice(words) for _ in range(rnd.randrange(30, 400))]
        out += [" ".join(base), " \n".join(base).upper()]
        for _ in range(rnd.randrange(0, 5)):
            copy = list(base)
            copy[rnd.randrange(len(copy))] = "edited"
            out.append("\t".join(copy))
    return out


def test_groups_equal_brute_force(spark):
    texts = _texts()
    rows = [(i, t, "x", i, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(None, texts[12], "y", 1, 2)], "doc_id long, text string, fp string, key int, component_id long").repartition(4)
    got = pivot_simhash.simhash_components(docs).collect()
    fps = {i: _fingerprint(t) for i, t in enumerate(texts)}
    want = _components(fps)
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["fingerprint"] == f"{fps[12]:016x}"
        else:
            assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", want[r["doc_id"]])
    assert len(set(want.values())) < len(texts) - 20


def test_repeated_ids_join_the_groups_of_their_texts(spark):
    a, b = "alpha beta gamma delta epsilon", "one two three four five six"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (4, None), (5, "")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in pivot_simhash.simhash_components(docs).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert pivot_simhash.simhash_components(docs.limit(0)).collect() == []


@pytest.mark.parametrize("long", [4096, 40])
def test_links_connect_as_all_pairs_do(spark, long):
    """Crowds around a few centres, chains and strangers; with short lists
    allowed only, crowded lists are split several times."""
    rnd = random.Random(long)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 8))) for _ in range(60)}
    for _ in range(3):                                   # many that differ in the last bits only
        head = rnd.getrandbits(50) << 14
        fps |= {head | rnd.getrandbits(14) for _ in range(80)}
    nodes = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    edges = pivot_simhash.links(spark.createDataFrame(nodes, "fp long"), long=long).collect()
    unsigned = {n: n & (2**64 - 1) for (n,) in nodes}
    assert all((unsigned[e["a"]] ^ unsigned[e["b"]]).bit_count() <= 4 for e in edges)
    want, got = _components(unsigned), {n: n for n in unsigned}
    for e in edges:
        x, y = got[e["a"]], got[e["b"]]
        if x != y:
            got = {n: min(x, y) if g in (x, y) else g for n, g in got.items()}
    assert got == want


def test_a_crowd_gives_few_links(spark):
    fps = [(i,) for i in {(7 << 40) | (1 << a) | (1 << b) for a in range(40) for b in range(40)}]
    edges = pivot_simhash.links(spark.createDataFrame(fps, "fp long"))
    assert edges.count() < 15 * len(fps)                 # all pairs: 1 000 times as many


def test_pivot_distances_never_discard_a_link():
    rnd = np.random.default_rng(1)
    refs = pivot_simhash.pivots(32)
    assert len(set(refs.tolist())) == 32
    x = rnd.integers(0, 2**63, 2000).astype(np.uint64)
    for _ in range(4):
        y = x ^ (np.uint64(1) << rnd.integers(0, 64, 2000).astype(np.uint64))
        d = [np.bitwise_count(v[:, None] ^ refs).astype(np.int8) for v in (x, y)]
        assert (np.abs(d[0] - d[1]).max(axis=1) <= np.bitwise_count(x ^ y)).all()


def test_more_blocks_for_more_fingerprints():
    assert [pivot_simhash.blocks_for(n, 4) for n in (0, 10**6, 10**8, 10**10)] == [6, 6, 7, 9]
    for m in (6, 8):
        found = pivot_simhash.masks(2**64 - 1, m, 4)
        assert len(set(found)) == len(found) and all(f.bit_count() >= 64 * (m - 4) // m - 2 for f in found)


def test_registered_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: _fingerprint(t) for i, t in docs.items()}
    want = _components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op11_simhash_pivots"](spark, sf).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in docs}
