"""Source audit against brute force in whole numbers and the SQL twin."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from gleaner.llm import level_audit, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLS = ["lang", "source", "part", "item", "value", "rank"]


def _expected(rows, least=3, top=200):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        sources = sorted(s for g, s in groups if g == lang)
        kept = [t for t, n in docs[lang].items() if n >= least]
        v, n = len(kept), {s: sum(count[lang, s][t] for t in kept) for s in sources}

        def share(c, total):
            return 1 + 10**9 * (c + 1) // (total + v)
        p = {s: {t: share(count[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def _docs(spark, rows):
    return spark.createDataFrame([(i % 7, t, la, s, "x", i) for i, (la, s, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string, n int").repartition(3)


def _got(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    vocabulary = ["the", "The", "of", "é", "ÉA", "中文", "x y", "straße", "it's", "a_b", "n0n", "\U0001F600"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    out = [(rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", "", None, "é"]),
            " ".join(rnd.choice(vocabulary[:rnd.randrange(1, len(vocabulary))]) for _ in range(rnd.randrange(0, 60)))) for _ in range(150)]
    out += [("en", "silent", None), ("en", "silent", "123 ..."), ("xx", "only", "one two two"), ("yy", "p", "rare"), ("yy", "q", None),
            ("en", "a", "the " * 50_000), ("en", "a", "the"), ("en", "a", "the")]
    return out


def test_audit_equals_brute_force(spark, rows):
    assert _got(level_audit.audit(_docs(spark, rows))) == _expected(rows)


def test_blocks_and_tiles_do_not_change_the_result(spark, rows):
    got = level_audit.audit(_docs(spark, rows), block=40, tile=2, top=5)
    assert _got(got) == _expected(rows, top=5)


def test_shares_are_exact_at_any_size():
    rnd = random.Random(8)
    for _ in range(500):
        whole = rnd.randrange(1, 9 * 10**15)
        c = rnd.choice([0, whole - 1, rnd.randrange(0, whole)])
        assert int(level_audit.shares(np.array([c]), np.array([whole]))[0]) == 1 + 10**9 * (c + 1) // whole


def test_empty_table_and_sql_twin(spark, rows):
    assert level_audit.audit(_docs(spark, rows).limit(0)).collect() == []
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op13_source_audit"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert _got(got) == sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({level_audit.SQL})").fetchall())
