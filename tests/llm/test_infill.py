"""Fill-in-the-middle against brute force on code points, exact round trip
and the SQL twin."""

import hashlib
import random

import duckdb
import pytest

from gleaner.llm import infill, queries

EDGE = [None, "", "a", "ab", "\n", "né é 中文字 \U0001F600́", "x<P>y", "<S>", "a<M", "<<P", "P>", "<P<S<M", "word " * 60_000, "\x00\x00"]


def _texts():
    rnd = random.Random(4)
    return EDGE + ["".join(rnd.choice("ab <>PSMé中\U0001F600") for _ in range(rnd.randrange(0, 80))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    texts = _texts()
    rows = [(i, t, "psm", i, f"r{i}") for i, t in enumerate(texts)] + [(7, texts[7], "x", 0, "again"), (None, "no id but text", None, 1, "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int, restored string").repartition(3)


def _sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def _expected(doc_id, text):
    t = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(t)
    if n == 0 or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    p, e = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = t[:p], t[p:e], t[e:]
    if h[3] % 100 < 20:
        return n, "spm", p, e - p, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", p, e - p, f"<P>{pre}<S>{suf}<M>{mid}"


def test_arrange_and_restore_equal_brute_force(docs):
    rows = infill.restore(infill.arrange(docs)).collect()
    texts = _texts()
    assert len(rows) == len(texts) + 2
    forms = set()
    for r in rows:
        text = "no id but text" if r["doc_id"] is None else texts[r["doc_id"]]
        n, form, p, m, out = _expected(r["doc_id"], text)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == (n, form, p, m, out)
        assert r["restored"] == (text or "")
        assert (r["output_sha256"], r["restored_sha256"]) == (_sha(out), _sha(text or ""))
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_restore_reads_output_and_form_only(spark):
    rows = [("<P>a<<S>c<M>b", "psm"), ("<S>c<P>a<M>b", "spm"), ("<P>x", "plain"), (None, None), ("<P><S><M>", "psm")]
    got = [r["restored"] for r in infill.restore(spark.createDataFrame(rows, "output string, form string").coalesce(1)).collect()]
    assert got == ["a<bc", "abc", "<P>x", "", ""]


def test_descriptors_keep_both_buffers():
    text = "héllo wörld".encode()
    pieces = infill.cut((infill.TEXT, 0, len(text)), (3, 8))
    order = infill.arranged(pieces, "spm")
    out, sha = infill.stream(order, (text, infill.SENTINELS))
    assert out == b"<S>" + text[8:] + b"<P>" + text[:3] + b"<M>" + text[3:8] and sha == hashlib.sha256(out).hexdigest()
    assert infill.stream(infill.inverse(out, "spm"), (out, infill.SENTINELS))[0] == text


def test_empty_table_and_sql_twin(spark, docs):
    assert infill.restore(infill.arrange(docs.limit(0))).collect() == []
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_fill_in_middle"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cols = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.execute(f"SELECT {cols} FROM ({infill.SQL})").fetchall(), key=str)
