"""Long pattern lists against the loop over patterns."""

import random

from pyspark.sql import functions as F

from gleaner.operators import gate, patterns, rank, themes
from gleaner.spec import FilterSpec


def _words(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdeé中") for _ in range(rnd.randrange(1, 7))) for _ in range(n)]


def _texts(spark, seed=1):
    rnd = random.Random(seed)
    texts = [None, "", "a", "é", "zzz", "no hit here: XYZ"] + [" ".join(_words(rnd.randrange(1, 30), rnd.random())) for _ in range(300)] + ["q" * 200_000 + "abc"]
    return texts, spark.createDataFrame(list(enumerate(texts)), "i int, v string").repartition(4)


def _first(text, pats):
    return None if text is None else next((i for i, p in enumerate(pats) if p in text), None)


def test_ten_thousand_patterns_in_one_pass(spark):
    pats = ["".join(p) for p in _words(10_000, 3)] + ["dup", "dup"]
    pats = [p for p in pats if len(p) > 3] + ["ab", "é", "zz"]
    texts, df = _texts(spark)
    found = df.select("i", patterns.first_match(F.col("v"), pats).alias("p"))
    assert {r["i"]: r["p"] for r in found.collect()} == {i: _first(t, pats) for i, t in enumerate(texts)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert len(plan) < 4000 and plan.count("ArrowEvalPython") == 1


def test_short_and_long_lists_agree(spark):
    texts, df = _texts(spark, 5)
    for pats in (["b", "a", "中"], ["zzzz", "", "a"], ["aa", "a", "aa"], ["nothing of that"]):
        both = df.select("i", patterns.first_match(F.col("v"), pats).alias("x"), patterns.first_match(F.col("v"), pats, inline=0).alias("y")).collect()
        assert all(r["x"] == r["y"] == _first(texts[r["i"]], pats) for r in both)
    assert df.select(patterns.first_match(F.col("v"), []).alias("x")).distinct().collect()[0]["x"] is None


def test_gate_themes_and_weights_of_long_lists(spark):
    include, exclude = [w.upper() for w in _words(200, 8) if len(w) > 2], [w for w in _words(90, 9) if len(w) > 3] + [f"x{i}" for i in range(80)]
    texts, df = _texts(spark, 7)
    items = df.where("v IS NOT NULL").select("i", F.lit("Title").alias("title"), F.col("v").alias("excerpt"), F.lit(None).cast("date").alias("publish_date"))
    got = {r["i"]: r["disposition"] for r in gate.tag_reason(items, FilterSpec(require_publish_date=False, include_patterns=include, exclude_patterns=exclude)).collect()}
    low = {i: f"title {t}".lower() for i, t in enumerate(texts) if t is not None}
    assert got == {i: "not_included" if not any(p.lower() in t for p in include) else "excluded" if any(p in t for p in exclude) else "passed" for i, t in low.items()}
    assert len(set(got.values())) == 3
    lexicon = [(f"theme{k}", [w for w in _words(30, 20 + k) if len(w) > 3]) for k in range(9)]
    named = {r["i"]: r["theme"] for r in themes.assign(items, lexicon).collect()}
    assert named == {i: next((n for n, ws in lexicon if any(w in t for w in ws)), None) for i, t in low.items()} and len(set(named.values())) > 3
    entries = [(f"h{k}.example.com", float(k)) for k in range(100)] + [("Example.com", 7.0), ("example.com", 8.0), ("SRC5", 9.0)]
    rows = [(f"https://h{k}.example.com/x", "s") for k in (5, 55, 200)] + [("https://other.org/x", "src5"), ("https://other.org/x", None), ("https://h3.example.com/", "Src5"), ("bad", "none")]
    weighed = [r["weight"] for r in rank.with_source_weight(spark.createDataFrame(rows, "url string, source string").coalesce(1), entries).collect()]
    hosts = [u.split("/")[2] if "/" in u else "" for u, _ in rows]
    assert weighed == [next((w for p, w in entries if p in h or p.lower() == (s or "").lower()), 1.0) for h, (_, s) in zip(hosts, rows)]
    assert len(set(weighed)) > 4
