"""Unit cases worked out from the reference's rules (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.operators import blocks, gate, health, rank
from gleaner.operators.order import with_global_rank
from gleaner.spec import FilterSpec, RankingSpec

AS_OF = dt.datetime(2026, 3, 8, 9, 0)


def test_window_and_freshness(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 1),), (dt.date(2026, 2, 28),), (None,), (dt.date(2026, 3, 8),),
                                (dt.date(2026, 3, 7),), (dt.date(2026, 3, 20),), (dt.date(2026, 3, 6),),
                                (dt.date(2026, 3, 5),), (dt.date(2026, 3, 4),)], "d date")
    rows = df.select(gate.in_window("d", AS_OF, 7).alias("w"), rank.freshness("d", AS_OF).alias("f")).collect()
    assert [r.w for r in rows[:3]] == [True, False, True]
    assert [r.f for r in rows[3:]] == [0.3, 0.3, 0.3, 0.15, 0.15, 0.0]
    assert rows[2].f == 0.0


def test_precedence(spark):
    spec = FilterSpec(require_publish_date=True, include_patterns=["model"], exclude_patterns=["webinar"])
    df = spark.createDataFrame([
        ("Webinar on model", None, "x", None),          # undated and excluded -> no_date
        ("Webinar today", "nothing", "x", dt.date(2026, 3, 8)),  # not included and excluded -> not_included
        ("A model webinar", "", "x", dt.date(2026, 3, 8)),       # excluded
        ("A model", "", "x", dt.date(2026, 3, 8)),                # passed
    ], "title string, excerpt string, source string, publish_date date")
    out = gate.tag_reason(df, spec).select("disposition").collect()
    assert [r.disposition for r in out] == ["no_date", "not_included", "excluded", "passed"]


def test_low_signal(spark):
    spec = FilterSpec(require_publish_date=False, min_detail_signals=2)
    df = spark.createDataFrame([("New SDK is 2x faster", ""), ("Plain words", "")], "title string, excerpt string")
    df = df.withColumn("publish_date", F.lit(None).cast("date"))
    out = gate.tag_reason(df, spec).select("disposition", F.array_join("signals", ",").alias("s")).collect()
    assert out[0].disposition == "passed" and out[0].s == "has_numbers,has_code,has_comparison"
    assert out[1].disposition == "low_signal"


def test_takeaway(spark):
    df = spark.createDataFrame([
        ("Acme launches X1", "whatever"),
        ("Acme notes", "In this paper, small things matter here. We released a tool today."),
        ("", ""),
        ("A title without verbs that is rather long and goes on and on and on", ""),
    ], "t string, e string")
    got = [r.k for r in df.select(T.takeaway("t", "e", 60).alias("k")).collect()]
    assert got[0] == "Acme launches X1"
    assert got[1] == "We released a tool today"
    assert got[2] == ""
    assert got[3].endswith("…") and len(got[3]) <= 60


def test_truncate_and_excerpt(spark):
    df = spark.createDataFrame([("  short  ",), ("word " * 40,), ("<p>Hi <!-- x\n y --> there</p>",)], "t string")
    rows = df.select(T.truncate_words("t", 60).alias("c"), T.make_excerpt("t", 120).alias("e")).collect()
    assert rows[0].c == "short"
    assert rows[1].c.endswith("…") and len(rows[1].c) <= 60 and not rows[1].c.endswith(" …")
    assert rows[2].e == "Hi  there"


def test_score_example(spark):
    spec = RankingSpec(source_weight_map={"ex.com": 1.5}, detail_signal_bonus=0.1)
    df = spark.createDataFrame([("https://blog.ex.com/a", "s", dt.date(2026, 3, 8), ["a", "b", "c", "d"])],
                               "url string, source string, publish_date date, signals array<string>")
    row = rank.score(df, spec, list(spec.source_weight_map.items()), AS_OF).select(
        "score", T.stars("score").alias("st")).first()
    assert row.score == 2.1 and row.st == "⭐⭐⭐"


def test_weight_first_match(spark):
    entries = [("en.example.com", 1.5), ("example.com", 1.1), ("src3", 1.4), ("other", 0.7)]
    df = spark.createDataFrame([("https://EN.example.com/x", "src3"), ("https://fr.example.com/x", "src3"),
                                ("https://a.org/x", "SRC3"), ("https://a.org/x", "zzz")], "url string, source string")
    expr = [r.weight for r in rank.with_source_weight(df, entries).orderBy("url", "source").collect()]
    assert expr == [1.5, 1.4, 1.0, 1.1]
    many = entries + [(f"p{i}", 0.1) for i in range(2000)]        # one plan, whatever the map's size
    assert [r.weight for r in rank.with_source_weight(df, many).orderBy("url", "source").collect()] == expr


def test_health_fold(spark):
    t0 = dt.datetime(2026, 1, 1)
    rows = []
    for src, pattern in [("a", "SFFF"), ("b", "FFFFF"), ("c", "FFFFS")]:
        for i, ch in enumerate(pattern):
            rows.append(("k", src, t0 + dt.timedelta(hours=i), ch == "S", 3 if ch == "S" else 0))
    log = spark.createDataFrame(rows, "task_key string, source_id string, ts timestamp_ntz, success boolean, item_count long")
    h = {r.source_id: r for r in health.source_health(log).collect()}
    assert (h["a"].consecutive_failures, h["a"].disabled) == (3, False)
    assert (h["b"].consecutive_failures, h["b"].disabled) == (5, True)
    assert (h["c"].consecutive_failures, h["c"].disabled, h["c"].total_items_fetched) == (0, False, 3)
    alerts = [r.source_id for r in health.health_alerts(health.source_health(log)).collect()]
    assert alerts == ["b", "a"]


def test_blocks(spark):
    text = "T\n\n^ Head\n\n" + "x" * 4500
    df = spark.createDataFrame([(1, text)], "id int, body string")
    rows = blocks.text_to_blocks(df, "id", "body").orderBy("block_ord").collect()
    assert [(r.block_type, len(r.content)) for r in rows] == [
        ("paragraph", 1), ("heading_3", 4), ("paragraph", 2000), ("paragraph", 2000), ("paragraph", 500)]
    assert rows[1].content == "Head"


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("g"))
    df = df.repartition(7)
    got = with_global_rank(df, [F.col("g").desc(), F.col("k")], "r").orderBy("r").collect()
    exp = sorted(((r.g, r.k) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.g, r.k) for r in got] == exp
    assert [r.r for r in got] == list(range(1, 5001))


def test_media_and_caption(spark):
    df = spark.createDataFrame([("slide_010.PNG",), ("deck.pdf",), ("a.mp3",), ("b.mov",), ("notes",)], "n string")
    rows = df.select(blocks.media_type("n").alias("t"), blocks.slide_caption("n").alias("c")).collect()
    assert [r.t for r in rows] == ["image", "pdf", "audio", "video", "file"]
    assert rows[0].c == "Slide 10" and rows[4].c == "notes"


def test_natural_key_order(spark):
    names = ["img10.png", "img9.png", "Img2.png", "img1-a.png", "img1.png", "a"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(T.natural_key("n")).collect()]
    assert got == ["a", "img1-a.png", "img1.png", "Img2.png", "img9.png", "img10.png"]


def test_run_id_and_scale_conf():
    from gleaner.operators.status import run_id
    from gleaner.session import scale_conf
    assert run_id(dt.datetime(2026, 3, 8, 9, 5, 7)) == "20260308T090507"
    conf = scale_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_ttl_dedup_stream(spark, tmp_path):
    from gleaner.schema import RAW_ITEMS
    from gleaner.streaming.incremental import ttl_dedup
    rows = [("https://a.com/x", "t", "s", None, None, None, dt.datetime(2026, 3, 1), 0, i) for i in range(3)]
    rows += [("https://a.com/y/?utm_source=z", "t", "s", None, None, None, dt.datetime(2026, 3, 1), 0, 9)]
    spark.createDataFrame(rows, RAW_ITEMS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(RAW_ITEMS).parquet(str(tmp_path / "in"))
    q = (ttl_dedup(stream, "fetched_at", 45).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_latest_runs(spark):
    from gleaner.operators.status import latest_runs
    m = spark.createDataFrame([("a", "20240128T000000", 1), ("a", "20240130T000000", 3), ("a", "20240129T000000", 2),
                               ("b", "20240101T000000", 9)], "task_key string, run_id string, final long")
    got = sorted((r.task_key, r.final) for r in latest_runs(m).collect())
    assert got == [("a", 3), ("b", 9)]


def test_takeaway_of_texts_that_open_with_many_short_pieces(spark):
    """The opening three real sentences, however many short ones come first."""
    from conftest import one_col
    from gleaner.functions import text as T
    short = "No. Yes. " * 30
    texts = [short + "Here is the first real sentence. The second real one follows. The third real one shows a verb. A fourth is released here.",
             "First long sentence here! Second long sentence here? Third long one here； Fourth one is launched.",
             short, "Only one sentence without an end", "a. b. c. d. e. f. g. h. i. j. k. l. m. n. o.", "We present, in short, a thing that is long enough. It was shipped today."]
    pairs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = [r.t for r in pairs.orderBy("i").select(T.takeaway(F.lit("Title"), "v").alias("t")).collect()]
    assert got == ["The third real one shows a verb", "First long sentence here", "No. Yes. No. Yes. No. Yes. No. Yes. No. Yes. No. Yes. No.…",
                   "Only one sentence without an end", "a. b. c. d. e. f. g. h. i. j. k. l. m. n. o.", "It was shipped today"]
    assert one_col(spark, ["　\x85 a b \x1f ", "​x"], T.strip) == ["a b", "​x"]
