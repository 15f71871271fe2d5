"""Jaccard join, fingerprints, line deduplication and decontamination
against brute force."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
import xxhash

from gleaner.llm import common, decontaminate, fingerprints, fuzzy_lines, ngram_join
from gleaner.llm.common import components
from gleaner.llm.linking import connect

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def _shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _near_texts(seed, families=6, copies=14):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["été", "Ü", "中文"]
    texts = [None, "", " \n", "one two", "One  TWO", "a b c d", "x " * 50, "to to to to to of of of of of"]
    common = [rnd.choice(vocab) for _ in range(30)]
    for _ in range(families):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))] + (common if rnd.random() < 0.6 else [])
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randrange(0, 5)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(" ".join(w[: rnd.choice([len(w), len(w) - 3])]))
    texts += texts[20:40]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    texts = _near_texts(seed)
    ids = random.Random(seed).sample(range(1, 10_000), len(texts))
    sets = {i: _shingles(t) for i, t in zip(ids, texts)}
    u = Union(ids)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                u.join(a, b)
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in zip(ids, texts)], "doc_id long, text string, n long, component_id int").repartition(4)
    got = ngram_join.jaccard_components(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), u.find(i)) for i in ids}
    assert len(got) == len(ids)


def test_jaccard_edges(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F"), (9, None), (9, "alone here with six words now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()))
    assert got == [(-1, 2, None), (3, 2, 3), (7, 2, 3), (7, 2, 3), (9, 0, 9), (9, 2, 9)]
    assert ngram_join.jaccard_components(docs.limit(0)).collect() == []
    long = spark.createDataFrame([(i, " ".join(f"v{j}" for j in range(30_000)) + f" t{i}") for i in range(3)], "doc_id long, text string")
    assert {r["component_id"] for r in ngram_join.jaccard_components(long).collect()} == {0}


def test_jaccard_repeated_ids_and_groups(spark):
    """An id with two texts: what links with either is in a group whose least
    id is that id."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " other"), (4, "nothing of these at all here"), (2, a + " more")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string").repartition(3)
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]


def _near_copies(n, with_base):
    """A text of 60 words and n copies with one to three words changed."""
    rnd = random.Random(n)
    base = [f"w{i}" for i in range(60)]
    out = [" ".join(base)] if with_base else []
    for i in range(n):
        copy = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3])):
            copy[rnd.randrange(60)] = f"new{i}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("with_base", [True, False])
def test_tested_pairs_grow_with_a_group(spark, monkeypatch, with_base):
    from gleaner.llm import linking
    counts, real = [], linking._links

    def counted(pairs, verify):
        counts[-1] += pairs.count()
        return real(pairs, verify)
    monkeypatch.setattr(linking, "_links", counted)
    for n in (200, 800):
        counts.append(0)
        texts = _near_copies(n, with_base)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).collect()}
        if n == 200:
            sets = [_shingles(t) for t in texts]
            u = Union(range(len(texts)))
            for a in range(len(texts)):
                for b in range(a + 1, len(texts)):
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        u.join(a, b)
            assert got == {i: u.find(i) for i in range(len(texts))}
    print("pairs tested", with_base, counts)
    assert counts[1] <= 8 * max(counts[0], 200)


def test_packed_integers_round_trip():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 5, 1000):
        v = np.sort(rnd.integers(0, 1 << 48, n, dtype=np.uint64))
        assert (ngram_join.unpack(ngram_join.pack(v)) == v).all()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(3)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_connect_finds_every_component(spark, seed):
    """Random posting lists and an arbitrary link relation, with few star
    rounds, so that the cross round has work to do."""
    rnd = random.Random(seed)
    rows = {(k, rnd.randrange(60)) for k in range(12) for _ in range(25)}
    links = {(a, b) for a in range(60) for b in range(a + 1, 60) if rnd.random() < 0.05}
    u = Union(range(60))
    for k in range(12):
        nodes = sorted(n for kk, n in rows if kk == k)
        for a in nodes:
            for b in nodes:
                if (a, b) in links:
                    u.join(a, b)
    true = spark.createDataFrame(sorted(links), "a long, b long")
    postings = spark.createDataFrame([(k, n, (n,)) for k, n in sorted(rows)], "key int, node long, att struct<v:long>")
    got = {r["node"]: r["root"] for r in connect(postings, lambda x, y: x["v"] != y["v"], lambda p: p.join(true, ["a", "b"]), star_rounds=1).collect()}
    for n in range(60):
        assert got.get(n, n) == u.find(n)


def test_fingerprints_equal_brute_force(spark):
    rnd = random.Random(4)
    texts = [None, "", "a", "ab", "é" * 7] + ["".join(rnd.choice("abc é\n中") for _ in range(rnd.randrange(1, 3000))) for _ in range(60)]
    rows = [(i * 7, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, body string, bucket string").repartition(4)
    got = {r["id"]: r for r in fingerprints.fingerprints(docs, id_col="id", text_col="body").collect()}
    rows.sort(reverse=True)
    for at, (i, t, _) in enumerate(rows):
        t, other = t or "", rows[(at + 1) % len(rows)][1] or ""
        new, r = fingerprints.edited(t, other), got[i]
        prints = [fingerprints.fingerprint(x) for x in (t, new, other)]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == "".join(sorted(prints[0])) and r["edited_fingerprint"] == "".join(sorted(prints[1]))
        assert r["near_edited"] == fingerprints.containment(prints[0], prints[1]) and r["near_next"] == fingerprints.containment(prints[0], prints[2])
    assert len(got) == len(rows)


def test_fingerprint_edges(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    r = fingerprints.fingerprints(one).collect()[0]
    assert r["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and r["near_next"] == 1.0
    assert fingerprints.fingerprints(one.limit(0)).collect() == []
    rows = [(1, "x" * 90), (1, "y" * 90), (None, "z" * 90), (None, None), (4, "x" * 90)]
    got = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5 and len({r["fingerprint"] for r in got if r["doc_id"] == 4 or r["edited_sha256"] is None}) == 1
    want = [("x" * 90, "x" * 90), ("x" * 90, "y" * 90), ("y" * 90, ""), ("", "z" * 90), ("z" * 90, "x" * 90)]
    assert sorted(r["edited_sha256"] for r in got) == sorted(hashlib.sha256(fingerprints.edited(a, b).encode()).hexdigest() for a, b in want)


def test_chunks_resist_shifts():
    rnd = random.Random(8)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    assert [b for _, b in fingerprints.chunks(text.encode())][-1] == 20_000
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint("inserted " + text)
    assert fingerprints.containment(a, b) > 0.95
    sizes = [e - s for s, e in fingerprints.chunks(text.encode())]
    assert max(sizes) <= fingerprints.LARGEST and 40 < np.mean(sizes) < 120


def _simhash(words):
    n, out = len(words), 0
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    for b in range(fuzzy_lines.BITS):
        out |= (2 * sum(x >> b & 1 for x in h) > n) << b
    return out


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _norm(line):
    return [w for w in line.lower().translate(str.maketrans(fuzzy_lines.PUNCTUATION, " " * len(fuzzy_lines.PUNCTUATION))).split(" ") if w]


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(6)
    vocab = [f"word{i}" for i in range(40)] + ["été", "中"]
    bases = [[rnd.choice(vocab) for _ in range(n)] for n in (1, 2, 12, 30, 60)]
    texts = [None, "", "\n\n", "...\n--", "Common line.\ncommon LINE\n"]
    for _ in range(30):
        lines = []
        for _ in range(rnd.randrange(1, 6)):
            w = list(rnd.choice(bases))
            for _ in range(rnd.randrange(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            lines.append(rnd.choice(["", "  "]) + " ".join(w).capitalize() + rnd.choice([".", "", "!"]))
        texts.append("\n".join(lines))
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    occurrences = [(i, no, line) for i, t in rows for no, line in enumerate((t or "").split("\n")) if t is not None and _norm(line)]
    names = {}
    for i, no, line in occurrences:
        names.setdefault(tuple(_norm(line)), (i, no))
    keys = list(names)
    u, sims = Union(range(len(keys))), [_simhash(k) for k in keys]
    for a in range(len(keys)):
        for b in range(a + 1, len(keys)):
            if bin(sims[a] ^ sims[b]).count("1") <= 2:
                x, y = " ".join(keys[a]), " ".join(keys[b])
                if _distance(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9):
                    u.join(a, b)
    number = {k: i for i, k in enumerate(keys)}
    first = {}
    for i, no, line in sorted(occurrences):
        first.setdefault(u.find(number[tuple(_norm(line))]), (i, no))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int").repartition(4)
    got = {r["doc_id"]: r for r in fuzzy_lines.dedup_lines(docs).collect()}
    assert len(got) == len(rows) and any(u.find(i) != i for i in range(len(keys)))
    for i, t in rows:
        if t is None:
            assert (got[i]["text"], got[i]["n_lines"], got[i]["n_kept"]) == (None, 0, 0)
            continue
        lines = t.split("\n")
        keep = [x for no, x in enumerate(lines) if not _norm(x) or first[u.find(number[tuple(_norm(x))])] == (i, no)]
        assert (got[i]["text"], got[i]["n_lines"], got[i]["n_kept"]) == ("\n".join(keep), len(lines), len(keep))


def test_line_dedup_recall_on_edit_similarity_alone(spark):
    """Pairs of a line and its edited copy (one word, a tenth or a fifth of
    the words, one letter) against edit similarity without any bit filter."""
    rnd = random.Random(9)
    vocab = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9))) for _ in range(5000)]
    pairs = []
    for n in (3, 5, 6, 7, 8, 12, 20, 30, 50, 100, 200):
        for edits in sorted({1, max(1, n // 10), max(1, n // 6)}):
            for _ in range(12):
                a = [rnd.choice(vocab) for _ in range(n)]
                b = list(a)
                for j in rnd.sample(range(n), edits):
                    b[j] = rnd.choice(vocab) if n >= 5 else b[j] + "s"
                x, y = " ".join(a), " ".join(b)
                if x != y and _distance(x, y) <= int(max(len(x), len(y)) * 0.2 + 1e-9):
                    pairs.append((x, y))
    pairs += [("字" * 3 + "".join(chr(0x4e00 + rnd.randrange(4000)) for _ in range(60)), "") for _ in range(5)]
    pairs = [(x, y or x[:30] + "改" + x[31:]) for x, y in pairs]
    docs = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)], "doc_id long, text string").repartition(4)

    def recall(**given):
        kept = {r["doc_id"]: r["n_kept"] for r in fuzzy_lines.dedup_lines(docs, **given).collect()}
        assert all(kept[2 * i] == 1 for i in range(len(pairs)))
        return sum(kept[2 * i + 1] == 0 for i in range(len(pairs))) / len(pairs)

    found, before = recall(grams=8), recall()
    print(f"recall on {len(pairs)} pairs: {found:.3f} with grams, {before:.3f} by SimHash alone")
    assert found >= 0.95 > 0.5 > before


def test_simhash_of_lines_of_any_length(spark):
    """Packed and bitwise counts agree with the definition, and a line's work grows with its words, not with their square."""
    import time
    rnd = random.Random(14)
    vocab = [f"w{i}" for i in range(300)] + ["été", "中"]
    lines = [[rnd.choice(vocab) for _ in range(n)] for n in (1, 2, 3, 255, 256, 510, 511, 512, 513, 1500, 4000)] + [["w1"] * 511, ["w1"] * 512]
    docs = spark.createDataFrame([(i, "- " + ", ".join(w) + "!\n...") for i, w in enumerate(lines)], "id long, text string").repartition(3)
    got = {r["id"]: r for r in fuzzy_lines.occurrences(docs).where("n > 0").collect()}
    assert {i: (r["no"], r["sim"]) for i, r in got.items()} == {i: (0, _simhash(w)) for i, w in enumerate(lines)}
    long = spark.createDataFrame([(1, " ".join(f"word{i % 5000}" for i in range(200_000)))], "id long, text string")
    start = time.time()
    assert fuzzy_lines.occurrences(long).count() == 1 and fuzzy_lines.occurrences(long).first()["sim"] is not None
    assert time.time() - start < 15


def test_lines_told_apart_are_not_told_again(spark, monkeypatch):
    """A crowd of lines that share half their words and no link: every pair is tested once at most."""
    rnd = random.Random(15)
    common = [f"common{i}" for i in range(20)]
    texts = [" ".join(common[:10] + [f"own{rnd.randrange(10 ** 6)}" for _ in range(14)] + common[10:]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tested, within = [], fuzzy_lines._within

    def counted(rest):
        tested.extend(tuple(r) for r in rest.select("a", "b").collect())
        return within(rest)
    monkeypatch.setattr(fuzzy_lines, "_within", counted)
    assert all(r["n_kept"] == 1 for r in fuzzy_lines.dedup_lines(docs, grams=8).collect())
    assert len(tested) > 100 and len(set(tested)) == len(tested)


def test_lines_with_a_passage_at_other_places_are_no_pairs(spark, monkeypatch):
    """A passage that many lines have at different places makes few pairs, and all links are found; no table is left that nothing reads."""
    rnd = random.Random(16)

    def words(n):
        return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)]
    passage, texts = words(8), []
    for i in range(96):
        own, at = words(16), i % 6 * 3
        texts.append(" ".join(own[:at] + passage + own[at:]))
    crowd = len(texts)
    texts += [t.replace(t.split(" ")[-1 if i % 8 < 4 else 0], "edited") for i, t in enumerate(texts[:24])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tested, within = [], fuzzy_lines._within

    def counted(rest):
        tested.extend(tuple(r) for r in rest.select("a", "b").collect())
        return within(rest)
    monkeypatch.setattr(fuzzy_lines, "_within", counted)
    root = common.scratch_root(spark)
    held = set(os.listdir(root)) if os.path.isdir(root) else set()
    kept = {r["doc_id"]: r["n_kept"] for r in fuzzy_lines.dedup_lines(docs, grams=8).collect()}
    assert kept == {i: int(i < crowd) for i in range(len(texts))}
    assert len(tested) < 1500
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - held}
    assert "line-occurrences" in left and not left & {"line-distinct", "line-grams", "line-live", "line-texts", "postings", "cross"}


def test_line_dedup_edges(spark):
    rows = [(1, "same line here\nother"), (1, "same line here\nother"), (None, "same line here"), (2, "Same line, here!\nown")]
    got = sorted(((r["doc_id"] or 0), r["text"], r["n_lines"], r["n_kept"])
                 for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, "same line here", 1, 1), (1, "same line here\nother", 2, 2), (1, "same line here\nother", 2, 2), (2, "own", 2, 1)]
    assert fuzzy_lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_decontamination_finds_edited_copies_and_leaves_clean_text(spark):
    rnd = random.Random(2)
    vocab = [f"term{i}" for i in range(3000)]
    def words(n):
        return [rnd.choice(vocab) for _ in range(n)]
    items = [words(rnd.randrange(14, 50)) for _ in range(30)]
    rows, leaked = [], {}
    for i in range(240):
        text = words(rnd.randrange(5, 300))
        if i % 3 == 0:
            item = rnd.randrange(30)
            copy = list(items[item])
            for _ in range(len(copy) // 6 if i % 2 else 0):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            at = rnd.randrange(len(text))
            text[at:at] = [w.upper() + rnd.choice(["", ",", "."]) for w in copy]
            leaked[i] = item
        rows.append((i, " ".join(text), 0))
    rows += [(900, None, 0), (901, "", 0), (902, "term1", 0), (None, " ".join(items[3]), 1), (0, rows[0][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, "no-such words"), (52, "")], "item_id long, text string")
    got = decontaminate.decontaminate(docs, bench).collect()
    assert len(got) == len(rows)
    for r in got:
        want = 3 if r["doc_id"] is None else leaked.get(r["doc_id"])
        assert r["leaked"] == (want is not None) and r["item_id"] == want and (r["score"] >= 0.5) == r["leaked"]
    assert not any(r["leaked"] for r in decontaminate.decontaminate(docs, bench.limit(0)).collect())
    assert decontaminate.decontaminate(docs.limit(0), bench).collect() == []


def test_decontamination_finds_an_edited_item_in_many_documents(spark):
    """Every fifth word changed, copied into 1% of 2 000 documents, and one
    more item that only one document holds."""
    rnd = random.Random(12)
    items = [[f"item{i}x{j}" for j in range(25)] for i in range(2)]
    edited = [[f"new{i}" if j % 5 == 4 else w for j, w in enumerate(t)] for i, t in enumerate(items)]
    rows = []
    for i in range(2000):
        text = [f"term{rnd.randrange(3000)}" for _ in range(30)]
        item = 0 if i % 100 == 0 else 1 if i == 77 else None
        rows.append((i, " ".join(text[:15] + (edited[item] if item is not None else []) + text[15:])))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["item_id"], r["score"]) for r in decontaminate.decontaminate(docs, bench).where("leaked").collect()}
    assert got == {**{i: (0, pytest.approx(0.7, abs=0.03)) for i in range(0, 2000, 100)}, 77: (1, pytest.approx(0.7, abs=0.03))}


def test_decontamination_of_any_script_and_length(spark):
    """Typographic marks, scripts without spaces, items of one or two words,
    repeated items."""
    japanese = "これは試験のための文章です。誰もこの文を訓練に使ってはいけません。"
    items = [(1, "The quick brown fox - jumps over the 'lazy' dog, twice a day"), (2, japanese), (3, "Zyzzyva"), (4, "quantum marmalade"), (5, None), (6, "..."),
             (1, "The quick brown fox - jumps over the 'lazy' dog, twice a day"), (7, "ÉCOLE NORMALE SUPÉRIEURE DE CACHAN EN ÉTÉ")]
    texts = {0: ("x The quick brown fox\u2014jumps over the \u2018lazy\u2019 dog,\u00a0twice a day y", 1), 1: (japanese, 2), 2: ("前置き" + japanese + "後書き", 2), 3: (japanese[:12], None),
             4: ("we saw a ZYZZYVA\u2026 there", 3), 5: ("zyzzyvas", None), 6: ("quantum, marmalade!", 4), 7: ("quantum and marmalade", None),
             8: ("l\u2019école normale supérieure de cachan en été", 7), 9: (None, None), 10: ("", None), 11: ("...", None), 12: ("全く別の話です。今日は天気がいいですね。", None)}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string").repartition(3)
    got = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_id"] for r in got} == {i: w for i, (_, w) in texts.items()}
    assert all(r["n_items"] == r["leaked"] for r in got)


def test_decontamination_equals_all_items_on_all_documents(spark):
    """Every item aligned with every whole document, no seeds and no windows:
    what the seeds miss would show."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1200").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()}
    number: dict = {}
    def coded(t):
        return np.array([number.setdefault(w, len(number)) for w in re.findall(r"[^\W_]+", t.lower())])
    coded_items = {i: coded(t) for i, t in items.items()}
    want = {}
    for d, t in docs.items():
        w = coded(t)
        want[d] = any(len(x) >= 3 and np.isin(x, w).sum() >= 0.5 * len(x) and decontaminate.align(x, w) >= 0.5 * len(x) for x in coded_items.values())
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {r["doc_id"]: r["leaked"] for r in decontaminate.decontaminate(table, bench).collect()} == want and any(want.values())


def test_spots_do_not_depend_on_the_bound(monkeypatch):
    rnd = np.random.default_rng(5)
    items = decontaminate.Items.of(list(range(6)), [" ".join(f"w{rnd.integers(4)}" for _ in range(12)) for _ in range(6)], 3)
    order = np.argsort(items.owner, kind="stable")
    cuts = np.searchsorted(items.owner[order], np.arange(len(items.grams) + 1))
    row, at = np.sort(rnd.integers(0, 9, 200)), np.arange(200)
    no = rnd.integers(0, len(items.grams), 200)
    plain: dict = {}
    for r, a, g in zip(row.tolist(), at.tolist(), no.tolist()):
        for o in order[cuts[g]:cuts[g + 1]]:
            plain.setdefault((r, int(items.item[o])), []).append(a - int(items.place[o]))
    want = [(r, i, sorted(b)) for (r, i), b in sorted(plain.items())]
    for most in (1, 40, 1 << 20):
        monkeypatch.setattr(decontaminate, "SPOTS", most)
        assert list(decontaminate._spots(items, order, cuts, row, at, no)) == want


def test_decontamination_in_blocks_agrees(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = {r["doc_id"]: (r["leaked"], r["n_items"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    assert one == {r["doc_id"]: (r["leaked"], r["n_items"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert any(v[0] for v in one.values())


def test_alignment_equals_the_plain_recurrence():
    rnd = random.Random(1)
    for _ in range(60):
        a, b = [[rnd.randrange(5) for _ in range(rnd.randrange(1, 12))] for _ in range(2)]
        h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (1 if x == y else -0.5), h[i - 1][j] - 0.5, h[i][j - 1] - 0.5)
        assert decontaminate.align(np.array(a), np.array(b)) == pytest.approx(max(max(r) for r in h))


def test_line_links_by_words_equal_those_by_whole_distance(spark):
    """Pairs told word by word are those of the distance, and a long pair of as many words needs no band over all of it."""
    import time
    rnd = random.Random(11)

    def edited(words):
        return [w for x in words for w in rnd.choice([[x], [x], [x], [x + "y"], ["other"], [], [x, "more"]])]
    pairs = []
    for i in range(200):
        a = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 8))) for _ in range(rnd.randrange(0, 12))]
        b = edited(a) if i % 2 else [rnd.choice([w, w, w + "x", "z"]) for w in a]
        pairs.append((i, -i, rnd.randrange(0, 25), a, b))
    df = spark.createDataFrame(pairs, "a long, b long, most int, wa array<string>, wb array<string>").repartition(4)
    line = "CASE WHEN size({0}) > 0 THEN array_join(reverse({0}), ' ') || ' ' ELSE '' END"
    want = {r.a for r in df.where(f"levenshtein({line.format('wa')}, {line.format('wb')}) <= most").collect()}
    assert {r.a for r in fuzzy_lines._within(df).collect()} == want and 0 < len(want) < 200
    long = [f"word{i}" for i in range(20_000)]
    one = spark.createDataFrame([(1, 2, 35_000, long, [w if i % 7 else w[::-1] for i, w in enumerate(long)])], df.schema)
    start = time.time()
    fuzzy_lines._within(one).collect()
    assert time.time() - start < 15
