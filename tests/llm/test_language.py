"""Language identification: the forward sum against listed segmentations,
held-out accuracy, edge cases."""

import math
import zlib

import numpy as np

from gleaner.llm import language_id, queries
from gleaner.llm.language_id import LanguageModel, Pieces, expected, forward

SF = "/root/testdata/sf0.001"


def _toy():
    pieces = Pieces.load(queries.tokenizer_path(), longest=4)
    rnd = np.random.default_rng(1)
    prob = rnd.random((len(pieces) + 1, 2))
    prob[-1] = 0
    return pieces, prob / prob.sum(axis=0)


def _segmentations(pieces, codes, at=0):
    """All ways to cut codes[at:], as lists of piece numbers."""
    if at == codes.shape[1]:
        yield []
        return
    for k in range(1, min(pieces.longest, codes.shape[1] - at) + 1):
        p = int(pieces.ids(codes, at, k)[0])
        if p < len(pieces):
            for rest in _segmentations(pieces, codes, at + k):
                yield [p, *rest]


def test_forward_sums_all_segmentations():
    pieces, prob = _toy()
    words = ["the", "nation", "q", "été", "中", "abcabc"]
    got = forward(pieces, prob, words)
    for w, row in zip(words, got):
        codes = np.array([[ord(c) for c in "▁" + w]], np.uint64)
        total = sum(np.prod(prob[s], axis=0) for s in _segmentations(pieces, codes))
        assert np.allclose(row, np.log(total))


def test_expected_counts_are_posterior_sums():
    pieces, prob = _toy()
    counts = expected(pieces, prob[:, 0], ["nation", "the"], np.array([2.0, 1.0]))
    want = np.zeros(len(pieces) + 1)
    for w, n in (("nation", 2), ("the", 1)):
        codes = np.array([[ord(c) for c in "▁" + w]], np.uint64)
        ways = list(_segmentations(pieces, codes))
        p = np.array([np.prod(prob[s, 0]) for s in ways])
        for s, share in zip(ways, n * p / p.sum()):
            np.add.at(want, s, share)
    assert np.allclose(counts, want)


def test_long_words_do_not_underflow():
    pieces, prob = _toy()
    one, many = forward(pieces, prob, ["abc" * 3])[0], forward(pieces, prob, ["abc" * 3000])[0]
    assert np.isfinite(many).all() and (many < one * 100).all()


def test_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs, queries.tokenizer_path())
    rows = language_id.identify(docs, model, keep=("lang",)).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    rows = [(i, "the cat and the dog of the house " * 3, "en", "s") for i in range(0, 40)]
    rows += [(100 + i, "le chat et le chien de la maison " * 3, "fr", "s") for i in range(0, 40)]
    rows += [(200, None, "en", "s"), (201, "", None, "s"), (202, "123 !!", "en", "s"), (None, "the house", "en", "s"), (5, "the house", "xx", None),
             (203, "maison " * 5000, None, "s"), (204, "中文", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language_id.train(docs, queries.tokenizer_path())
    got = language_id.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (200, 201, 202))
    assert by[None]["lang_pred"] in ("en", "xx") and by[203]["lang_pred"] == "fr" and by[204]["lang_pred"] != "und"
    assert by[None]["held_out"] is False
    empty = language_id.train(docs.limit(0), queries.tokenizer_path())
    assert empty.languages == [] and language_id.identify(docs.limit(0), empty).collect() == []
    assert {r["lang_pred"] for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert isinstance(model, LanguageModel) and math.isclose(model.prob.sum(), len(model.languages))
