"""Language identification by unigram pieces, all segmentations summed.

A word's probability in a language is the sum, over every way to cut it
into pieces of a fixed public vocabulary, of the product of the language's
piece probabilities; a forward pass over the word's positions computes that
sum without listing segmentations.  A text's score is the sum of its words'
logarithms, and the prediction the language with the largest.

Words are maximal runs of letters of the lower-cased text, so markup,
digits and punctuation carry no weight.  Piece probabilities are learned by
expectation maximisation (forward-backward counts) over the words of a
bounded sample of labelled documents per language; the model is one number
per piece and language, whatever the corpus.

Both passes run on the words of a slice at once (numpy, words of equal
length together); the scores of words already seen are kept in a bounded
cache.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import mix64

_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"
_SLICE_CHARS = 2 << 20
_CACHE_WORDS = 400_000
_TRAIN_WORD = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """The letters-only pieces of a vocabulary (with or without the word
    mark), lower-cased, up to ``longest`` characters; ``rare`` stands for
    any single character that is none of them."""

    keys: np.ndarray
    longest: int

    @classmethod
    def load(cls, model: str, longest: int = 6) -> Pieces:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        names = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not sp.is_byte(i) and not sp.is_control(i)}
        names = {n for n in names if 0 < len(n) <= longest and (n == _MARK or n.removeprefix(_MARK).isalpha())}
        codes = [np.array([[ord(c) for c in n]], np.uint64) for n in sorted(names)]
        return cls(np.unique(np.concatenate([_keys(c, 0, c.shape[1]) for c in codes])), longest)

    def __len__(self) -> int:
        return len(self.keys) + 1

    @property
    def rare(self) -> int:
        return len(self.keys)

    def ids(self, codes: np.ndarray, at: int, k: int) -> np.ndarray:
        """Piece number of characters at:at + k of every word, len(self) if
        there is none."""
        key = _keys(codes, at, k)
        pos = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[pos] == key, pos, self.rare if k == 1 else len(self))


def _keys(codes: np.ndarray, at: int, k: int) -> np.ndarray:
    h = np.full(codes.shape[0], k, np.uint64)
    for j in range(at, at + k):
        h = mix64(h + (codes[:, j] + np.uint64(1)) * _STEP)
    return h


def _by_length(words: list[str]):
    """(positions in ``words``, code points with the word mark in front)."""
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for n, at in groups.items():
        most = max(1, (1 << 18) // (n + 1))
        for lo in range(0, len(at), most):
            some = at[lo:lo + most]
            flat = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = np.full((len(some), n + 1), ord(_MARK), np.uint64)
            codes[:, 1:] = flat.reshape(len(some), n)
            yield np.array(some), codes


def forward(pieces: Pieces, prob: np.ndarray, words: list[str]) -> np.ndarray:
    """log probability of each word in each language; prob[piece, language]
    has a last row of zeros for "no such piece"."""
    out = np.zeros((len(words), prob.shape[1]))
    for at, codes in _by_length(words):
        n, length = codes.shape
        ring, log = [np.ones((n, prob.shape[1]))], np.zeros((n, prob.shape[1]))
        for j in range(1, length + 1):
            total = np.zeros((n, prob.shape[1]))
            for k in range(1, min(pieces.longest, j) + 1):
                total += ring[-k] * prob[pieces.ids(codes, j - k, k)]
            ring = [*ring[1 - pieces.longest:], total] if pieces.longest > 1 else [total]
            if j % 16 == 0:                                   # keep long words within range
                ring, log = [r / total for r in ring], log + np.log(total)
        out[at] = np.log(ring[-1]) + log
    return out


def expected(pieces: Pieces, prob: np.ndarray, words: list[str], times: np.ndarray) -> np.ndarray:
    """Expected piece counts of the words in one language (prob[piece])."""
    counts = np.zeros(len(pieces) + 1)
    for at, codes in _by_length(words):
        n, length = codes.shape
        ids = {(i, k): pieces.ids(codes, i, k) for i in range(length) for k in range(1, min(pieces.longest, length - i) + 1)}
        alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
        alpha[0] = beta[length] = 1
        for j in range(1, length + 1):
            for k in range(1, min(pieces.longest, j) + 1):
                alpha[j] += alpha[j - k] * prob[ids[j - k, k]]
        for i in range(length - 1, -1, -1):
            for k in range(1, min(pieces.longest, length - i) + 1):
                beta[i] += prob[ids[i, k]] * beta[i + k]
        weight = times[at] / alpha[length]
        for (i, k), p in ids.items():
            counts += np.bincount(p, alpha[i] * prob[p] * beta[i + k] * weight, len(counts))
    counts[-1] = 0
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    prob: np.ndarray        # (pieces + 1, languages)
    pieces: Pieces


def _held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, model: str, *, sample_docs: int = 2000, rounds: int = 2, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn piece probabilities from labelled documents outside the held-out
    third (crc32 of the id as text, modulo 3, is 1).

    About ``sample_docs`` documents per language are used, whole, chosen by a
    hash of id and text (all of them where there are fewer).  What reaches
    the driver is one number per language (counts) and one per piece and
    language (expected counts): bounded by vocabulary x languages."""
    pieces = Pieces.load(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~_held_out("id"))
    size = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(size)
    if not names:
        return LanguageModel([], np.zeros((len(pieces) + 1, 0)), pieces)
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, sample_docs / size[n]))])
    chosen = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30))

    def split(batches):
        for batch in batches:
            counts = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in _LETTERS.findall(text.lower()):
                    for at in range(0, len(w), _TRAIN_WORD):
                        counts[lang, w[at:at + _TRAIN_WORD]] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()),
                                              pa.array([k[1] for k in counts], pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    vocab = (chosen.select("text", "lang").mapInArrow(split, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")).persist())
    try:
        flat = np.full((len(pieces) + 1, len(names)), 1 / len(pieces))
        flat[-1] = 0
        prob = flat
        for _ in range(rounds):
            prob = _maximised(vocab, pieces, prob, names)
    finally:
        vocab.unpersist()
    return LanguageModel(names, prob, pieces)


def _maximised(vocab: DataFrame, pieces: Pieces, prob: np.ndarray, names: list[str], add: float = 0.1) -> np.ndarray:
    sent = vocab.sparkSession.sparkContext.broadcast((pieces, prob, names))

    def count(batches):
        pieces, prob, names = sent.value
        total = np.zeros((len(names), prob.shape[0]))
        for batch in batches:
            lang, word = np.array(batch.column(0).to_pylist(), object), np.array(batch.column(1).to_pylist(), object)
            n = batch.column(2).to_numpy().astype(float)
            for i, name in enumerate(names):
                mine = np.flatnonzero(lang == name)
                if len(mine):
                    total[i] += expected(pieces, prob[:, i], word[mine].tolist(), n[mine])
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total[at])],
                                         names=["lang", "piece", "n"])

    out = np.full(prob.shape, add)
    for r in (vocab.mapInArrow(count, "lang int, piece int, n double")
              .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()):
        out[r["piece"], r["lang"]] += round(r["n"], 6)   # sums of doubles differ in their last digits with task order
    out[-1] = 0
    return out / out.sum(axis=0)


class _Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.at: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Log likelihood of each text per language (nan: no letter)."""
        words = [_LETTERS.findall(t.lower()) for t in texts]
        if len(self.at) > _CACHE_WORDS:
            self.at.clear()
            self.rows.clear()
        new = [w for w in dict.fromkeys(w for ws in words for w in ws) if w not in self.at]
        if new:
            base = len(self.at)
            self.at.update((w, base + i) for i, w in enumerate(new))
            self.rows.append(forward(self.model.pieces, self.model.prob, new))
        table = np.concatenate(self.rows) if self.rows else np.zeros((0, len(self.model.languages)))
        self.rows = [table]
        out = np.full((len(texts), len(self.model.languages)), np.nan)
        for i, ws in enumerate(words):
            if ws:
                out[i] = table[[self.at[w] for w in ws]].sum(axis=0)
        return out


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col`` (and the columns in ``keep``),
    held_out, lang_pred, score (posterior of the prediction under equal
    priors, 0 to 1).  ``und`` with score 0: null text, no letter, or nothing
    learned.  Only the text decides a prediction."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StringType, StructType
    src = docs.select(F.col(id_col), *[F.col(c) for c in keep], *([] if text_col in keep else [F.col(text_col)]))
    kept = [id_col, *keep]
    where = src.columns.index(text_col)
    spec = StructType([src.schema[c] for c in kept]).add("lang_pred", StringType()).add("score", DoubleType())
    schema = to_arrow_schema(spec)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = _Scorer(sent.value)
        names = np.array([*sent.value.languages, "und"], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(where).to_pylist()]
            best, prob, lo = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= _SLICE_CHARS):
                    chars, hi = chars + len(texts[hi]), hi + 1
                log = score(texts[lo:hi])
                if log.shape[1]:
                    seen = ~np.isnan(log[:, 0])
                    log = log[seen]
                    top = log.argmax(axis=1)
                    best[lo:hi][seen] = top
                    prob[lo:hi][seen] = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                lo = hi
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(names[best].tolist(), pa.string()), pa.array(prob)],
                                             schema=schema)

    out = src.mapInArrow(run, spec)
    return out.select(*kept, _held_out(id_col).alias("held_out"), "lang_pred", "score")
