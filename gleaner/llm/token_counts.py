"""Token counts of whole texts without tokenising whole texts.

A sentencepiece BPE vocabulary in which no piece holds a space mark after
another character, nor a line break, cannot merge across the cut before a
run of spaces or around a line break.  Texts are cut there into pre-tokens;
the pieces of each distinct pre-token are counted once, and a document's
count is the sum of (frequency x pieces) over its pre-tokens.  No list of
ids is ever kept.

Plan (two exchanges, no driver step):

1. Each Arrow batch of documents is a block.  It becomes an inverted list,
   pre-token -> (row numbers, frequencies), two or three bytes a posting.
   Pre-tokens that many rows of the block share are counted in place (one
   count per block): a word of every document never becomes a hot key.
2. All postings of a pre-token meet in one partition, where its pieces are
   counted once and multiplied into partial sums per (block, row).
3. Partial sums meet their block and become one row per document.

Null text counts as empty (0 bytes, 0 tokens); rows are kept as they are
(repeated ids or null ids give a row each); other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import buffer, slices

#: Pre-tokens in at least so many rows of a block are counted in the block.
SHARED_ROWS = 16
_FLUSH = 1 << 21
_CACHE = 1 << 20


class PieceCounter:
    """Number of pieces of a pre-token, as the model gives it inside a text."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(re.search("[^▁]▁|\n", p) for p in pieces):
            raise ValueError("the vocabulary has pieces that cross a pre-token cut")
        if self.sp.normalize("a  ﬁ b ") not in ("a  ﬁ b ", "▁a▁▁ﬁ▁b▁"):
            raise ValueError("the model rewrites its input before it is cut")
        self.known: dict[str, int] = {}

    def __call__(self, tokens: list[str]) -> list[int]:
        if len(self.known) > _CACHE:
            self.known.clear()
        new = [t for t in dict.fromkeys(tokens) if t not in self.known]
        if new:
            # after a line break a text goes on without the model's first space mark;
            # that mark and the break are two tokens
            for t, ids in zip(new, self.sp.encode(["\n" + t for t in new], num_threads=1)):
                self.known[t] = len(ids) - 2
        return [self.known[t] for t in tokens]


def _pre_tokens(texts: pa.Array):
    """(pre-tokens, row of each) of all texts but empty ones, slice by slice;
    a text begins with the space that the model puts before it.  Cuts lie
    before a run of spaces and on both sides of a line break, so pre-tokens
    cover the bytes and need no copy of their own."""
    for lo, _, data, offs in slices(texts):
        rows = np.flatnonzero(np.diff(offs))
        if not len(rows):
            continue
        first = offs[rows] + np.arange(len(rows))
        led = np.full(len(data) + len(rows), 32, np.uint8)
        own = np.ones(len(led), bool)
        own[first] = False
        led[own] = data
        space, line = led == 32, led == 10
        mark = np.flatnonzero(led == 0xE2)
        mark = mark[(led[np.minimum(mark + 1, len(led) - 1)] == 0x96) & (led[np.minimum(mark + 2, len(led) - 1)] == 0x81)]
        for j in range(3):
            space[mark + j] = True
        cut = np.zeros(len(led), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        cut[first] = True
        at = np.flatnonzero(cut)
        bounds = pa.py_buffer(np.append(at, len(led)))
        tokens = pa.LargeStringArray.from_buffers(len(at), bounds, pa.py_buffer(led))
        yield tokens, np.repeat(lo + rows, np.diff(np.append(np.searchsorted(at, first), len(at))))


def _binary(values: np.ndarray, lens: np.ndarray) -> pa.Array:
    """One binary a run of values."""
    ends = np.concatenate([[0], np.cumsum(lens)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _inverted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(pre-tokens, number of rows of each, rows, frequencies), the last two
    in the order of the pre-tokens."""
    found = list(_pre_tokens(texts))
    if not found:
        return pa.array([], pa.large_string()), *(np.zeros(0, np.int64) for _ in range(3))
    coded = pa.chunked_array([t for t, _ in found]).dictionary_encode().unify_dictionaries()
    key = np.concatenate([c.indices.to_numpy().astype(np.int64) << 15 | r for c, (_, r) in zip(coded.chunks, found)])
    key.sort()
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    freqs, key = np.diff(np.append(at, len(key))), key[at]
    names = coded.chunk(0).dictionary
    return names, np.bincount(key >> 15, minlength=len(names)), key & 0x7FFF, freqs


def _postings(model: str, id_type: pa.DataType):
    schema = pa.schema([("k", pa.string()), ("block", pa.int64()), ("rows", pa.binary()), ("freqs", pa.binary()),
                        ("row", pa.int32()), ("id", id_type), ("n_bytes", pa.int64()), ("base", pa.int64())])

    def run(batches):
        count, part, seq = PieceCounter(model), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 15):
                b = batch.slice(lo, 1 << 15)
                block, seq = (part << 24) + seq, seq + 1
                names, held, rows, freqs = _inverted(b.column(1))
                base = np.zeros(b.num_rows, np.int64)
                shared = held >= SHARED_ROWS
                often = np.repeat(shared, held)
                pieces = np.array(count(names.filter(pa.array(shared)).to_pylist()), np.int64)
                np.add.at(base, rows[often], freqs[often] * np.repeat(pieces, held[shared]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"\n{block}"] * b.num_rows, pa.string()), pa.array([block] * b.num_rows, pa.int64()),
                     pa.nulls(b.num_rows, pa.binary()), pa.nulls(b.num_rows, pa.binary()),
                     pa.array(range(b.num_rows), pa.int32()), b.column(0), pa.array(np.diff(buffer(b.column(1))[1])), pa.array(base)], schema=schema)
                # one byte a frequency where all of a pre-token's fit
                most = np.zeros(len(names), np.int64)
                np.maximum.at(most, np.repeat(np.arange(len(names)), held), freqs)
                for some, kind in ((~shared & (most < 256), np.uint8), (~shared & (most >= 256), np.uint32)):
                    mine = np.repeat(some, held)
                    tokens, lens = names.filter(pa.array(some)).cast(pa.string()), held[some]
                    lists, counts = _binary(rows[mine].astype(np.uint16), lens), _binary(freqs[mine].astype(kind), lens)
                    for at in range(0, len(tokens), 1 << 16):
                        n = min(1 << 16, len(tokens) - at)
                        yield pa.RecordBatch.from_arrays(
                            [tokens.slice(at, n), pa.array([block] * n, pa.int64()), lists.slice(at, n), counts.slice(at, n),
                             pa.nulls(n, pa.int32()), pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)
    return run


def _partial_sums(model: str):
    def run(batches):
        count, keys, sums, held = PieceCounter(model), [], [], 0
        for batch in batches:
            meta = batch.filter(pa.compute.is_valid(batch.column("row")))
            if meta.num_rows:
                yield meta
            lists = batch.filter(pa.compute.is_null(batch.column("row")))
            if not lists.num_rows:
                continue
            pieces = np.array(count(lists.column("k").to_pylist()), np.int64)
            rows, at = buffer(lists.column("rows"))
            freqs, ends = buffer(lists.column("freqs"))
            lens, sizes = np.diff(at) // 2, np.diff(ends)
            key = np.repeat(lists.column("block").to_numpy() << 15, lens) | rows.view(np.uint16)
            narrow = np.repeat(sizes == lens, sizes)           # bytes of one-byte frequencies
            of = np.empty(len(key), np.int64)
            one = np.repeat(sizes == lens, lens)
            of[one], of[~one] = freqs[narrow], freqs[~narrow].view(np.uint32)
            keys.append(key)
            sums.append(of * np.repeat(pieces, lens))
            held += len(key)
            if held >= _FLUSH:
                key, value = _summed(keys, sums)
                if len(key) >= _FLUSH // 2:
                    yield _flush(key, value, batch.schema)
                    key, value = key[:0], value[:0]
                keys, sums, held = [key], [value], len(key)
        if held:
            yield _flush(*_summed(keys, sums), batch.schema)
    return run


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(block and row, sum) of each once, sorted."""
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], np.add.reduceat(value, at)


def _flush(key: np.ndarray, value: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    block, at = np.unique(key >> 15, return_index=True)
    lens = np.diff(np.append(at, len(key)))
    cols = {"block": pa.array(block), "rows": _binary((key & 0x7FFF).astype(np.uint16), lens), "freqs": _binary(value, lens)}
    return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(len(block), f.type)) for f in schema], schema=schema)


def _total(table: pa.Table) -> pa.Table:
    meta = table.filter(pa.compute.is_valid(table.column("row")))
    total = np.zeros(1 << 15, np.int64)
    for rows, vals in zip(table.column("rows").to_pylist(), table.column("freqs").to_pylist()):
        if rows:
            total[np.frombuffer(rows, np.uint16)] += np.frombuffer(vals, np.int64)
    n = meta.column("base").to_numpy() + total[meta.column("row").to_numpy()]
    return pa.table({"id": meta.column("id"), "n_bytes": meta.column("n_bytes"), "n_tokens": pa.array(n, pa.int64())})


def token_counts(docs: DataFrame, model: str, *, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_bytes (UTF-8), n_tokens (as the
    sentencepiece ``model`` file gives for the whole text, without begin or
    end tokens), over_limit (n_tokens > limit).  ``model`` is a path that
    every executor can open."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_sql = src.schema["id"].dataType.simpleString()
    posting = f"k string, block long, rows binary, freqs binary, row int, id {id_sql}, n_bytes long, base long"
    parts = (src.mapInArrow(_postings(model, to_arrow_type(src.schema["id"].dataType)), posting)
             .repartition("k").mapInArrow(_partial_sums(model), posting))
    out = (parts.drop("k").groupBy("block")
           .applyInArrow(_total, f"id {id_sql}, n_bytes long, n_tokens long"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
