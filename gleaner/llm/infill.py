"""Fill-in-the-middle arrangement of whole texts with a piece table.

A document is a list of descriptors (buffer, start, end) over two buffers
that never change: the UTF-8 bytes of its Arrow batch and the sentinels.
Cutting splits the text's one descriptor at two code point borders, an
arrangement permutes the three pieces between sentinels, and the output and
its hash stream the descriptors in order.  Restoring works on the output and
its form alone: the sentinels found there cut the output into descriptors,
the inverse permutation puts them back.

Plan: two narrow passes (``arrange``, ``restore``), no shuffle; a batch is
worked off in slices of a few megabytes, so one very long text is the most a
task holds.

Defined results: null text counts as empty; empty texts and texts that hold a
sentinel are ``plain``; repeated rows give a row each (equal ids cut alike);
a null id is hashed as no digits; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import slices

#: Sentinels before prefix, suffix and middle; one buffer, addressed by descriptors.
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
_MARKS = [SENTINELS[i:i + 3] for i in range(0, 9, 3)]
#: A form lists its parts in output order: the sentinel and, after it, the piece (None: only the sentinel).
FORMS = {"psm": ((PREFIX, PREFIX), (SUFFIX, SUFFIX), (MIDDLE, MIDDLE)),
         "spm": ((SUFFIX, SUFFIX), (PREFIX, PREFIX), (MIDDLE, MIDDLE))}
TEXT, MARK = 0, 1


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the leading hex groups of the
    sha256 of ``seed:doc_id``."""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(d[i:i + 4], "big") for i in (0, 4, 8, 12))


def cut(descriptor: tuple[int, int, int], borders: tuple[int, int]) -> tuple:
    """Split one descriptor at two byte borders: prefix, suffix, middle."""
    buf, a, b = descriptor
    lo, hi = borders
    return (buf, a, lo), (buf, hi, b), (buf, lo, hi)


def arranged(pieces: tuple, form: str) -> list[tuple[int, int, int]]:
    """Descriptors of the output: sentinels and pieces in the form's order."""
    out = []
    for mark, piece in FORMS[form]:
        out += [(MARK, 3 * mark, 3 * mark + 3), pieces[piece]]
    return out


def inverse(output: bytes, form: str) -> list[tuple[int, int, int]]:
    """Descriptors over ``output`` that give the text again.  A text with a
    sentinel of its own is never arranged, so each is found once."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    at = [output.index(_MARKS[mark]) for mark, _ in FORMS[form]]
    ends = [*at[1:], len(output)]
    piece = {p: (TEXT, a + 3, e) for (_, p), a, e in zip(FORMS[form], at, ends)}
    return [piece[PREFIX], piece[MIDDLE], piece[SUFFIX]]


def stream(descriptors: list[tuple[int, int, int]], buffers: tuple) -> tuple[bytes, str]:
    """The bytes that the descriptors name, and their sha256."""
    digest, parts = hashlib.sha256(), []
    for buf, a, b in descriptors:
        part = buffers[buf][a:b]
        digest.update(part)
        parts.append(part)
    return b"".join(parts), digest.hexdigest()


def _arrange(seed: int, plain: int, spm: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string()), ("output_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(1)):
                heads = np.flatnonzero((data & 0xC0) != 0x80)             # byte places where code points begin
                first = np.searchsorted(heads, offs)
                view = memoryview(np.ascontiguousarray(data))
                cols: list[list] = [[] for _ in range(6)]
                for i, doc_id in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    a, b = int(offs[i]), int(offs[i + 1])
                    n = int(first[i + 1] - first[i])
                    h1, h2, h3, h4 = draws(doc_id, seed)
                    raw = view[a:b]
                    if n == 0 or h3 % 100 >= 100 - plain or _holds_mark(raw):
                        form, descriptors, p, m = "plain", [(TEXT, a, b)], None, None
                    else:
                        form = "spm" if h4 % 100 < spm else "psm"
                        p, e = sorted((h1 % (n + 1), h2 % (n + 1)))
                        m = e - p
                        at = [b if k == n else int(heads[first[i] + k]) for k in (p, e)]
                        descriptors = arranged(cut((TEXT, a, b), (at[0], at[1])), form)
                    text, sha = stream(descriptors, (view, SENTINELS))
                    for c, v in zip(cols, (n, form, p, m, text, sha)):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo),
                                                  *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)
    return run


def _holds_mark(raw: memoryview) -> bool:
    data = bytes(raw)
    return any(m in data for m in _MARKS)


def arrange(docs: DataFrame, *, seed: int = 1, plain: int = 10, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n (code points), form (plain, psm
    or spm), prefix_chars, middle_chars (null if plain), output (the arranged
    text) and output_sha256.

    ``plain`` percent of the documents stay as they are, ``spm`` percent of
    the others have the suffix first; both, and the two cuts, follow from the
    sha256 of ``seed`` and the id, so reruns and repeated ids agree."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType
    out = src.mapInArrow(_arrange(seed, plain, spm, to_arrow_type(kind)),
                         f"id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")
    return out.withColumnRenamed("id", id_col)


def _restore(schema: pa.Schema, output: int, form: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(output)):
                raw = data.tobytes()
                texts, hashes = [], []
                for a, b, kind in zip(offs, offs[1:], batch.column(form).slice(lo, hi - lo).to_pylist()):
                    one = raw[a:b]
                    text, sha = stream(inverse(one, kind or "plain"), (one, SENTINELS))
                    texts.append(text)
                    hashes.append(sha)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(hashes, pa.string())], schema=schema)
    return run


def restore(arranged_docs: DataFrame, *, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """The rows with the exact texts rebuilt from output and form:
    restored, restored_sha256.  A null output counts as empty, a null form as
    plain."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructType
    rows = arranged_docs.drop("restored", "restored_sha256")
    kind = StructType([*rows.schema.fields]).add("restored", StringType()).add("restored_sha256", StringType())
    return rows.mapInArrow(_restore(to_arrow_schema(kind), rows.columns.index(output_col), rows.columns.index(form_col)), kind)


#: DuckDB twin of the digests, with the defaults, over the view ``documents``.
SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS e,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
o AS (SELECT *, CASE form WHEN 'plain' THEN t
                          WHEN 'psm' THEN '<P>' || substring(t, 1, p) || '<S>' || substring(t, e + 1) || '<M>' || substring(t, p + 1, e - p)
                          ELSE '<S>' || substring(t, e + 1) || '<P>' || substring(t, 1, p) || '<M>' || substring(t, p + 1, e - p) END AS output FROM c),
r AS (SELECT *, strpos(output, '<P>') AS at_p, strpos(output, '<S>') AS at_s, strpos(output, '<M>') AS at_m FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN e - p END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substring(output, at_p + 3, at_s - at_p - 3) || substring(output, at_m + 3) || substring(output, at_s + 3, at_m - at_s - 3)
                        ELSE substring(output, at_p + 3, at_m - at_p - 3) || substring(output, at_m + 3) || substring(output, at_s + 3, at_p - at_s - 3) END) AS restored_sha256
FROM r
"""
