r"""Secret scan: a trigram index decides which texts a rule's regular
expression is run on.

Every rule's expression is turned into a Boolean query over lower-cased
trigrams that any match must contain.  Each slice of an Arrow batch is an
index segment: the positions of all trigrams that some rule asks for become
sorted posting lists; a rule's query is answered by intersecting and uniting
them, and only the surviving texts are searched with the expression itself.
Rules without a mandatory trigram (a bare character class) scan every text.
The index never leaves its task, so nothing is shuffled and a lost executor
costs only its own splits.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import slices

try:
    from re import _constants as C
    from re import _parser as parser
except ImportError:  # Python before 3.11
    import sre_constants as C
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern``
    whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    flags: int = re.ASCII
    base: bool = field(default=False)


#: The base kinds, in their order, and further well-known token formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         re.ASCII | re.IGNORECASE, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", 24, base=True),   # same matches as whole runs of 24 and more characters
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9]+-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
)

# A query is None (no condition), a 3-byte trigram, or (op, [queries]) with op "and" / "or".
_MOST_STRINGS = 64


def _both(op: str, parts: list):
    parts = [p for p in parts if p is not None]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else (op, parts)


def _either(parts: list):
    return None if not parts or any(p is None for p in parts) else _both("or", parts)


def _of_strings(strings: set[str]):
    """Condition that one of the strings occurs."""
    return _either([_both("and", [s[i:i + 3].encode() for i in range(len(s) - 2)]) for s in sorted(strings)])


def _cross(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= _MOST_STRINGS else None


def _strings(tree) -> set[str] | None:
    """All strings (lower-cased) the tree can match, if they are few."""
    out: set[str] | None = {""}
    for op, arg in tree:
        one = None
        if op is C.LITERAL and arg < 128:
            one = {chr(arg).lower()}
        elif op is C.IN and all(k is C.LITERAL and v < 128 for k, v in arg):
            one = {chr(v).lower() for _, v in arg}
        elif op is C.AT:
            one = {""}
        elif op is C.SUBPATTERN:
            one = _strings(arg[3])
        elif op is C.BRANCH:
            each = [_strings(t) for t in arg[1]]
            one = None if None in each else set().union(*each)
        elif op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 4:
            item, one = _strings(arg[2]), set()
            for n in range(arg[0], arg[1] + 1) if item is not None else ():
                power: set[str] | None = {""}
                for _ in range(n):
                    power = None if power is None else _cross(power, item)
                one = None if one is None or power is None else one | power
            one = None if item is None else one
        out = None if one is None else _cross(out, one)
        if out is None or len(out) > _MOST_STRINGS:
            return None
    return out


def _query(tree, run: set[str]):
    """(condition of what ended, strings the open run can be)."""
    parts = []

    def close(last: set[str]) -> set[str]:
        parts.append(_of_strings(last))
        return {""}

    for op, arg in tree:
        one = _strings([(op, arg)])
        joined = None if one is None else _cross(run, one)
        if joined is not None:
            run = joined
        elif op is C.SUBPATTERN:
            inner, run = _query(arg[3], run)
            parts.append(inner)
        elif op is C.BRANCH:
            run = close(run)
            parts.append(_either([trigram_query_of(t) for t in arg[1]]))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            inner, last = _query(arg[2], run)
            parts.append(inner)
            run = close(last)
        else:
            run = close(run)
    return _both("and", parts), run


def trigram_query_of(tree):
    inner, run = _query(tree, {""})
    return _both("and", [inner, _of_strings(run)])


def trigram_query(pattern: str, flags: int = re.ASCII):
    """Boolean query that every text with a match satisfies; None: any text
    can match.  Expressions over ASCII, folded to lower case."""
    return trigram_query_of(parser.parse(pattern, flags))


def _trigrams(query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Segment:
    """Posting lists (row numbers) of the wanted trigrams over a slice."""

    _fold = np.arange(256, dtype=np.uint8)
    _fold[65:91] += 32

    def __init__(self, wanted: np.ndarray, table: np.ndarray, data: np.ndarray, offs: np.ndarray):
        self.lists: dict[int, np.ndarray] = {}
        if len(data) < 3:
            return
        low = self._fold[data].astype(np.uint32)
        code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
        at = np.flatnonzero(table[code])
        row = np.searchsorted(offs, at, "right") - 1
        inside = at + 3 <= offs[row + 1]
        code, row = code[at[inside]], row[inside]
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        cuts = np.searchsorted(code, wanted), np.searchsorted(code, wanted, "right")
        for c, a, b in zip(wanted.tolist(), *cuts):
            if b > a:
                self.lists[c] = np.unique(row[a:b])

    def rows(self, query) -> np.ndarray:
        if isinstance(query, bytes):
            return self.lists.get(int.from_bytes(query, "big"), np.zeros(0, np.int64))
        op, parts = query
        out = self.rows(parts[0])
        for p in parts[1:]:
            if op == "and" and not len(out):
                break
            out = np.intersect1d(out, self.rows(p), True) if op == "and" else np.union1d(out, self.rows(p))
        return out


def find(rule: Rule, rx: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in rx.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(rules: tuple[Rule, ...], schema: pa.Schema):
    plans = [trigram_query(r.pattern, r.flags) for r in rules]
    wanted = np.array(sorted(int.from_bytes(t, "big") for t in set().union(*map(_trigrams, plans))), np.uint32)

    def run(batches):
        regexes = [re.compile(r.pattern, r.flags) for r in rules]
        table = np.zeros(1 << 24, bool)
        table[wanted] = True
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo)
                index, spans = Segment(wanted, table, data, offs), [[] for _ in range(hi - lo)]
                for order, (rule, rx, plan) in enumerate(zip(rules, regexes, plans)):
                    for i in range(hi - lo) if plan is None else index.rows(plan).tolist():
                        if text := texts[i].as_py():
                            spans[i] += [(s, order, e) for s, e in find(rule, rx, text)]
                yield _result(rules, batch.column(0).slice(lo, hi - lo), spans, schema)
    return run


def _result(rules, ids, spans, schema) -> pa.RecordBatch:
    rows = {f.name: [] for f in schema}
    for found in spans:
        found.sort()
        named = [(f"{rules[k].kind}:{s}:{e}", rules[k]) for s, k, e in found]
        rows["base_sha256"].append(hashlib.sha256(",".join(t for t, r in named if r.base).encode()).hexdigest())
        rows["spans"].append(",".join(t for t, _ in named))
        rows["n_spans"].append(len(named))
        for r in rules:
            if r.base:
                rows[f"n_{r.kind}"].append(sum(x.kind == r.kind for _, x in named))
    rows["id"] = ids
    return pa.RecordBatch.from_arrays([rows[f.name] if f.name == "id" else pa.array(rows[f.name], f.type) for f in schema],
                                      schema=schema)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_<kind> for every base rule,
    base_sha256 (of the base spans ``kind:start:end``, ordered by start, then
    by the rules' order, comma-joined), spans (all of them, joined likewise),
    n_spans.  Offsets are code points, ends exclusive.  Null or empty text
    has no spans; repeated rows give a row each; other columns are ignored."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = [f"n_{r.kind}" for r in rules if r.base]
    schema = pa.schema([("id", to_arrow_type(src.schema["id"].dataType)), *((k, pa.int64()) for k in kinds),
                        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])
    sql = f"id {src.schema['id'].dataType.simpleString()}, " + "".join(f"{k} long, " for k in kinds) + \
        "base_sha256 string, spans string, n_spans long"
    return src.mapInArrow(_scan(rules, schema), sql).withColumnRenamed("id", id_col)
