"""Which of many literal patterns a text holds.

A handful of patterns is a chain of substring tests in generated code.  A long
list would make that chain, and its plan, as long as the list, and read every
text once a pattern; from ``INLINE`` patterns on the list becomes an
Aho-Corasick automaton that reads every text once, in an Arrow batch.  Both
give the same answer: the place of the first pattern of the list that is a
substring of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lists up to this length stay in generated code.
INLINE = 64
_built: dict = {}


def _automaton(patterns: tuple[str, ...], key: str):
    """The automaton of a list, built once in a worker; a pattern that comes
    twice keeps its first place."""
    import ahocorasick
    if key not in _built:
        auto = ahocorasick.Automaton()
        for place, pattern in reversed(list(enumerate(patterns))):
            if pattern:
                auto.add_word(pattern, place)
        if len(auto):
            auto.make_automaton()
        _built.clear()
        _built[key] = auto
    return _built[key]


def _finder(patterns: tuple[str, ...]):
    key = hashlib.sha256("\x00".join(patterns).encode("utf-8", "surrogatepass")).hexdigest()
    everywhere = patterns.index("") if "" in patterns else None          # the empty pattern is in every text

    def first(text: str | None, auto) -> int | None:
        if text is None:
            return None
        least = everywhere
        if len(auto):
            for _, place in auto.iter(text):
                if least is None or place < least:
                    least = place
        return least

    @F.pandas_udf("int")
    def find(texts: pd.Series) -> pd.Series:
        auto = _automaton(patterns, key)
        return pd.Series([first(t, auto) for t in texts], dtype="Int32")

    return find


def first_match(text: Column, patterns: Sequence[str], inline: int = INLINE) -> Column:
    """Place (from 0) of the first pattern that is a substring of text; NULL
    if none is, or if text is NULL.  Patterns and text are compared as they
    are."""
    if not patterns:
        return F.lit(None).cast("int")
    if len(patterns) <= inline:
        found = F.when(F.lit(False), F.lit(None).cast("int"))
        for place, pattern in enumerate(patterns):
            found = found.when(F.instr(text, pattern) > 0 if pattern else text.isNotNull(), F.lit(place))
        return found
    return _finder(tuple(patterns))(text)


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Any pattern (lower-cased) is a substring of text; false for NULL."""
    pats = [p.lower() for p in patterns]
    if len(pats) > INLINE:
        return first_match(text, pats).isNotNull()
    out = F.lit(False)
    for p in pats:
        out = out | (F.instr(text, p) > 0)
    return F.coalesce(out, F.lit(False)) if pats else out
