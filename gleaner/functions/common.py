"""Small shared Column helpers."""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as one ASCII class, written so Java regex and RE2 read it alike.
WS = "[\\t\\n\\x0B\\f\\r ]"
# What str.strip() removes: the above, other separators, no-break and ideographic spaces.
STRIP_WS = ("[\\t\\n\\x0B\\f\\r \\x1c-\\x1f\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
            "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")

# The same characters, for trimming without a regex.
STRIP_CHARS = ("\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """str.strip(): drop leading and trailing whitespace (Spark trim only drops spaces)."""
    return F.btrim(col(c), F.lit(STRIP_CHARS))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(STRIP_CHARS))


def ntz(t: _dt.datetime) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ) that does not depend on
    the session or driver time zone."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def nz(c: Column | str) -> Column:
    """NULL -> empty string."""
    return F.coalesce(col(c), F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element
    ``transform``).  Spark does not share a subexpression that sits in a
    CASE branch or is referenced many times inside another function, so
    deep string pipelines would otherwise recompute it per reference."""
    return F.get(F.transform(F.array(value), body), 0)


_PLAIN = (str, int, float, bool, type(None), _dt.date, _dt.datetime)
_BUILT: dict = {}


def _plain(v) -> bool:
    if isinstance(v, tuple):
        return all(_plain(x) for x in v)
    return isinstance(v, _PLAIN)


def cached(fn):
    """Memoise a Column builder per SparkContext when every argument is a
    plain value (column names, numbers, tuples of them).

    Building a large expression costs thousands of driver->JVM calls; the
    unresolved expression is immutable, so queries of one session share it."""
    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if not (all(_plain(a) for a in args) and all(_plain(v) for v in kwargs.values())):
            return fn(*args, **kwargs)
        sc = SparkContext._active_spark_context
        if sc is None:
            return fn(*args, **kwargs)
        key = (sc.applicationId, sc.startTime, fn.__module__, fn.__qualname__, args,
               tuple(sorted(kwargs.items())))
        hit = _BUILT.get(key)
        if hit is None:
            hit = _BUILT[key] = fn(*args, **kwargs)
        return hit
    return wrapper
