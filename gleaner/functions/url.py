"""URL normalisation, hashing and domain extraction.

A URL is split with the generic RFC 3986 pattern (``parse_url`` keeps host
case and returns NULL on blank parts, which changes the hash).  The query
string is rebuilt from a higher-order ``filter``/``transform`` over its
``&``-separated pairs (these run interpreted, one row at a time in the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import cached, col

# RFC 3986 appendix B: scheme, authority, path, query, fragment.
URL_RX = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Fixed value: query keys with these beginnings (any case) are tracking parameters.
TRACKING_RX = "(?i)^(utm_|fbclid|gclid|mc_|yclid|_ga|ref|source|campaign|medium|ncid|ocid|mkt_tok|s_cid|hss_channel)"


@cached
def scheme(u: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(u), URL_RX, 1))


@cached
def domain(u: Column | str) -> Column:
    """Network location lower-cased (host plus port / user info)."""
    return F.lower(F.regexp_extract(col(u), URL_RX, 2))


@cached
def path(u: Column | str) -> Column:
    return F.regexp_extract(col(u), URL_RX, 3)


@cached
def query(u: Column | str) -> Column:
    return F.regexp_extract(col(u), URL_RX, 4)


def _decode(x: Column) -> Column:
    # form decoding: '+' is a space, %XX escapes; malformed escapes stay as is
    return F.coalesce(F.try_url_decode(x), x)


def _encode(x: Column) -> Column:
    # form encoding with the unreserved set A-Z a-z 0-9 _ . - ~
    e = F.url_encode(x)
    return F.replace(F.replace(e, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_query(q: Column) -> Column:
    """Drop blank-valued and tracking parameters; group repeated keys at the
    position of their first occurrence; re-encode."""
    pairs = F.transform(
        F.split(q, "&"),
        lambda p: F.struct(
            F.instr(p, "=").alias("eq"),
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda x: (x["eq"] > 0) & (F.length(x["v"]) > 0)
                    & ~x["k"].rlike(TRACKING_RX))
    keys = F.transform(kept, lambda x: x["k"])
    ordered = F.sort_array(F.transform(
        kept,
        lambda x, i: F.struct(F.array_position(keys, x["k"]).alias("f"), i.alias("i"),
                              x["k"].alias("k"), x["v"].alias("v"))))
    return F.array_join(F.transform(
        ordered, lambda x: F.concat(_encode(x["k"]), F.lit("="), _encode(x["v"]))), "&")


@cached
def normalize_url(u: Column | str) -> Column:
    """Lower-case scheme and host, drop fragment and ``;params`` of the last
    segment, strip trailing slashes (empty path -> '/'), clean the query."""
    u = col(u)
    p = F.regexp_replace(F.regexp_replace(path(u), ";[^/]*$", ""), "/+$", "")
    p = F.when(p == "", F.lit("/")).otherwise(p)
    qs = clean_query(query(u))
    before = F.when(scheme(u) == "", F.lit("")).otherwise(F.concat(scheme(u), F.lit(":")))
    host = F.when(domain(u) == "", F.lit("")).otherwise(F.concat(F.lit("//"), domain(u)))
    return F.concat(before, host, p,
                    F.when(qs == "", F.lit("")).otherwise(F.concat(F.lit("?"), qs)))


@cached
def url_hash(u: Column | str) -> Column:
    """sha-256 hex of the normalised URL."""
    return F.sha2(normalize_url(u), 256)


# Fixed value: /Y/M/D, /YYYY-MM-DD, /YYYYMMDD segments; a segment ends at '/' or end.
URL_DATE_RX = (r"/(\d{4})/(\d{1,2})/(\d{1,2})(?:/|$)"
               r"|/(\d{4})-(\d{2})-(\d{2})(?:/|$)"
               r"|/(\d{8})(?:/|$)")


@cached
def date_from_url(u: Column | str) -> Column:
    """Leftmost URL date; year 1990-2100, month 1-12, day 1-31.

    Returns DATE; an impossible calendar day (31 Feb) is NULL."""
    u = col(u)

    def g(i: int) -> Column:
        return F.regexp_extract(u, URL_DATE_RX, i)

    compact = g(7)
    y = F.coalesce(F.nullif(g(1), F.lit("")), F.nullif(g(4), F.lit("")),
                   F.nullif(F.substring(compact, 1, 4), F.lit(""))).cast("int")
    m = F.coalesce(F.nullif(g(2), F.lit("")), F.nullif(g(5), F.lit("")),
                   F.nullif(F.substring(compact, 5, 2), F.lit(""))).cast("int")
    d = F.coalesce(F.nullif(g(3), F.lit("")), F.nullif(g(6), F.lit("")),
                   F.nullif(F.substring(compact, 7, 2), F.lit(""))).cast("int")
    ok = y.between(1990, 2100) & m.between(1, 12) & d.between(1, 31)
    ymd = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.when(ok, F.try_to_date(ymd, "yyyy-MM-dd"))
