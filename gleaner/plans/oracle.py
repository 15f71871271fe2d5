"""DuckDB SQL twins of the column functions, for the correctness oracle.

Each helper returns a SQL expression string over another SQL expression,
so every registered query has an independent ANSI-SQL statement that runs
on the raw driver tables.  Regexes are written once for both engines (no
look-around; explicit ASCII whitespace class).
"""

from __future__ import annotations

from ..functions.common import STRIP_WS, WS
from ..functions.text import ACTION_VERBS, FILLER_STARTS, SENTENCE_END, SIGNAL_PATTERNS
from ..functions.url import TRACKING_RX, URL_RX


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def nz(x: str) -> str:
    return f"coalesce({x}, '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{STRIP_WS}+|{STRIP_WS}+$')}, '', 'g')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'{STRIP_WS}+$')}, '')"


def strip_html(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '<[^>]+>', '', 'g')"


def _last_space(c: str) -> str:
    return f"(CASE WHEN instr({c}, ' ') > 0 THEN length(regexp_extract({c}, '(?s)^(.*) ', 1)) ELSE -1 END)"


def _cut(t: str, n: int) -> str:
    c = rstrip(f"substr({t}, 1, {n - 1})")
    ls = _last_space(c)
    return f"(CASE WHEN {ls} > {n * 0.6} THEN substr({c}, 1, {ls}) ELSE {c} END) || '…'"


def truncate_words(x: str, n: int) -> str:
    t = strip(nz(x))
    return f"(CASE WHEN {t} = '' THEN '' WHEN length({t}) <= {n} THEN {t} ELSE {_cut(t, n)} END)"


def make_excerpt(x: str, n: int = 120) -> str:
    t = strip(nz(x))
    t2 = strip(strip_html(t))
    return f"(CASE WHEN {t} = '' THEN '' WHEN length({t2}) <= {n} THEN {t2} ELSE {_cut(t2, n)} END)"


def sentences(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({nz(x)}, {q(SENTENCE_END)}), "
            f"lambda s: {strip('s')}), lambda s: length(s) > 10)")


def takeaway(title: str, excerpt: str, n: int = 60) -> str:
    t, e = nz(title), nz(excerpt)
    verb = q("(?i)" + ACTION_VERBS)
    text = strip(strip_html(e))
    no_filler = f"regexp_replace({text}, {q('(?i)' + FILLER_STARTS)}, '')"
    body = f"regexp_replace({strip(no_filler)}, '^[,;: ]+', '')"
    sents = sentences(body)
    with_verb = f"list_filter(list_slice({sents}, 1, 3), lambda s: regexp_matches(s, {verb}))[1]"
    return (f"(CASE WHEN {t} = '' AND {e} = '' THEN '' "
            f"WHEN length({t}) <= {n} AND regexp_matches({t}, {verb}) THEN {t} "
            f"WHEN {text} = '' THEN {truncate_words(t, n)} "
            f"WHEN {with_verb} IS NOT NULL THEN {truncate_words(with_verb, n)} "
            f"WHEN len({sents}) > 0 THEN {truncate_words(sents + '[1]', n)} "
            f"ELSE {truncate_words(body, n)} END)")


def signals(x: str) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({nz(x)}, {q('(?i)' + rx)}) THEN {q(name)} END"
                      for name, rx in SIGNAL_PATTERNS)
    return f"list_filter([{parts}], lambda s: s IS NOT NULL)"


def clip(x: str, n: int) -> str:
    return f"(CASE WHEN length({nz(x)}) > {n} THEN substr({nz(x)}, 1, {n}) || '…' ELSE {nz(x)} END)"


def stars(s: str) -> str:
    return f"(CASE WHEN {s} >= 2.0 THEN '⭐⭐⭐' WHEN {s} >= 1.5 THEN '⭐⭐' ELSE '⭐' END)"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def title_from_slug(u: str) -> str:
    slug = f"string_split(regexp_replace({u}, '/+$', ''), '/')[-1]"
    return initcap(strip(f"regexp_replace({slug}, '[-_]', ' ', 'g')"))


# --------------------------------------------------------------------- URLs
def url_part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {q(URL_RX)}, {i})"


def domain(u: str) -> str:
    return f"lower({url_part(u, 2)})"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def clean_query(qs: str) -> str:
    key = _dec("split_part(p, '=', 1)")
    val = _dec("substr(p, instr(p, '=') + 1)")
    pairs = f"list_transform(string_split({qs}, '&'), lambda p: {{'eq': instr(p, '='), 'k': {key}, 'v': {val}}})"
    kept = (f"list_filter({pairs}, lambda x: x.eq > 0 AND length(x.v) > 0 "
            f"AND NOT regexp_matches(x.k, {q(TRACKING_RX)}))")
    keys = f"list_transform({kept}, lambda y: y.k)"
    ordered = (f"list_sort(list_transform({kept}, lambda x, i: "
               f"{{'f': list_position({keys}, x.k), 'i': i, 'k': x.k, 'v': x.v}}))")
    return f"array_to_string(list_transform({ordered}, lambda x: {_enc('x.k')} || '=' || {_enc('x.v')}), '&')"


def normalize_url(u: str) -> str:
    p0 = f"regexp_replace(regexp_replace({url_part(u, 3)}, ';[^/]*$', ''), '/+$', '')"
    p = f"(CASE WHEN {p0} = '' THEN '/' ELSE {p0} END)"
    cq = clean_query(url_part(u, 4))
    before = f"CASE WHEN {url_part(u, 1)} = '' THEN '' ELSE lower({url_part(u, 1)}) || ':' END"
    host = f"CASE WHEN {domain(u)} = '' THEN '' ELSE '//' || {domain(u)} END"
    return (f"({before} || {host} || {p} || "
            f"CASE WHEN {cq} = '' THEN '' ELSE '?' || {cq} END)")


def url_hash(u: str) -> str:
    return f"sha256({normalize_url(u)})"


# --------------------------------------------------------------------- HTML
from ..functions import html as H  # noqa: E402


def unescape(x: str) -> str:
    for ent, ch in H.ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def drop_elements(h: str, tags: list[str]) -> str:
    out = f"regexp_replace({h}, {q(H.RX_COMMENT)}, '', 'g')"
    for t in tags:
        out = f"regexp_replace({out}, {q(H.rx_element(t))}, '', 'g')"
    return out


def node_text(frag: str) -> str:
    return (f"array_to_string(list_transform(regexp_split_to_array({frag}, {q(H.RX_TAG)}), "
            f"lambda x: {strip(unescape('x'))}), '')")


def node_lines(frag: str) -> str:
    return (f"array_to_string(list_filter(list_transform(regexp_split_to_array({frag}, {q(H.RX_TAG)}), "
            f"lambda x: {strip(unescape('x'))}), lambda x: x <> ''), chr(10))")


def meta_content(h: str, attr: str, value: str) -> str:
    tag = f"regexp_extract({h}, {q(H.rx_meta(attr, value))}, 0)"
    return f"regexp_extract({tag}, {q(H.RX_META_CONTENT)}, 1)"


def page_title(h0: str) -> str:
    h = drop_elements(h0, ["script", "style"])
    og = strip(unescape(meta_content(h, "property", "og:title")))
    title = strip(unescape(f"regexp_extract({h}, {q(H.RX_TITLE)}, 1)"))
    h1 = node_text(f"regexp_extract({h}, {q(H.RX_H1)}, 1)")
    return f"coalesce(nullif({og}, ''), nullif({title}, ''), {h1})"


def meta_description(h: str) -> str:
    og = strip(unescape(meta_content(h, "property", "og:description")))
    desc = strip(unescape(meta_content(h, "name", "description")))
    return f"coalesce(nullif({og}, ''), nullif({desc}, ''))"


def main_text_parts(h0: str) -> tuple[str, str]:
    """(root, noise-free html) expressions; used by main_text."""
    h = drop_elements(h0, H.NOISE_TAGS)
    root = (f"coalesce(nullif(regexp_extract({h}, {q(H.RX_ARTICLE)}, 1), ''), "
            f"nullif(regexp_extract({h}, {q(H.RX_MAIN)}, 1), ''), "
            f"nullif(regexp_extract({h}, {q(H.RX_CONTENT_DIV)}, 2), ''), "
            f"nullif(regexp_extract({h}, {q(H.RX_BODY)}, 1), ''), {h})")
    return root, h


def main_text_from_root(root: str) -> str:
    pieces = f"regexp_split_to_array({root}, {q(H.RX_P_OPEN)})[2:]"
    close_rest = f"regexp_replace(y, {q(H.RX_P_CLOSE_REST)}, '')"
    paras = (f"list_filter(list_transform({pieces}, lambda y: "
             f"{node_text(close_rest)}), "
             f"lambda z: length(z) > 20)")
    text = f"(CASE WHEN len({paras}) > 0 THEN array_to_string({paras}, chr(10) || chr(10)) ELSE {node_lines(root)} END)"
    return f"regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


# -------------------------------------------------------------------- dates
from ..functions import dates as D  # noqa: E402
from ..functions.url import URL_DATE_RX  # noqa: E402


def _ymd(y: str, m: str, d: str) -> str:
    return (f"CAST(try_strptime(printf('%04d-%02d-%02d', TRY_CAST({y} AS INTEGER), TRY_CAST({m} AS INTEGER), "
            f"TRY_CAST({d} AS INTEGER)), '%Y-%m-%d') AS DATE)")


def _month_no(w: str) -> str:
    return f"((instr({q(D._ABBR)}, lower(substr({w}, 1, 3))) + 2) // 3)"


def parse_date(raw: str) -> str:
    r = f"regexp_replace({strip(raw)}, '\\.+$', '')"
    nc = f"replace({r}, ',', '')"

    def g(rx: str, i: int) -> str:
        return f"regexp_extract({nc}, {q(rx)}, {i})"

    def m(rx: str, s: str = nc) -> str:
        return f"regexp_matches({s}, {q(rx)})"

    mdy_word = g(D.RX_MDY, 1)
    mdy_ok = (f"({m(D.RX_MDY)} AND {m(D._MONTH_WORD, mdy_word)} "
              f"AND ({g(D.RX_MDY, 2)} = '' OR length({mdy_word}) = 3))")
    dmy_word = g(D.RX_DMY, 2)
    return ("coalesce("
            f"CASE WHEN {m(D.RX_ISO)} THEN {_ymd(g(D.RX_ISO, 1), g(D.RX_ISO, 2), g(D.RX_ISO, 3))} END, "
            f"CASE WHEN {mdy_ok} THEN {_ymd(g(D.RX_MDY, 4), _month_no(mdy_word), g(D.RX_MDY, 3))} END, "
            f"CASE WHEN {m(D.RX_DMY)} AND {m(D._MONTH_WORD, dmy_word)} THEN "
            f"{_ymd(g(D.RX_DMY, 3), _month_no(dmy_word), g(D.RX_DMY, 1))} END, "
            f"CASE WHEN {m(D.RX_YMD_SLASH)} THEN {_ymd(g(D.RX_YMD_SLASH, 1), g(D.RX_YMD_SLASH, 2), g(D.RX_YMD_SLASH, 3))} END, "
            f"CASE WHEN {m(D.RX_MDY_SLASH)} THEN {_ymd(g(D.RX_MDY_SLASH, 3), g(D.RX_MDY_SLASH, 1), g(D.RX_MDY_SLASH, 2))} END, "
            f"CASE WHEN {m(D.RX_ISO_PREFIX, r)} THEN CAST(try_strptime(substr({r}, 1, 10), '%Y-%m-%d') AS DATE) END)")


def first_parsed(lst: str) -> str:
    return f"list_filter(list_transform({lst}, lambda v: {parse_date('v')}), lambda d: d IS NOT NULL)[1]"


def _nonempty(x: str) -> str:
    return f"nullif({x}, '')"


def meta_candidates(h: str) -> str:
    cands = [_nonempty(f"regexp_extract(regexp_extract({h}, {q(D.rx_meta_property(p))}, 0), {q(D.RX_CONTENT)}, 1)")
             for p in D.META_PROPERTIES]
    cands += [_nonempty(f"regexp_extract(regexp_extract({h}, {q(D.rx_meta_name(n))}, 0), {q(D.RX_CONTENT)}, 1)")
              for n in D.META_NAMES]
    return "[" + ", ".join(cands) + "]"


def jsonld_candidates(h: str) -> str:
    scripts = f"regexp_extract_all({h}, {q(D.RX_LDJSON)}, 1)"
    items = (f"coalesce(CASE WHEN starts_with({strip('s')}, '[') THEN try(from_json({strip('s')}, '[\"JSON\"]')) "
             f"ELSE [{strip('s')}] END, [])")
    graph = "coalesce(try(from_json(try(json_extract(o, '$.\"@graph\"')), '[\"JSON\"]')), [])"
    own = ("[try(json_extract_string(o, '$.datePublished')), try(json_extract_string(o, '$.dateCreated')), "
           "try(json_extract_string(o, '$.dateModified'))]")
    nodes = (f"flatten(list_transform({graph}, lambda n: [try(json_extract_string(n, '$.datePublished')), "
             f"try(json_extract_string(n, '$.dateCreated'))]))")
    per_script = f"list_transform({scripts}, lambda s: flatten(list_transform({items}, lambda o: list_concat({own}, {nodes}))))"
    return f"flatten({per_script})"


def time_candidates(h: str) -> str:
    attrs = f"regexp_extract_all({h}, {q(D.RX_TIME_ATTR)}, 1)"
    texts = f"list_transform(regexp_extract_all({h}, {q(D.RX_TIME_TEXT)}, 1), lambda t: {strip(strip_html('t'))})"
    return f"list_concat({attrs}, {texts})"


def visible_text(h0: str) -> str:
    h = f"regexp_replace({h0}, {q(D.RX_SCRIPT_STYLE)}, ' ', 'g')"
    root = (f"coalesce(nullif(regexp_extract({h}, {q(D.RX_ARTICLE)}, 1), ''), "
            f"nullif(regexp_extract({h}, {q(D.RX_MAIN)}, 1), ''), "
            f"nullif(regexp_extract({h}, {q(D.RX_BODY)}, 1), ''), {h})")
    txt = strip(f"regexp_replace(regexp_replace({root}, '<[^>]+>', ' ', 'g'), {q(WS + '+')}, ' ', 'g')")
    return txt


def text_candidates(t: str) -> str:
    return "[" + ", ".join(_nonempty(f"regexp_extract({t}, {q(rx)}, 0)") for rx in D.VISIBLE_DATE_PATTERNS) + "]"


def date_in_text(t: str) -> str:
    return first_parsed(text_candidates(t))


def visible_candidates(h: str) -> str:
    def of(e: str) -> str:
        opening = f"regexp_extract({e}, '(?s)^<[^>]*>', 0)"
        text = strip(strip_html(f"regexp_replace({e}, '</$', '')"))
        return f"[nullif(regexp_extract({opening}, {q(D.RX_DATA_DATE)}, 1), ''), {text}]"

    inner = f"regexp_extract_all(regexp_replace(e, '(?s)^<[^>]*>', ''), {q(D.RX_DATE_CLASSED)}, 0)"
    both = f"list_concat({of('e')}, flatten(list_transform({inner}, lambda y: {of('y')})))"
    classed = f"flatten(list_transform(regexp_extract_all({h}, {q(D.RX_DATE_CLASSED)}, 0), lambda e: {both}))"
    data_date = f"flatten(list_transform(regexp_extract_all({h}, {q(D.RX_DATA_ELEMENT)}, 0), lambda e: {of('e')}))"
    return f"list_concat({classed}, {data_date}, {text_candidates(visible_text(h))})"


def html_candidates(h: str) -> str:
    return (f"list_concat({meta_candidates(h)}, {jsonld_candidates(h)}, {time_candidates(h)}, "
            f"{visible_candidates(h)})")


def from_html(h: str) -> str:
    return first_parsed(html_candidates(h))


def date_from_url(u: str) -> str:
    def g(i: int) -> str:
        return f"regexp_extract({u}, {q(URL_DATE_RX)}, {i})"

    compact = g(7)
    y = f"TRY_CAST(coalesce(nullif({g(1)}, ''), nullif({g(4)}, ''), nullif(substr({compact}, 1, 4), '')) AS INTEGER)"
    mo = f"TRY_CAST(coalesce(nullif({g(2)}, ''), nullif({g(5)}, ''), nullif(substr({compact}, 5, 2), '')) AS INTEGER)"
    d = f"TRY_CAST(coalesce(nullif({g(3)}, ''), nullif({g(6)}, ''), nullif(substr({compact}, 7, 2), '')) AS INTEGER)"
    ok = f"({y} BETWEEN 1990 AND 2100 AND {mo} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31)"
    return f"CASE WHEN {ok} THEN {_ymd(y, mo, d)} END"
