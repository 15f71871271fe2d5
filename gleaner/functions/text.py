"""Text functions: HTML stripping, word-aware truncation, sentences,
takeaways, signal detection, display clipping (B12-B17, B19-B21, A11, G11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import cached, col, let, nz, rstrip, strip

ELLIPSIS = "…"

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's lexicons to give the same result)
# ---------------------------------------------------------------------------
# Signal names and their case-insensitive patterns, in output order.
SIGNAL_PATTERNS: list[tuple[str, str]] = [
    ("has_numbers", r"\d+(\.\d+)?[%xX×]|\$\d|€\d|¥\d|\d+\s*(ms|fps|TFLOPS|GB|MB|TB)"),
    ("has_benchmark", r"(benchmark|SoTA|state.of.the.art|accuracy|F1|BLEU|perplexity)"),
    ("has_code", r"(github\.com|\.py\b|\.js\b|pip install|npm |API endpoint|SDK)"),
    ("has_data", r"(dataset|corpus|training data|fine-tun|parameter|token)"),
    ("has_comparison", r"(vs\.?|compared to|outperform|improve|faster|slower|better)"),
]
# Word stems that make a sentence an action statement (case-insensitive search).
ACTION_VERBS = (r"(introduc|announc|releas|launch|propos|present|open.?sourc|achiev|"
                r"discover|demonstrat|develop|improv|outperform|surpass|"
                r"report|show|reveal|find|build|creat|ship|deploy|partner|rais|acquir|secur)")
# Boilerplate openings removed before picking a takeaway sentence.
FILLER_STARTS = (r"^(In this (paper|article|blog|post)|We (present|propose|introduce|describe)|"
                 r"This (paper|article|blog|post)|Abstract[:\s]|TL;?DR[:\s])")
# Sentence end: one of . ! ? 。 ！ ？ ； followed by whitespace or the end.
SENTENCE_END = r"[.!?。！？；]\s+|[.!?。！？；]$"
# ---------------------------------------------------------------------------


@cached
def strip_html(c: Column | str) -> Column:
    """Remove HTML comments (across lines), then every tag; no regex runs on
    a text without a tag."""
    no_comments = F.regexp_replace(col(c), "(?s)<!--.*?-->", "")
    return F.when(F.instr(col(c), "<") > 0, F.regexp_replace(no_comments, "<[^>]+>", "")).otherwise(col(c))


def _last_space_index(c: Column) -> Column:
    """0-based index of the last ' ' in c, -1 when there is none."""
    return F.when(F.instr(c, " ") > 0,
                  F.length(F.regexp_extract(c, "(?s)^(.*) ", 1))).otherwise(F.lit(-1))


def _cut(t: Column, n: int) -> Column:
    """Word-aware cut of an already stripped, non-empty text longer than n."""
    def finish(cut: Column) -> Column:
        return let(_last_space_index(cut), lambda ls: F.concat(
            F.when(ls > F.lit(n * 0.6), F.substring(cut, F.lit(1), ls)).otherwise(cut), F.lit(ELLIPSIS)))
    return let(rstrip(F.substring(t, 1, n - 1)), finish)


def _fit(t: Column, n: int) -> Column:
    """t (stripped) as is when it fits in n chars, else cut."""
    return F.when(t == "", F.lit("")).when(F.length(t) <= n, t).otherwise(_cut(t, n))


@cached
def truncate_words(c: Column | str, n: int) -> Column:
    """strip; if longer than n: first n-1 chars, rstrip, cut back to the
    last space when it lies past 60% of n, append an ellipsis."""
    return let(strip(nz(c)), lambda t: _fit(t, n))


@cached
def make_excerpt(c: Column | str, n: int = 120) -> Column:
    """Excerpt of raw (possibly HTML) text: strip, drop markup, strip, truncate."""
    return let(strip(nz(c)), lambda t: F.when(t == "", F.lit("")).otherwise(
        let(strip(strip_html(t)), lambda t2: _fit(t2, n))))


@cached
def sentences(c: Column | str) -> Column:
    """Split at sentence ends; keep stripped pieces longer than 10 chars."""
    return _real(F.split(nz(c), SENTENCE_END))


def _real(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda s: strip(s)), lambda s: F.length(s) > 10)


def _opening(text: Column, n: int) -> Column:
    """The first n sentences.  A split that stops after a few pieces holds
    them in most texts; only a text whose opening pieces are too short or too
    few is split whole."""
    few = 4 * n

    def told(parts: Column) -> Column:
        # the last piece is the unsplit rest, if there are that many
        whole = F.size(parts) < few
        real = _real(F.when(whole, parts).otherwise(F.slice(parts, 1, few - 1)))
        return let(real, lambda r: F.when(whole | (F.size(r) >= n), r).otherwise(_real(F.split(text, SENTENCE_END))))

    return F.slice(let(F.split(text, SENTENCE_END, few), told), 1, n)


@cached
def takeaway(title: Column | str, excerpt: Column | str, n: int = 60) -> Column:
    """One line: a short title with an action verb as it is, else the first of
    the opening three sentences with one, else the opening sentence."""
    verb = "(?i)" + ACTION_VERBS
    title, excerpt = nz(title), nz(excerpt)

    def from_body(body: Column) -> Column:
        return let(_opening(body, 3), lambda sents: let(
            F.get(F.filter(sents, lambda s: s.rlike(verb)), 0),
            lambda with_verb: F.when(with_verb.isNotNull(), truncate_words(with_verb, n))
            .when(F.size(sents) > 0, truncate_words(F.get(sents, 0), n))
            .otherwise(truncate_words(body, n))))

    def from_text(text: Column) -> Column:
        # fillers are under 32 characters: most texts need no replacement
        plain = F.when(F.substring(text, 1, 32).rlike("(?i)" + FILLER_STARTS), F.regexp_replace(text, "(?i)" + FILLER_STARTS, "")).otherwise(text)
        body = F.ltrim(strip(plain), F.lit(",;: "))
        return F.when(text == "", truncate_words(title, n)).otherwise(let(body, from_body))

    return (F.when((title == "") & (excerpt == ""), F.lit(""))
            .when((F.length(title) <= n) & title.rlike(verb), title)
            .otherwise(let(strip(strip_html(excerpt)), from_text)))


@cached
def detect_signals(text: Column | str,
                   patterns: tuple[tuple[str, str], ...] = tuple(SIGNAL_PATTERNS)) -> Column:
    """Ordered array of the names of the (case-insensitive) patterns found
    in text.  Built as a concat of 0/1-element arrays so it stays in
    generated code (a filter over an array would fall back to interpreted
    evaluation of every regex)."""
    t = nz(text)
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(t.rlike("(?i)" + rx), F.array(F.lit(name))).otherwise(empty)
                      for name, rx in patterns])


@cached
def clip(c: Column | str, n: int) -> Column:
    """Hard display cut: first n chars plus an ellipsis when longer."""
    c = nz(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(ELLIPSIS))).otherwise(c)


@cached
def stars(score: Column | str) -> Column:
    s = col(score)
    return (F.when(s >= 2.0, F.lit("⭐⭐⭐")).when(s >= 1.5, F.lit("⭐⭐"))
            .otherwise(F.lit("⭐")))


@cached
def title_from_slug(url: Column | str) -> Column:
    """Last path segment, '-'/'_' to spaces, title case."""
    slug = F.element_at(F.split(F.regexp_replace(col(url), "/+$", ""), "/"), -1)
    return F.initcap(strip(F.regexp_replace(slug, "[-_]", " ")))


@cached
def doc_name(rank: Column | str, title: Column | str) -> Column:
    """``{rank:03d}_{safe title[:60]}.md``; chars other than letters, digits,
    space, '_' and '-' become '_'."""
    safe = F.substring(F.regexp_replace(nz(title), "[^\\p{L}\\p{N} _-]", "_"), 1, 60)
    return F.format_string("%03d_%s.md", col(rank), safe)


@cached
def natural_key(name: Column | str) -> Column:
    """Sort key ordering digit runs numerically and other runs case-blind.

    Digit runs become '0' + number of digits + digits (leading zeros
    dropped), text runs '1' + lower text
    + '\x01' (so a shorter run sorts before its extensions)."""
    runs = F.regexp_extract_all(nz(name), F.lit("[0-9]+|[^0-9]+"), 0)
    return F.array_join(F.transform(
        runs, lambda r: F.when(r.rlike("^[0-9]+$"),
                               let(F.regexp_replace(r, "^0+", ""), lambda d: F.concat(
                                   F.lit("0"), F.lpad(F.length(d).cast("string"), 10, "0"), d)))
        .otherwise(F.concat(F.lit("1"), F.lower(r), F.lit("\u0001")))), "")
