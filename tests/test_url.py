import datetime as dt

from conftest import one_col

from gleaner.functions import url as U


def test_normalize_url_cases(spark):
    cases = {
        "https://Blog.Ex.com/Post/?utm_source=x&id=7#frag": "https://blog.ex.com/Post?id=7",
        "https://ex.com": "https://ex.com/",
        "https://ex.com///": "https://ex.com/",
        "HTTP://EX.com/a": "http://ex.com/a",
        "https://ex.com/a?ref=1&referrer=2&source_id=3&page=2": "https://ex.com/a?page=2",
        "https://ex.com/a?b=&c": "https://ex.com/a",
        "https://ex.com/a?x=1&y=2&x=3": "https://ex.com/a?x=1&x=3&y=2",
        "https://ex.com/a?q=a%20b": "https://ex.com/a?q=a+b",
        "https://ex.com/a;v=1?x=1": "https://ex.com/a?x=1",
        "https://ex.com/a?q=x*y~z": "https://ex.com/a?q=x%2Ay~z",
        "https://ex.com/a?UTM_Medium=1&k=v": "https://ex.com/a?k=v",
    }
    got = one_col(spark, list(cases), U.normalize_url)
    assert got == list(cases.values())


def test_url_hash_matches_python(spark):
    import hashlib
    got = one_col(spark, ["https://EX.com/a/?utm_source=1"], U.url_hash)
    assert got == [hashlib.sha256(b"https://ex.com/a").hexdigest()]


def test_domain(spark):
    assert one_col(spark, ["https://Blog.Ex.com:8080/x", "ex"], U.domain) == ["blog.ex.com:8080", ""]


def test_date_from_url(spark):
    vals = ["/2026/02/28/x", "https://a.com/2026/2/8", "/2026-02-28/x", "/20260228",
            "/2026/13/01/", "/2026/02/31/", "/1980/01/01/", "/news/x"]
    got = one_col(spark, vals, U.date_from_url)
    d = dt.date
    assert got == [d(2026, 2, 28), d(2026, 2, 8), d(2026, 2, 28), d(2026, 2, 28), None, None, None, None]
