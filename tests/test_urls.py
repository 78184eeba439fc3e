import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkmill.functions import urls as U
from linkmill.operators.url_filter import split_by_domains, usable_urls

CASES = {
    "http://a": "invalid_url",
    "http://a.b": "invalid_url",
    "http://a.b c.com/": "invalid_url",
    "www.example.com/page": "invalid_url",
    "ftp://example.com/x": "invalid_url",
    "": "invalid_url",
    "https://1.2.3.4:80/x": None,
    "HTTPS://EXAMPLE.COM": None,
    "https://example.com?x=1": None,
    "https://imgur.com/a": "blocked_domain",
    "https://i.imgur.com/a": "blocked_domain",
    "https://I.Imgur.COM/a": "blocked_domain",
    "https://imgur.com/a|b": "blocked_domain",
    "https://notimgur.com/a": None,
    "https://imgur.com.example.org/a": None,
    "https://itunes.apple.com/x": "blocked_domain",
    "https://www.itunes.apple.com/x": None,
    "https://www.apple.com/x": None,
    "https://example.com/a.PNG?x=1": "blocked_extension",
    "https://example.com/a.png#x": None,
    "https://example.com/a?f=b.png": None,
    "https://foo.zip": "blocked_extension",
    "https://example.com/a.7z": "blocked_extension",
    "https://example.com/apng": None,
}


def test_reasons(spark):
    df = spark.createDataFrame([(u,) for u in CASES], "url string")
    got = {r.url: r.reason for r in df.select("url", U.exclude_reason(F.col("url")).alias("reason")).collect()}
    assert got == CASES
    assert {r.url for r in usable_urls(df).collect()} == {u for u, reason in CASES.items() if reason is None}


def test_missing_url_is_excluded(spark):
    df = spark.createDataFrame([(None,)], "url string")
    assert df.select(U.exclude_reason(F.col("url")).alias("r")).first().r == "invalid_url"


URLISH = st.text(alphabet="htps:/.aZ09-?#@_ é\n%٣", min_size=0, max_size=18)


@settings(max_examples=5, deadline=None)
@given(st.lists(URLISH, min_size=60, max_size=60))
def test_pattern_is_the_python_pattern(spark, tails):
    urls = sorted({prefix + t for t in tails for prefix in ("", "http://", "https://a.com", "https://1.2.3.4")})
    pattern = re.compile(U.URL_PATTERN, re.IGNORECASE)
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.ok for r in df.select("url", U.is_valid(F.col("url")).alias("ok")).collect()}
    assert got == {u: len(u) > 8 and " " not in u and pattern.match(u) is not None for u in urls}


@pytest.mark.parametrize("labels", [2, 70, 2000, 20_000])
@pytest.mark.parametrize("last", ["com", "com.", "c", "a-b/x", "co m", "com:80/", "-"])
def test_hosts_of_any_length(spark, labels, last):
    url = "http://" + "a1." * labels + last
    ok = spark.createDataFrame([(url,)], "url string").select(U.is_valid(F.col("url"))).first()[0]
    assert ok == (" " not in url and re.match(U.URL_PATTERN, url, re.IGNORECASE) is not None)


@pytest.mark.parametrize(
    "url, host, base, suffix",
    [
        ("https://a.b.News.co.uk./x", "a.b.news.co.uk", "news.co.uk", "co.uk"),
        ("http://user:pw@example.com:80/x", "example.com", "example.com", "com"),
        ("http://10.0.0.1/x", "10.0.0.1", "10.0.0.1", None),
        ("//cdn.example.org?x", "cdn.example.org", "example.org", "org"),
        ("no url", None, None, None),
    ],
)
def test_hosts(spark, url, host, base, suffix):
    h = U.host(F.lit(url))
    assert tuple(spark.range(1).select(h, U.base_domain(h), U.public_suffix(h)).first()) == (host, base, suffix)


def test_domain_table(spark):
    df = spark.createDataFrame([("http://x.a.com/1",), ("http://b.org/2",), ("http://x.c.net/3",), ("bad",)], "url string")
    names = spark.createDataFrame([("a.com",), ("x.c.net",), ("b",), ("a.com",)], "domain string")
    on, off = split_by_domains(df, names)
    assert sorted(r.url for r in on.collect()) == ["http://x.a.com/1", "http://x.c.net/3"]
    assert sorted(r.url for r in off.collect()) == ["bad", "http://b.org/2"]


SUFFIX_LIST = """
// a comment
com
co.uk
*.kawasaki.jp
!city.kawasaki.jp
jp
*.ck   // ends at white space
!www.ck
b.c.kobe.jp
"""


@pytest.mark.parametrize(
    "host, suffix, base",
    [
        ("a.b.kawasaki.jp", "b.kawasaki.jp", "a.b.kawasaki.jp"),
        ("x.a.b.kawasaki.jp", "b.kawasaki.jp", "a.b.kawasaki.jp"),
        ("b.kawasaki.jp", "b.kawasaki.jp", "b.kawasaki.jp"),
        ("kawasaki.jp", "jp", "kawasaki.jp"),
        ("city.kawasaki.jp", "kawasaki.jp", "city.kawasaki.jp"),
        ("www.city.kawasaki.jp", "kawasaki.jp", "city.kawasaki.jp"),
        ("www.ck", "ck", "www.ck"),
        ("a.www.ck", "ck", "www.ck"),
        ("a.other.ck", "other.ck", "a.other.ck"),
        ("x.a.b.c.kobe.jp", "b.c.kobe.jp", "a.b.c.kobe.jp"),
        ("x.c.kobe.jp", "jp", "kobe.jp"),
        ("a.b.co.uk", "co.uk", "b.co.uk"),
        ("a.b.unknown", "unknown", "b.unknown"),
        ("localhost", None, "localhost"),
        ("10.0.0.1", None, "10.0.0.1"),
    ],
)
def test_wildcards_and_exceptions(spark, host, suffix, base):
    rules = U.SuffixRules.parse(SUFFIX_LIST.splitlines())
    h = F.lit(host)
    row = spark.range(1).select(U.public_suffix(h, rules).alias("suffix"), U.base_domain(h, rules).alias("base")).first()
    assert (row.suffix, row.base) == (suffix, base)
    assert spark.range(1).select(U.is_blocked_domain(F.lit(f"http://{host}/x"), [base], rules)).first()[0]
