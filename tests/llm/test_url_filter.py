import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepool.llm import url_filter
from tidepool.llm.queries import URL_RULES

CASES = [
    (1, None, "", "", None, "allow"), (2, "no scheme", "", "", None, "allow"),
    (3, "http://Shop.EXAMPLE.org/es/x?y=/z", "shop.example.org", "/es/x", "example.org/es/", "block"),
    (4, "https://example.org/en/12#top", "example.org", "/en/12", "example.org/en/1", "block"),
    (5, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (6, "https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    (7, "https://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    (8, "https://a.com/fr/casino-win", "a.com", "/fr/casino-win", "com/fr/", "allow"),
    (9, "https://casino-win.net/", "casino-win.net", "/", None, "block"),
    (10, "https://casino.casino.net/casino", "casino.casino.net", "/casino", None, "allow"),
    (11, "https://a.net/XXX", "a.net", "/XXX", None, "block"), (12, "https://a.net/xxxl", "a.net", "/xxxl", None, "allow"),
    (13, "http://a.org", "a.org", "", None, "allow"), (14, "://?free#bets", "", "", None, "block"),
    (15, "", "", "", None, "allow"), (15, "", "", "", None, "allow"),
    (None, "http://a.net/\nb?c", "a.net", "/\nb", None, "allow"),
]


def test_cases(spark):
    pages = spark.createDataFrame([(c[0], c[1], "x", "y") for c in CASES],
                                  "page_id long, url string, host string, verdict string")
    got = url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((c[0], *c[2:]) for c in CASES), key=key)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, URL_RULES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="xporn-./wi12Fre ads", max_size=40))
def test_hits_are_bounded_terms(url):
    terms = tuple((t, 1) for t in url_filter.STRICT_TERMS + url_filter.SOFT_TERMS)
    want = {t for t, _ in terms if re.search(f"(^|[^a-z0-9]){t}($|[^a-z0-9])", url.lower())}
    assert set(url_filter.hits(url, url_filter.automaton(tuple(terms)))) == want


@pytest.mark.parametrize("url, strict, soft", [("a.b/porn/porn", 1, 0), ("win/free", 0, 2), ("winfree", 0, 0)])
def test_distinct_terms_count(url, strict, soft):
    terms = tuple((t, 2) for t in url_filter.STRICT_TERMS) + tuple((t, 1) for t in url_filter.SOFT_TERMS)
    found = url_filter.hits(url, url_filter.automaton(terms)).values()
    assert (sum(w == 2 for w in found), sum(w == 1 for w in found)) == (strict, soft)


def test_a_very_long_url_and_rules_of_equal_length(spark):
    """The first of equally long rules in their own order gives way to the last: rules are sorted, not as given."""
    rules = [url_filter.Rule("block", "b.com", "/xx"), url_filter.Rule("allow", "com", "/xxxx")]
    urls = ["http://b.com/xxxx", "http://a.com/" + "free/" * 200_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {tuple(r)[:1] + (r["rule"], r["verdict"], r["soft_hits"]) for order in (rules, rules[::-1])
           for r in url_filter.judge_urls(pages, tuple(order)).collect()}
    assert len(got) == 2 and (1, None, "allow", 1) in got
