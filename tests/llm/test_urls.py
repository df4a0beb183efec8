"""URL filters: rules, spellings, and decisions that reach aliases."""

import pytest
from pyspark.sql import functions as F

from tierlake.llm.url_filters import parts, plain, rules, verdicts

GIVEN = rules("block net/, allow example.net/en/, block example.com/de/, allow org/fr/")


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, "x", "y", "z") for i, u, h in rows], "page_id long, url string, html string, node string, class string, verdict string"
    )


def got(spark, rows, redirects=None):
    logged = None if redirects is None else spark.createDataFrame(redirects, "from_url string, to_url string")
    return {r.page_id: (r.rule, r.verdict) for r in verdicts(pages(spark, rows), GIVEN, logged).collect()}


def test_parts(spark):
    cases = {
        None: ("", ""), "": ("", ""), "example.net/en/": ("", ""), "http://": ("", ""), "HTTP://EXAMPLE.Net": ("example.net", ""),
        "a?b://X.org:80/P/q?r#s": ("x.org:80", "/P/q"), "http://É.org/ä#x?y": ("É.org", "/ä"), "x://h?q/p": ("h", ""), "x://h#://k/": ("h", ""),
    }
    df = pages(spark, [(i, u, None) for i, u in enumerate(cases)])
    assert {r.url: (r.host, r.path) for r in parts(df, "url").collect()} == cases


@pytest.mark.parametrize("one,other,same", [
    ("http://www.A.org/x/", "https://a.org/x", True), ("http://a.org:80/x#y", "http://a.org/x", True),
    ("http://a.org/x?utm_source=f&b=1&ref=z", "http://a.org/x?b=1", True), ("http://a.org/x?b=1&a=2", "http://a.org/x?a=2&b=1", True),
    ("http://m.org/x", "http://org/x", False), ("http://a.org/X", "http://a.org/x", False), ("http://a.org/x?b=1", "http://a.org/x", False),
])
def test_spellings(spark, one, other, same):
    a, b = (r[0] for r in spark.createDataFrame([(one,), (other,)], "u string").select(plain(F.col("u"))).collect())
    assert (a == b) == same


def test_longest_rule_wins(spark):
    rows = [
        (1, "http://a.example.net/en/1", None), (2, "http://example.net/e", None), (3, "http://example.net/en/", ""), (4, "http://notexample.com/de/", None),
        (5, "http://EXAMPLE.com/de/x", None), (6, "http://example.com", None), (7, "http://net", None), (8, "http://net/", None), (9, None, None), (9, "", None),
        (10, "https://x.org/fr/", "<p>"), (11, "https://org/fr/", None), (12, "https://example.com/DE/", None),
    ]
    want = {
        1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: ("example.net/en/", "allow"), 4: (None, "allow"), 5: ("example.com/de/", "block"),
        6: (None, "allow"), 7: (None, "block"), 8: ("net/", "block"), 9: (None, "allow"), 10: ("org/fr/", "allow"), 11: ("org/fr/", "allow"), 12: (None, "allow"),
    }
    assert got(spark, rows) == want  # 7 is a spelling of 8
    assert got(spark, []) == {}


def test_decisions_reach_aliases(spark):
    rows = [
        (1, "http://spam.net/a", '<link rel="canonical" href="https://mirror.com/a">'),
        (2, "https://www.mirror.com/a?utm_source=x", None),
        (3, "http://other.com/b", "<META http-equiv=refresh content='0; url=/c'>"),
        (4, "http://other.com/c", '<link href="//mirror.com/a" rel="canonical"/>'),
        (5, "http://free.com/x", '<link rel="canonical" href="http://x.org/fr/y">'),
        (6, "http://x.net/y", '<link rel="canonical" href="http://x.org/fr/y">'),
        (7, "http://x.org/fr/y", None), (8, "http://lone.com/", '<a href="http://spam.net/a">refresh</a>'), (9, "http://later.com/", None),
        (10, "http://x.net/y", None),
    ]
    want = {
        1: ("net/", "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "block"), 5: (None, "allow"), 6: ("net/", "block"),
        7: ("org/fr/", "allow"), 8: (None, "allow"), 9: (None, "block"), 10: ("net/", "block"),
    }
    assert got(spark, rows, [("http://later.com", "http://spam.net/a"), (None, "http://later.com"), ("http://later.com", None)]) == want


def test_long_chains(spark):
    rows = [(i, f"http://h{i}.com/", f'<link rel="canonical" href="http://h{i + 1}.com/">') for i in range(40)] + [(40, "http://h40.com/", None)]
    assert {v for _, v in got(spark, rows).values()} == {"allow"}
    rows += [(41, "http://bad.net/", '<link rel="canonical" href="http://h17.com/">')]
    assert {v for _, v in got(spark, rows).values()} == {"block"}
