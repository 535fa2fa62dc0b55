"""URL filters: parts of URLs, rules, shrinkage, odd rows."""

import re

import pytest
from pyspark.sql import functions as F

from filingmill.llm import urls
from filingmill.llm.queries import URL_RULES

URLS = [
    "http://A.Example.NET/en/x?y#z", "https://example.net", "x://h?q", "x://h#f/", "no scheme", "", None, "a://b://c/d", "http://É.ORG/fr/1",
    "http://user:p@Sub.Example.co.uk:80/de/", "http://example.com/de/1", "http://badexample.com/de/", "http://net/", "http://x.net./en/",
    "http:///p", "h://a\nb/c\nd?e", "http://org/fr", "http://www.org/fr/",
]


def expected(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, path


def expected_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max((r.text for r in fits), key=len, default=None)


def test_parts_rules_and_odd_rows(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h"), (None, URLS[0], "h")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(0, 0, 1, 5), (None, 1, 1, 5), (3, None, None, 5)], "doc_id long, quality int, toxic int, page_id int")
    rows = urls.judge(pages, labels, URL_RULES).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        host, path = expected(URLS[row.page_id or 0])
        assert (row.host, row.path, row.rule) == (host, path, expected_rule(host, path))
        assert row.verdict in (urls.ALLOW, urls.BLOCK)
        if row.rule:
            assert row.verdict == next(r.verdict for r in URL_RULES if r.text == row.rule)
    assert urls.judge(pages.limit(0), labels, URL_RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages, labels.limit(0), []).collect()} == {urls.BLOCK}  # a half is not tolerated


@pytest.mark.parametrize(
    ("host", "domain", "suffix"),
    [("a.b.example.com", "example.com", "com"), ("a.example.co.uk", "example.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("localhost", "localhost", "localhost"),
     ("u@a.b.org:8080", "b.org", "org"), ("", "", ""), ("a.xco.uk", "xco.uk", "uk")],
)
def test_domains(spark, host, domain, suffix):
    row = spark.range(1).select(urls.domain_of(F.lit(host)), urls.suffix_of(F.lit(host))).first()
    assert tuple(row) == (domain, suffix)


def test_reputation_shrinks(spark):
    rows = [("bad.evil.com", "evil.com", "com", 200, 190), ("new.evil.com", "evil.com", "com", 0, 0), ("one.good.com", "good.com", "com", 1, 1),
            ("big.good.com", "good.com", "com", 500, 5), ("x.fine.org", "fine.org", "org", 300, 3)]
    found = {r.host: r for r in urls.reputation(spark.createDataFrame(rows, "host string, domain string, suffix string, n long, k long")).collect()}
    assert found["bad.evil.com"].bound > 0.8 and found["big.good.com"].mean < 0.05
    assert found["new.evil.com"].mean > found["one.good.com"].mean > found["big.good.com"].mean  # from the domain
    assert all(r.bound < r.mean for r in found.values())
