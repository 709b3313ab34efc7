"""URL rules, and decisions that follow aliases."""

import re

import brute
import pytest

import __spark_entry__ as contract
from flatloom.llm.url_filter import RULES, UrlRule, judged_urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return brute.lower(host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path, rules=RULES):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.name), r.verdict == "allow"), default=None)


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    found = {r[0]: tuple(r[1:]) for r in contract.queries()["op6_url_filter"](spark, sf_dir).collect()}
    for page_id, url in pages:
        host, path = parts(url)
        rule = rule_of(host, path)
        expected = (host, path, rule and rule.name, rule.verdict if rule else "allow")
        assert found[page_id] == expected


@pytest.mark.parametrize(
    "url",
    [None, "", "no scheme", "http://", "http://ORG", "http://a.ORG/", "x://y://z/p", "http://org?q=/", "http://É.com/de/", "http://borg/"],
)
def test_parts(spark, url):
    pages = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    found = judged_urls(pages).first()
    host, path = parts(url)
    rule = rule_of(host, path)
    assert (found.host, found.path, found.rule) == (host, path, rule and rule.name)


def canonical(target):
    return f'<html><head><LINK rel="canonical" href="{target}"></head>'


def test_decisions_follow_links(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=/next">'
    rows = [
        (1, "http://a.net/1", canonical("https://b.net/2")),
        (2, "http://b.net/2#top", canonical("//x.com/de/9")),  # the alias that a rule blocks is no page
        (3, "http://c.net/1", canonical("http://d.net/1")),
        (4, "http://d.net/1", canonical("http://x.com/de/8")),
        (5, "http://e.net/1", canonical("http://d.net/1")),
        (6, "http://w.org/1", canonical("http://e.net/1")),  # allowed by a rule: frees its aliases
        (7, "http://f.net/dir/page", canonical("other")),
        (8, "http://f.net/dir/other", canonical("http://x.com/de/7")),
        (9, "http://g.net/start", refresh),
        (10, "http://g.net/next", canonical("http://x.com/de/7")),
        (11, "http://x.com/de/8", None),
        (12, "http://a.net/1?q=1", None),
        (13, None, canonical("http://x.com/de/7")),
        (1, "http://a.net/1", canonical("https://b.net/2")),
    ]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    found = judged_urls(pages).select("row.page_id", "rule", "verdict").collect()
    assert len(found) == len(rows)
    verdicts = {r.page_id: r.verdict for r in found}
    blocked = {1, 2, 7, 8, 9, 10, 11}
    assert verdicts == {i: "block" if i in blocked else "allow" for i in range(1, 14)}


def test_given_redirects(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None), (2, "http://b.net/", None)], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://a.net/", "http://x.com/de/1"), ("http://b.net/", None)], "url string, target string")
    found = judged_urls(pages, html_column=None, redirects=redirects).collect()
    assert {r.row.page_id: r.verdict for r in found} == {1: "block", 2: "allow"}


def test_allow_goes_before_block_on_a_tie(spark):
    rules = (UrlRule("a.net", "/x", "block"), UrlRule("a.net", "/x", "allow"))
    pages = spark.createDataFrame([(1, "http://a.net/x", None)], "page_id long, url string, html string")
    assert judged_urls(pages, rules).first().verdict == "allow"


def test_no_pages(spark):
    assert judged_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
