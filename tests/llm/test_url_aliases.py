"""Aliases whose addresses are written in another way than the page's."""

import pytest

from flatloom.llm.url_filter import address_of, judged_urls


@pytest.mark.parametrize(
    ("target", "page"),
    [
        ("http://d.net/1?a=1&amp;b=2", "http://d.net/1?a=1&b=2"),
        ("http://d.net/x/./../1", "http://d.net/1"),
        ("../1", "http://a.net/1"),
        ("http://d.net", "http://d.net/"),
        ("http://d.net/?q", "http://d.net?q"),
        ("http:&#47;&#x2F;d.net/1", "http://d.net/1"),
    ],
)
def test_decision_reaches_the_page(spark, target, page):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "http://a.net/dir/start", link.format("http://x.com/de/1")), (2, "http://a.net/dir/start", link.format(target)), (3, page, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.row.page_id: r.verdict for r in judged_urls(pages).collect()} == dict.fromkeys((1, 2, 3), "block")


def test_addresses(spark):
    expected = {
        "http://h": "h/", "http://H/": "h/", "http://h?q=/../": "h/?q=/../", "http://h/..": "h/", "http://h/a/.": "h/a/",
        "http://h/a/b/..": "h/a/", "http://h/a//../b": "h/a/b", "http://h/../../a": "h/a", "http://h/a/...": "h/a/...",
        "http://h/a/../b#../c": "h/b", "http://h/.a/..b/": "h/.a/..b/", "no scheme": None,
    }
    urls = spark.createDataFrame([(u,) for u in expected], "url string")
    assert {r.url: r.a for r in urls.select("url", address_of(urls.url).alias("a")).collect()} == expected
