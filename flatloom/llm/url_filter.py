"""URL filters whose decisions follow redirects and canonical links."""

from __future__ import annotations

import html as html_text
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatloom.llm.components import components
from flatloom.scratch import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """A decision for a host with its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)

# Everything up to the first "://", the host, the path; then query and fragment.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^.*?://[^?#]*(\?[^#]*)"
_DOTS = r"/\.\.?(/|$)"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_TARGET = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def _or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_or_empty(F.regexp_extract(url, _PARTS, 1)), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return _or_empty(F.regexp_extract(url, _PARTS, 2))


def asked_path(url: Column) -> Column:
    """The path as a server is asked for it: without ``.`` and ``..`` segments, ``/`` if it is empty."""
    path = path_of(url)
    segments = F.split(F.substring(path, 2, 1 << 30), "/")
    left = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda found, x: F.when(x == "..", F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))))
        .when(x == ".", found)
        .otherwise(F.concat(found, F.array(x))),
    )
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(left, F.array(F.lit("")))).otherwise(left)
    joined = F.concat(F.lit("/"), F.array_join(ended, "/"))
    return F.when(path == "", F.lit("/")).when(F.regexp_like(path, F.lit(_DOTS)), joined).otherwise(path)


def address_of(url: Column) -> Column:
    """What a server is asked for: host, path and query, whatever the scheme and the fragment."""
    whole = F.concat(host_of(url), asked_path(url), F.regexp_extract(url, _QUERY, 1))
    return F.when(F.contains(url, F.lit("://")), whole)


def matched_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The name of the longest rule that fits, null if none does; allow goes before block.

    ``rules`` is a short list that becomes part of the expression.
    """
    found = F.lit(None).cast("string")
    # The last in this order is tested first.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        found = F.when(own & F.startswith(path, F.lit(rule.path)), F.lit(rule.name)).otherwise(found)
    return found


def _verdict(rule: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The verdict of a rule by name; of two rules with one name, allow."""
    by_name: dict[str, str] = {}
    for r in rules:
        by_name[r.name] = "allow" if "allow" in (r.verdict, by_name.get(r.name)) else r.verdict
    out = F.lit(None).cast("string")
    for name, verdict in by_name.items():
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def page_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(url, target): the canonical link and the refresh target of each page, made absolute."""
    url, html = F.col(f"`{url_column}`"), F.col(f"`{html_column}`")
    targets = F.array(
        F.regexp_extract(F.regexp_extract(html, _CANONICAL, 0), _HREF, 1),
        F.regexp_extract(F.regexp_extract(html, _REFRESH, 0), _TARGET, 1),
    )
    # Both tags are rare: most pages are let go by a plain search.
    text = F.lower(html)
    tagged = pages.filter(F.contains(text, F.lit("canonical")) | F.contains(text, F.lit("http-equiv")))
    found = tagged.select(url.alias("url"), F.explode(targets).alias("target")).filter("target != ''")
    # Both tags are rare, and so are their targets: Python knows all entities.
    found = found.withColumn("target", F.udf(html_text.unescape, "string", useArrow=True)("target"))
    target = F.col("target")
    scheme, site = F.regexp_extract("url", r"(?s)^(.*?)://", 1), F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    absolute = (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .otherwise(F.concat(folder, F.when(F.endswith(folder, F.lit("/")), "").otherwise("/"), target))
    )
    return found.filter(F.contains("url", F.lit("://"))).select("url", absolute.alias("target"))


def judged_urls(
    pages: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    url_column: str = "url",
    html_column: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """All rows of ``pages`` as ``row``, with host, path, rule and verdict.

    A page that a rule fits takes its verdict. Other pages take that of their aliases: addresses
    connected by canonical links and refreshes in ``html_column`` and by ``redirects`` (url,
    target), over any number of steps. If any alias is explicitly allowed, the page is allowed;
    else if any is blocked, it is blocked; with no decision among them it is allowed.

    Addresses are compared without scheme, fragment and dot segments; an empty path counts as ``/``. A null url or one without ``://`` has an
    empty host and path, no rule and no aliases; a null html has no links. Repeated rows are
    judged alike, other columns are kept inside ``row``, and no rows give no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_column]).alias("row")
    url = F.col(f"`{url_column}`")
    parts = pages.select(row, host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"))
    ruled = parts.withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    links = page_links(pages, url_column, html_column) if html_column else None
    if redirects is not None:
        given = redirects.select("url", "target")
        links = given if links is None else links.unionByName(given)
    if links is None:
        return ruled.select("row", "host", "path", "rule", F.coalesce(_verdict(F.col("rule"), rules), F.lit("allow")).alias("verdict"))
    links = written(links, "page-links")
    ends = links.select("url").unionByName(links.select(F.col("target").alias("url")))
    aliases = components(links.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b")))
    # A decision of each address that has a link; the path without its query is what rules see.
    own = _verdict(matched_rule(host_of(F.col("url")), asked_path(F.col("url")), rules), rules)
    decided = ends.select(address_of(F.col("url")).alias("node"), own.alias("v")).filter("v is not null").distinct()
    placed = written(aliases, "aliases")
    by_root = (
        decided.join(placed, "node")
        .groupBy("root")
        .agg(F.when(F.max(F.col("v") == "allow"), "allow").otherwise("block").alias("inherited"))
    )
    inherited = placed.join(by_root, "root").select(F.col("node").alias("address"), "inherited")
    joined = ruled.join(inherited, "address", "left")
    verdict = F.coalesce(_verdict(F.col("rule"), rules), F.col("inherited"), F.lit("allow"))
    return joined.select("row", "host", "path", "rule", verdict.alias("verdict"))
