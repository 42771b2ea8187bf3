"""URL rules, and block decisions carried to aliases, in DataFrame functions only."""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
#: Rules become one expression; longer lists belong in a table joined on host suffixes.
MOST_RULES = 1000

_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.translate(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name and verdict of the longest rule that fits, or null.

    A rule fits its host and all subdomains where the path starts with the rule's. Of rules of one
    length, the first listed wins.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    parts = [F.regexp_extract(tag, rf"(?is)\b{name}{_VALUE}", k) for k in (1, 2, 3)]
    return F.replace(F.concat(*parts), F.lit("&amp;"), F.lit("&"))


def _absolute(link: Column, base: Column) -> Column:
    """``link`` as seen from the page ``base``: absolute, without a scheme, from the root or from the folder; else null."""
    scheme = F.substring_index(base, "://", 1)
    site = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*(?:/[^?#/]*(?=/))*)", 1)
    return (
        F.when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when((link == "") | link.startswith("#") | (site == ""), F.lit(None))
        .when(link.startswith("/"), F.concat(site, link))
        .when(~link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.concat(folder, F.lit("/"), link))
    )


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): the canonical links and immediate refreshes that pages declare."""
    html = F.col(html_col)
    some = F.when(html.rlike("(?i)canonical|http-equiv"), F.regexp_extract_all(html, F.lit(_TAG), F.lit(0)))
    tags = pages.where(F.col(url_col).isNotNull()).select(F.col(url_col).alias("a"), F.explode(some).alias("tag"))
    canonical = F.when(F.lower(_attribute(F.col("tag"), "rel")).rlike(r"(^|\s)canonical(\s|$)"), _attribute(F.col("tag"), "href"))
    content = F.when(F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh", _attribute(F.col("tag"), "content"))
    target = F.regexp_extract(content, r"""(?i)url\s*=\s*["']?([^"']+)""", 1)
    link = F.trim(F.coalesce(canonical, target))
    return tags.select("a", _absolute(link, F.col("a")).alias("b")).where("b is not null")


def canonical_form(url: Column) -> Column:
    """The address a site redirects to by convention: https, host in lower case, no fragment, no ``utm_`` parameters.

    Host and path stay, so by itself this form never changes what rules say.
    """
    behind = _behind_scheme(url)
    query = F.regexp_extract(behind, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.startswith("utm_") & (p != "")), "&")
    whole = F.concat(F.lit("https://"), host_of(url), path_of(url), F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.rlike(r"(?i)^https?://[^/?#]"), whole).otherwise(url)


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
    rules: tuple[Rule, ...] = RULES,
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(id, url, host, path, rule, verdict) for every row of ``pages``.

    The longest fitting rule decides. Where none fits, the decisions of all addresses decide that are
    joined with this one by redirects (``redirects`` has columns a and b), declared canonical links
    and refreshes, and canonical forms: any allowed one allows, else any blocked one blocks, else the
    address is allowed. Addresses that are only targets take part. Rows without an address have empty
    host and path and are allowed; repeated rows are returned each time; an empty table gives no rows.
    """
    known = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), *([F.col(html_col).alias("html")] if html_col else []))
    links = known.select(F.col("url").alias("a"), canonical_form(F.col("url")).alias("b"))
    declared = [declared_links(known)] if html_col else []
    for more in [*declared, *([redirects.select("a", "b")] if redirects is not None else [])]:
        links = links.unionByName(more).unionByName(more.select(F.col("b").alias("a"), canonical_form(F.col("b")).alias("b")))
    aliases = components(links, "urls")
    node = F.col("node")
    decided = aliases.withColumn("own", rule_of(host_of(node), path_of(node), rules)["verdict"])
    groups = decided.groupBy("component").agg(
        F.when(F.bool_or(F.col("own") == "allow"), F.lit("allow")).when(F.bool_or(F.col("own") == "block"), F.lit("block")).alias("carried")
    )
    # only blocked groups change anything, so only their addresses are looked up
    carried = aliases.join(groups.where("carried = 'block'"), "component").select(F.col("node").alias("url"), "carried")
    found = known.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = found.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)).join(carried, "url", "left")
    verdict = F.coalesce(F.col("own")["verdict"], F.col("carried"), F.lit("allow"))
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path", F.col("own")["rule"].alias("rule"), verdict.alias("verdict"))
