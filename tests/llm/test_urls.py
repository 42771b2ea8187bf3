import pytest

from seqloom.llm import urls
from seqloom.llm.queries import op3_urls

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", "x", "no scheme/here", "http://", "HTTP://Example.NET/en/x", "https://a.EXAMPLE.net/en/", "http://notexample.net/en/", "http://net/", "http://net", "x://y.org/fr/?q", "x://y.org/fr",
    "a://b://c.net/", "http://a.example.com/de/1", "http://example.com/DE/1", "http://é.NET/x", "http://h.net?x/", "http://h.net#/", "http://h.org/fr/#a", "http://u@h.net:80/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def ruled(url):
    host, path = parts(url)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (host, path, best.name if best else None, best.verdict if best else None)


def test_query_equals_brute_force(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op3_urls(spark, SF_DIR).collect()}
    assert set(found) == set(pages)
    for page, url in pages.items():
        host, path, rule, verdict = ruled(url)
        assert found[page] == (host, path, rule, verdict or "allow")


def judge(spark, rows, redirects=None, rules=urls.RULES):
    frame = spark.createDataFrame(rows, "page_id int, url string, html string, verdict int, node string")
    more = spark.createDataFrame(redirects, "a string, b string") if redirects else None
    return {r.page_id: r for r in urls.judge_urls(frame, redirects=more, rules=rules).collect()}


def test_odd_addresses(spark):
    found = judge(spark, [(k, u, None, 1, "x") for k, u in enumerate(ODD)])
    for k, url in enumerate(ODD):
        host, path, rule, verdict = ruled(url)
        assert (found[k].host, found[k].path, found[k].rule, found[k].verdict) == (host, path, rule, verdict or "allow"), url


def test_blocks_reach_aliases_unless_one_is_allowed(spark):
    page = lambda n, url, html=None: (n, url, html, 0, "")
    link = lambda to: f"<html><LINK href='{to}' media=x rel=\"canonical\"><link rel=icon href=http://z.net/i>"
    rows = [
        page(1, "http://a.org/x", link("http://b.org/x")),
        page(2, "http://c.org/y?utm_source=q#f", '<meta http-equiv="Refresh" content="0; URL=http://bad.net/?a=1&amp;b=2">'),
        page(3, "https://c.org/y"),
        page(4, "http://d.org/z", link("//bad.net/")),
        page(5, "http://d.org/z#part"),
        page(6, "http://e.org/q", link("/fr/q")),
        page(7, "http://f.org/en/q"),
        page(8, "http://g.org/w/v?k", link("other.html")),
        page(9, "http://h.org/only", link("http://example.net/en/ok")),
        page(10, "http://bad.net/1", link("http://e.org/fr/q")),
        page(11, "http://i.org/p"),
        page(12, "http://i.org/p"),
        page(13, "http://j.org/x", link("mailto:x") + link("#") + link("")),
    ]
    redirects = [("http://b.org/x", "http://bad.net/x"), ("http://f.org/en/q", "http://g.org/w/other.html"), ("http://i.org/p", "http://s.net"), (None, "http://j.org/x")]
    found = {k: r.verdict for k, r in judge(spark, rows, redirects).items()}
    # 6 and 10 share an address that is allowed; 10 keeps the verdict of its own rule
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "block", 11: "allow", 12: "allow", 13: "allow"}
    found = judge(spark, rows, [("http://i.org/p", "http://s.net/")])
    assert (found[11].verdict, found[12].verdict) == ("block", "block")
    rows += [page(14, "http://k.org/fr/a", link("http://k.org/b")), page(15, "http://k.org/b", link("http://bad.net/k"))]
    found = judge(spark, rows)
    assert (found[14].rule, found[14].verdict, found[15].rule, found[15].verdict) == ("org/fr/", "allow", None, "allow")


def test_longest_rule_and_empty_table(spark):
    rules = (urls.Rule("a.b", "/x", "block"), urls.Rule("a.b", "/", "allow"), urls.Rule("a.b", "/x/y", "allow"))
    rows = [(1, "q://c.a.b/x/y", None, 0, ""), (2, "q://a.b/xz", None, 0, ""), (3, "q://a.b/", None, 0, ""), (4, "q://xa.b/x", None, 0, "")]
    assert {k: (r.rule, r.verdict) for k, r in judge(spark, rows, rules=rules).items()} == {1: ("a.b/x/y", "allow"), 2: ("a.b/x", "block"), 3: ("a.b/", "allow"), 4: (None, "allow")}
    assert judge(spark, []) == {}
    with pytest.raises(ValueError, match="rules"):
        judge(spark, [], rules=rules * 400)
