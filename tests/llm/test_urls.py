from __future__ import annotations

import re

import pytest
from compare import connect, mismatch

from tidewatch.llm import urls
from tidewatch.llm.queries import LLM_ORACLE, LLM_REGISTRY

SCHEMA = "page_id long, url string, html string, rule int, place string"


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(url, rules=urls.RULES):
    host, path = host_path(url)
    fits = [(len(h + p), h + p, kind) for kind, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


def test_host_path_and_rule(spark):
    found = LLM_REGISTRY["op8_url_filters"](spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(found) == len(pages)
    for r in found:
        rule, kind = rule_of(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (*host_path(pages[r.page_id]), rule)
        assert r.verdict == (kind or "allow")
    assert {"allow", "block"} == {r.verdict for r in found} and any(r.rule is None for r in found)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    for name, sql in LLM_ORACLE.items():
        assert mismatch(LLM_REGISTRY[name](spark, folder), connect(folder).sql(sql)) is None


def canonical(target):
    return f'<html><head><LINK href="{target}" rel="canonical"></head></html>'


def test_decisions_spread_over_redirects_and_canonical_links(spark):
    rows = [
        (1, "http://a.org/1", canonical("https://a.org/2")), (2, "https://a.org/2#part", "<p>"),
        (3, "http://b.org/x", '<meta http-equiv="Refresh" content="0; url=https://shop.NET/fr/y">'),
        (4, "http://www.example.com/en/z", canonical("http://a.org/3")), (5, "http://a.org/3", ""),
        (6, "http://c.org/", canonical("/home")), (7, "http://c.org/home", None), (8, "http://d.org/solo", canonical("")),
        (9, "http://e.org/one", ""), (10, "http://e.org/two?q=1", ""),
    ]
    frame = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)
    hops = [("http://a.org/2", "http://m.example.com/en/q"), ("http://e.org/one", "https://e.org/two?q=1"),
            ("http://b.org/x", "http://b.org/x"), (None, "http://a.org/1"), ("no scheme", "http://d.org/solo")]
    chain = [(f"http://k.org/{k}", f"http://k.org/{k + 1}") for k in range(30)]
    redirects = spark.createDataFrame(hops + chain + [("http://k.org/30", "http://x.net/es/")], "from_url string, to_url string")
    found = {r.page_id: (r.rule, r.verdict, r.alias_of) for r in urls.judge(frame, redirects).collect()}
    assert found[1][:2] == found[2][:2] == (None, "block")  # over the link and the redirect to a blocked host
    assert found[3][:2] == (None, "block")
    assert found[4][:2] == ("www.example.com/en/", "allow") and found[5][:2] == (None, "allow")
    assert found[6][1] == found[7][1] == "allow" and found[6][2] == found[7][2] == "c.org/"
    assert found[8] == (None, "allow", "d.org/solo")
    assert found[9][2] == found[10][2] == "e.org/one"
    ends = spark.createDataFrame([(0, "http://k.org/0", "", 1, "x")], SCHEMA)
    assert urls.judge(ends, redirects).first().verdict == "block"
    # an allowed address stays allowed beside a blocked alias
    both = spark.createDataFrame([("http://www.example.com/en/z", "http://example.com/en/z")], "from_url string, to_url string")
    again = {r.page_id: r.verdict for r in urls.judge(frame, both).collect()}
    assert again[4] == "allow" and again[5] == "block"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "://", "x"), (3, "HTTP://WWW.ÄÖ.COM:80?x", ""), (4, "//no/scheme", ""),
            (5, "a://b://c/d#e", ""), (5, "a://b://c/d#e", ""), (6, "http://net/es/", "y" * 300000), (7, "http://xnet/es/", "")]
    frame = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)
    found = urls.judge(frame).collect()
    assert len(found) == len(rows)
    url = {i: u for i, u, _ in rows}
    for r in found:
        rule, kind = rule_of(url[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (*host_path(url[r.page_id]), rule, kind or "allow")
    assert urls.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize("page,target,place", [
    ("http://a.org/d/p?q=1", "//Shop.NET/es/x", "shop.net/es/x"), ("http://a.org/d/p?q=1", "page2.html", "a.org/d/page2.html"),
    ("http://a.org/d/e/p", "../x?y=../z", "a.org/d/x?y=../z"), ("http://a.org/d/e/p", "./../../../x/.", "a.org/x/"),
    ("http://a.org/d/e/p", "..", "a.org/d/"), ("http://a.org", "x", "a.org/x"), ("http://a.org", "?p=1", "a.org/?p=1"),
    ("http://a.org/d/p?q=1#f", "?p=1", "a.org/d/p?p=1"), ("http://a.org/d/p?q=1", "#part", "a.org/d/p?q=1"),
    ("http://a.org/d/", "/b/../c", "a.org/c"), ("http://a.org/d/p", "x?u=http://b.org/", "a.org/d/x?u=http://b.org/"),
    ("http://a.org/d/p", "http://b.org/?a=1&amp;b=2", "b.org/?a=1&b=2"), ("http://a.org/d/p", "?a=1&b=2", "a.org/d/p?a=1&b=2"),
    ("http://a.org/d/p", "&#47;x&#x2F;y&amp;lt;&#xE9;&#x110000;&odd;", "a.org/x/y&lt;é&"), ("http://a.org/d/p", "mailto:a@b.org", None),
])
def test_every_form_of_target_is_followed(spark, page, target, place):
    forms = [canonical(target), f'<meta http-equiv="refresh" content="0; url={target}">']
    frame = spark.createDataFrame([(1, page, h, 1, "x") for h in forms], SCHEMA)
    found = urls.page_links(frame).select(urls.place_of(urls.F.col("to_url")).alias("to")).collect()
    assert [r.to for r in found] == [place] * 2


def test_relative_links_carry_decisions(spark):
    rows = [(1, "http://a.org/d/p", canonical("//m.example.com/en/q")), (2, "http://b.net/es/z?a=1&b=2", ""),
            (3, "http://c.org/x", canonical("http://b.net/es/z?a=1&amp;b=2")), (4, "http://d.org/e/f", canonical("../g")),
            (5, "http://d.org/g", canonical("h?x")), (6, "http://d.org/h?x", canonical("http://b.net/fr/")),
            (7, "http://e.org/x", '<base href="//e.org/deep/"><base href="/no">' + canonical("y")), (8, "http://e.org/deep/y", "")]
    frame = spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)
    found = {r.page_id: (r.verdict, r.alias_of) for r in urls.judge(frame).collect()}
    assert [found[k][0] for k in (1, 2, 3, 4, 5, 6)] == ["block"] * 6
    assert found[7] == found[8] == ("allow", "e.org/deep/y")
