"""Url filter: parsing, rule precedence, aliases; components against a union-find."""

import random

from farelens.llm import urls
from farelens.llm.components import components

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def brute_components(pairs):
    root = {x: x for p in pairs if None not in p for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        if u is not None and v is not None and u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    linked = {x for u, v in pairs if None not in (u, v) and u != v for x in (u, v)}
    return {x: find(x) for x in linked}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    hub = [(500, i) for i in range(501, 700)]
    noise = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    pairs = chain + hub + noise + noise[:9] + [(7, 7), (None, 4), (3, None)]
    found = components(spark.createDataFrame(pairs, "u long, v long"))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == brute_components(pairs)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def page(link):
    return f"<html><head>{link}</head><p>x</p></html>"


def test_verdicts(spark):
    canonical = '<LINK href="{}" rel="canonical">'.format
    refresh = "<meta http-equiv='refresh' content='0; url={}'>".format
    rows = [
        (1, "http://A.Example.NET/en/x?y#z", None, "a.example.net", "/en/x", "example.net/en/",
         "allow"),
        (2, "http://net/", "", "net", "/", "net/", "block"),
        (3, "http://bad.net?q", "", "bad.net", "", None, "allow"),
        (4, None, None, "", "", None, "allow"),
        (5, "no scheme/de/", canonical("http://b.net/"), "", "", None, "allow"),
        # 6 -> 7 -> a blocked url that is not a page: both are blocked.
        (6, "https://six.org/a", page(canonical("https://seven.org/b?x=1&amp;y=2")), "six.org",
         "/a", None, "block"),
        (7, "http://SEVEN.org/b?x=1&y=2#frag", page(refresh("http://x.bad.net/")), "seven.org",
         "/b", None, "block"),
        # 8 is an alias of a blocked and of an allowed url: allow comes first.
        (8, "http://eight.com/q/w", page(canonical("/e") + refresh("//t.net/z")), "eight.com",
         "/q/w", None, "allow"),
        (9, "http://nine.org/fr/", page(canonical("http://eight.com/e")), "nine.org", "/fr/",
         "org/fr/", "allow"),
        (10, "http://example.com.evil/de/", page("<link rel=stylesheet href=//b.net/>"),
         "example.com.evil", "/de/", None, "allow"),
        (10, "http://m.example.com/de/1", None, "m.example.com", "/de/1", "example.com/de/",
         "block"),
    ]
    pages = spark.createDataFrame(
        [(r[0], r[1], r[2], "clash") for r in rows],
        "page_id long, url string, html string, verdict string")
    found = urls.judge(pages, urls.links(pages), RULES).drop("inherited").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(r[0], *r[3:]) for r in rows], key=str)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, urls.links(pages), RULES).count() == 0
