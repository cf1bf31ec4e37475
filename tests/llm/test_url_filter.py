from __future__ import annotations

import random

import pytest

from airstrata.llm import url_filter
from airstrata.llm.url_filter import Rule


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        cut = min(ends) if ends else len(rest)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        ends = [tail.find(c) for c in "?#" if c in tail]
        path = tail[: min(ends)] if ends else tail
    fits = [
        (len(r.host + r.path), r.verdict, r.host + r.path)
        for r in rules
        if r.host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max((f[0] for f in fits), default=None)
    chosen = sorted((f for f in fits if f[0] == best), key=lambda f: f[1] != "block")
    return (host, path, chosen[0][2] if chosen else None, chosen[0][1] if chosen else default)


def judged(spark, pages, rules, **options):
    table = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' as host")
    found = url_filter.judge_urls(table, url_filter.rules_table(spark, rules), **options)
    return sorted(
        ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=str
    )


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_verdicts_match_brute_force(spark, range_rows):
    draw = random.Random(1)
    names = ["a", "b", "org", "com", "example", "www", "", "org\0", "x-y"]
    paths = ["", "/", "/en/", "/en/1", "/en/12", "/de", "/de/x", "/\0"]

    def host():
        return ".".join(draw.choices(names, k=draw.randrange(1, 5)))

    rules = [Rule(draw.choice(["allow", "block"]), host(), draw.choice(paths)) for _ in range(60)]
    pages = [
        (i, f"http{draw.choice(['', 's'])}://{host()}{draw.choice(paths)}{draw.choice(['', '?q=/a', '#x', 'A'])}")
        for i in range(300)
    ]
    pages += [(300, None), (301, "no scheme/org"), (302, "://"), (303, "X://ORG/En/://b"), (303, "X://ORG/En/://b"),
              (None, "http://org/"), (305, "http://a.org\n/en/1"), (306, "http://org?x/"), (307, "http://ä.org/é")]
    got = judged(spark, pages, rules, range_rows=range_rows)
    assert got == sorted(((i, *plain(u, rules)) for i, u in pages), key=str)


def test_rules_given_in_the_contract(spark):
    from airstrata.llm.queries import RULES

    pages = [(1, "http://www.example.org/es/1"), (2, "http://example.org/en/12"), (3, "http://x.org/"),
             (4, "http://x.org"), (5, "http://a.com/de/1"), (6, "http://a.com/fr/"), (7, "http://a.com/es/")]
    got = [(r[3], r[4]) for r in judged(spark, pages, RULES)]
    assert got == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
                   (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"), (None, "allow")]


def test_a_hot_host_spreads_over_ranges_and_large_ids_survive(spark):
    pages = [(2**60 + i, "http://hot.org/p") for i in range(500)] + [(1, "http://b.com/")]
    rules = [Rule("block", "hot.org", "/p"), Rule("allow", "org", "/"), Rule("block", "", "/")]
    got = judged(spark, pages, rules, range_rows=50)
    assert len(got) == 501 and {g[0] for g in got} == {p[0] for p in pages}
    assert all(g[3:] == ("hot.org/p", "block") for g in got if g[0] > 1)
    urls = spark.createDataFrame(pages, "page_id long, url string")
    keyed = urls.select(
        "page_id", url_filter.host_key(url_filter.host_of(urls.url)).alias("key"),
    ).selectExpr("*", "xxhash64(page_id, 'p') as salt")
    assert len({b for b in url_filter._borders(keyed, 50)}) > 5


def test_no_pages_and_no_rules(spark):
    assert judged(spark, [], [Rule("block", "org", "/")]) == []
    assert judged(spark, [(1, "http://a.org/x")], []) == [(1, "a.org", "/x", None, "allow")]
