from __future__ import annotations

import pytest

from sluice.llm.queries import URL_RULES
from sluice.llm.url_filter import judge_urls

RULES = "host string, path string, verdict string"


def plain(url: str | None, rules: list[tuple], default: str = "allow") -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for mark in "/?#":
            host = host.split(mark)[0]
        path = rest[len(host):]
        path = path.split("?")[0].split("#")[0] if path.startswith("/") else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), h + p, v == "block") for h, p, v in rules
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[2], "block" if best[3] else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/EN/", "http://example.com",
    "http://.com/", "http://com/", "http://com", "http://x.net/es/1", "http://x.net/es", "http://net/fr/?q=://", "x://y://z.com/",
    "http://notexample.com/en/", "http://example.com:80/en/", "http://É.com/\nx", "http://a.b.c.d.com/#/en/", "http://a.com?x=/en/",
    "http://" + "a." * 3000 + "net/fr/", "http://example.com/en/", "http://example.com/en/",
]


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_verdicts(spark, limit):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.net/fr/", "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host string")
    found = judge_urls(pages, spark.createDataFrame(URL_RULES, RULES), max_filter_bytes=limit)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = [(r[0], *plain(r[1], URL_RULES)) for r in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_many_listed_keys_are_told_apart(spark):
    rules = [(f"h{i}.org", "/" if i % 3 else "/a", "block" if i % 2 else "allow") for i in range(0, 900, 2)]
    rules += [(f"h{i}.org", "/", "block") for i in range(1, 900, 7)] + [(None, "/", "block"), ("x.org", None, None)]
    urls = [(i, f"http://s.h{i % 1000}.org/{'a' if i % 5 else 'b'}") for i in range(3000)]
    found = judge_urls(spark.createDataFrame(urls, "page_id int, url string"), spark.createDataFrame(rules, RULES))
    usable = [r for r in rules if r[0] and r[2]]
    merged = {}
    for h, p, v in usable:
        merged[h, p] = max(merged.get((h, p), "allow"), v)
    usable = [(h, p, v) for (h, p), v in merged.items()]
    assert {tuple(r) for r in found.collect()} == {(i, *plain(u, usable)) for i, u in urls}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, RULES)
    assert judge_urls(none, rules).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert tuple(judge_urls(one, spark.createDataFrame([], RULES)).first()) == (1, "a.com", "/x", None, "allow")


def test_a_url_inside_the_query_is_no_path(spark):
    urls = ["https://www.example.com?n=http://x/en/", "https://example.com#http://a.net/es/1", "http://b.net?u=https://b.net/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = judge_urls(pages, spark.createDataFrame(URL_RULES, RULES)).collect()
    assert sorted(map(tuple, found)) == [(i, *plain(u, URL_RULES)) for i, u in enumerate(urls)]
    assert {r.path for r in found} == {""} and {r.verdict for r in found} == {"allow"}
