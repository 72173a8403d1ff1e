"""URL filter against a plain reading of the rules."""

import random

from skein.llm import url_filter as U

URLS = [None, "", "no scheme", "http://", "http://example.org", "http://example.org/",
        "HTTP://A.Example.ORG/es/x?y#z", "https://example.org/en/1", "https://example.org/en/12/3",
        "https://example.org/en/2", "https://badexample.org/es/", "x://org/en", "http://a.com/fr/",
        "http://com/de/", "http://a.com/de", "http://a.com?x=/de/", "http://a.b.c.com#/de/",
        "http://a.org.net/x", "http://a.org://b/", "http://x@example.org:80/es/", "http://.org/a",
        "http://example.org./es/", "://example.org/es/" + "p" * 5000, "http://\u0130.org/\u00e9"]


def model(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3] if fits else None, max(fits)[4] if fits else default)


def test_rules(spark):
    rng = random.Random(2)
    urls = URLS + ["".join(rng.choice(["http://", "example", ".", "org", "com", "/", "es", "en", "1",
                                       "?", "#", "A", "fr/", "de/"]) for _ in range(9))
                   for _ in range(400)]
    rows = [(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, URLS[6], "h", "v")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    rules = U.RULES + [("example.org", "/es/", "allow"), ("a.b.c.com", "", "block")]
    got = U.judge_urls(pages, U.rule_table(spark, rules)).collect()
    want = [(i, *model(u, rules)) for i, u, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, URLS[6])], "page_id long, url string")
    assert [tuple(r) for r in U.judge_urls(pages, U.rule_table(spark, []), default="block").collect()] \
        == [(1, "a.example.org", "/es/x", None, "block")]
    assert U.judge_urls(pages.where("false"), U.rule_table(spark, U.RULES)).count() == 0
