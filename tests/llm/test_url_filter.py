"""URL rules against brute force and SQL."""

import random

from concord.llm import url_filter


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h + p), len(h), v == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, v)
    return (host, path, best and best[1], best[2] if best else default)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.example.net", "/en/x", "block"), ("example.net", "", "allow"), ("b.org", "/f", "block"), ("org", "/fr/", "block"), ("com", "/", "allow")]
URLS = [None, "", "no scheme", "http://", "http://NET", "http://x.net", "HTTP://Example.NET/en/?q=://y.org/", "http://example.netx/en/", "http://xexample.net/en/",
        "http://a.example.net/en/xyz#f", "://org/fr/", "http://org?x/fr/", "a\nb://b.org/fr/\n", "http://.org/fr/", "http://org./fr/", "http://é.org/fr/", "http://u:p@b.org:80/f"]


def run(spark, urls, rules, cells):
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://net/", "h")], "page_id long, url string, host string")
    r = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")
    return url_filter.judge(df, r, cells=cells).collect()


def test_every_url_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["net", "example.net", "a.example.net", "z.a.example.net", "org", "b.org", "example.com", "com", "other.de"]
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(['/en/', '/en/x', '/de/', '/fr/', '/', '', '/f'])}{rng.choice(['', '?a', '#b', 'y'])}" for _ in range(300)]
    urls += ["http://a.example.net/en/hot"] * 200  # a host with a third of all pages
    for cells in (1, 7):
        got = run(spark, urls, RULES, cells)
        assert len(got) == len(urls) + 1
        for r in got:
            url = "http://net/" if r.id is None else urls[r.id]
            assert (r.host, r.path, r.rule, r.verdict) == brute(url, RULES), url


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge(none, rules).collect() == []
    got = url_filter.judge(spark.createDataFrame([(1, "http://net/")], "page_id long, url string"), rules.limit(0), default="block").collect()
    assert [tuple(r) for r in got] == [(1, "net", "/", None, "block")]
