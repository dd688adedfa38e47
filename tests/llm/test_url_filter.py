"""URL filter against a loop over the rules."""

import random

from staffwise.llm import queries
from staffwise.llm.url_filter import bloom_blocks, listed_urls, url_filter

ODD = [None, "", "no scheme.com/en/x", "http://", "https://COM", "https://com/", "ftp://a.EXAMPLE.com/en/1", "http://example.com/en", "http://example.com/en/",
       "http://example.com?x=/en/", "http://example.com/en/#top", "http://www.example.com/en/a?b#c", "http://notexample.com/en/a", "x://y.net/es/",
       "x://net/fr/q", "x://a.net/ES/", "a://b://example.com/en/", "http://É.Com/ü", "http://.com/", "http://com./", "http://a..com/x", "http://" + "a." * 3000 + "com/" + "y" * 9000,
       "http://user@example.com:80/en/", "http://example.com/en/\nline"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    r = url.split("://", 1)[1]
    k = min([r.index(c) for c in "/?#" if c in r] or [len(r)])
    p = r[k:]
    e = min([p.index(c) for c in "?#" if c in p] or [len(p)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[:k]), p[:e]


def brute(url, rules, otherwise):
    host, path = parts(url)
    best = None
    for h, p, v in rules:
        if h is None or p is None:
            continue
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), v, h + p))
    return (host, path, best[3], best[2]) if best else (host, path, None, otherwise)


def test_rules_of_the_query(spark):
    rng = random.Random(1)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "net", "b.net", "org", "example.org"]
    urls = ODD + [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en', '/es/', '/fr/x', '/de/'])}{rng.choice(['', '?q=/en/', '#x'])}" for _ in range(300)]
    df = spark.createDataFrame([(i % 50 or None, u, "p") for i, u in enumerate(urls + urls[:40])], "page_id long, url string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = url_filter(df, rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = got.collect()
    assert len(rows) == len(urls) + 40
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], queries.URL_RULES, "allow"), r["url"][:80]


def test_many_rules_and_a_full_filter(spark):
    rng = random.Random(2)
    label = lambda: rng.choice("abcd")
    rules = list({(".".join(label() for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choices("xy/", k=rng.randint(0, 3)))): rng.choice(["allow", "block"])
                  for _ in range(400)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [(None, "/", "block"), ("a", None, "block"), ("zz", "/", "allow"), ("zz", "/", "block")]
    urls = ["h://" + ".".join(label() for _ in range(rng.randint(1, 5))) + "/" + "".join(rng.choices("xy/", k=rng.randint(0, 5))) for _ in range(300)] + ["h://q.zz/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    used = [r for r in rules if not (r[0] == "zz" and r[2] == "allow")]
    for blocks in (1 << 17, 1):  # with one block nearly every key passes the filter
        for r in url_filter(df, table, otherwise="none", max_blocks=blocks).collect():
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], used, "none")
    assert bloom_blocks(10**12) == 1 << 17


def test_empty_tables(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    urls = spark.createDataFrame([("http://a.com/",)], "url string")
    assert url_filter(urls.limit(0), rules).count() == 0
    assert [tuple(r) for r in url_filter(urls, rules.limit(0), otherwise="block").collect()] == [("http://a.com/", "a.com", "/", None, "block")]


def test_listed_urls_become_rules(spark):
    listed = spark.createDataFrame([("HTTP://Bad.example/a?x=1",), ("http://bad.example/a#y",), (None,), ("nothing",)], "url string")
    rules = listed_urls(listed)
    assert [tuple(r) for r in rules.collect()] == [("bad.example", "/a", "block")]
    urls = spark.createDataFrame([("https://m.BAD.example/abc",), ("https://bad.example/b",)], "url string")
    assert sorted(r["verdict"] for r in url_filter(urls, rules).collect()) == ["allow", "block"]
