"""URL filters against a plain search through all entries."""

import random
from collections import Counter

import pytest

from cardloom.llm import queries, urlfilter

PAGES = "page_id long, url string, html string, host string, verdict string, n int"


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:end]), rest[end:]
        path = path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    fits = [(len(h) + len(p), len(h), v, h.lower() + p) for h, p, v in rules
            if None not in (h, p, v) and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    *_, verdict, rule = max(fits, default=(default, None))
    return host, path, rule, verdict


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(3)
    hosts = ["com", "Example.COM", "www.example.com", "a.b.example.com", "notexample.com", "x.net", "net", "", ".com", "a..com", "éx.com", "example.com:80", "com."]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/1/2", "/fr/", "/enx", "//en/", "/EN/", "/en/" + "p/" * 2000, "/é/ü", "/a\nb/c", "?q=/en/", "#/en/", "/fr/a?b#c"]
    found = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths]
    found += [None, "", "no scheme/en/", "a:/b", "http://a://b/en/", "://example.com/en/", "x" * 100_000, "http://" + "a." * 300 + "com/en/z"]
    found += rng.choices(found, k=50)
    return [(None if i % 17 == 5 else i, u, "<p>", "host", "odd", 3) for i, u in enumerate(found)]


RULES = [*urlfilter.ENTRIES, ("example.com", "/e", "allow"), ("EXAMPLE.com", "/en/x", "block"), ("example.com", "/en/x", "allow"), ("b.example.com", "", "block"),
         ("com", "/en/p/p/", "block"), ("a.com", "/", "block"), (".com", "/", "block"), ("", "", "other"), ("com", "/a\nb/", "block"), (None, "/", "block"), ("net", None, "block")]


@pytest.mark.parametrize("bound", [urlfilter.BOUND, 0])
@pytest.mark.parametrize("rules", [urlfilter.ENTRIES, RULES, []])
def test_the_longest_entry_wins(spark, urls, rules, bound):
    table = spark.createDataFrame(urls, PAGES).repartition(4)
    judged = urlfilter.judge(table, spark.createDataFrame(rules, urlfilter.RULES), default="unsure", bound=bound)
    assert judged.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert Counter(map(tuple, judged.collect())) == Counter((r[0], *plain(r[1], rules, "unsure")) for r in urls)
    assert urlfilter.judge(table.where("false"), spark.createDataFrame(rules, urlfilter.RULES), bound=bound).collect() == []


def test_a_trie_of_many_entries_equals_a_search_through_them(spark):
    rng = random.Random(8)
    names = [f"{a}.{b}" for a in "abcdefgh" for b in ("com", "net", "org")]
    rules = [(rng.choice(names), "/" + "".join(rng.choice(["x/", "y/", "z"]) for _ in range(rng.randrange(4))), rng.choice(["allow", "block"])) for _ in range(300)]
    best = {}
    for h, p, v in rules:
        best[h, p] = max(v, best.get((h, p), ""))
    trie = urlfilter.Trie([(h, p, v) for (h, p), v in best.items()])
    for _ in range(3000):
        host = rng.choice(["", "w.", "w.v."]) + rng.choice(names)
        path = "/" + "".join(rng.choice(["x/", "y/", "z", "zz/"]) for _ in range(rng.randrange(6)))
        assert trie.longest(trie.path_tries(host), path) == plain(f"http://{host}{path}", rules, None)[2:]


def test_the_query_on_the_odd_table(spark, urls, tmp_path):
    spark.createDataFrame(urls, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["op12_url_filter"](spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter((r[0], *plain(r[1], urlfilter.ENTRIES)) for r in urls)
