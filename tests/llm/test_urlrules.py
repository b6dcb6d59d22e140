"""URL verdicts against a plain reading of the rules."""

import random

import pytest

from scarmap.llm import urlrules as U


def plain(url, rules, otherwise="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = rest[:end], rest[end:]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: r.rank, default=None)
    return host, path, best and best.host + best.path, best.verdict if best else otherwise


URLS = [
    None, "", "no scheme/en/", "http://", "http://NET/", "http://net", "http://a.net?x=/", "https://Example.NET/en/x", "http://sub.example.net/en", "http://badexample.net/en/1",
    "ftp://example.com/de/", "http://example.com/De/", "http://example.com/de?x", "http://x.org/fr/a#b", "http://org/fr/", "http://..net//", "a://b://c.net/", "http://é.org/fr/é", "http://u@x.net:80/", "line\nhttp://x.net/\ny",
]


@pytest.mark.parametrize("limit", [U.TRIE_RULES, 3])
def test_verdicts(spark, monkeypatch, limit):
    monkeypatch.setattr(U, "TRIE_RULES", limit)
    rng = random.Random(3)
    hosts = ["net", "a.net", "b.a.net", "com", "x.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab"]
    more = [U.Rule(rng.choice(["allow", "block"]), h, p) for h in hosts for p in paths if rng.random() < 0.6]
    urls = URLS + [f"http://{h}{p}{q}" for h in [*hosts, "y.x.com", "zx.com"] for p in [*paths, "/a/b/c", "/b"] for q in ["", "?a/b"]]
    rows = spark.createDataFrame([(i // 2, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, html string")
    for rules in (U.RULES, more, []):
        got = U.judge(rows, rules)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((i // 2, *plain(u, rules))) for i, u in enumerate(urls))
    assert U.judge(rows.limit(0)).count() == 0


def test_equal_rules_and_bad_rules(spark):
    rows = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    both = [U.Rule("allow", "net", "/"), U.Rule("block", "net", "/")]
    assert U.judge(rows, both).first().verdict == U.judge(rows, both[::-1]).first().verdict == "block"
    with pytest.raises(ValueError):
        U.judge(rows, [U.Rule("block", "", "/")])
