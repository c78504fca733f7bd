import random

import pytest

from cardforge.llm import url_filter


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, v))
    return (host, path, best[2] if best else None, best[3] if best else default)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    labels = ["net", "a", "b", "example", "net-x", "x", "c-d", ""]
    paths = ["/", "/en/", "/en", "/en/x", "/de/", "", "/e"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = {(host(), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(25)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [rng.choice(["http://", "HTTPS://", ""]) + host().upper() + rng.choice(["", "/", "/en/x?q=/de/", "#f", "?a://b", "/de/é"])
            for _ in range(400)] + [None, "", "://", "http://a.net:80/", "u@x://net/"] + ["http://a.net/en/"] * 150
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(pages.repartition(4), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted(map(tuple, got.collect())) == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_edges(spark):
    rules = spark.createDataFrame([("net", None, "allow"), ("net", "/", "block"), (None, "/", "block"), ("NET", "/x", "allow")],
                                  "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/", "k", "p"), (1, "http://a.net/", "k", "p"), (None, None, None, None),
                                   (2, "http://net/x" + "y" * 50_000, "", "")], "page_id long, url string, key string, part string")
    got = sorted(map(tuple, url_filter.judge_urls(pages, rules).collect()), key=repr)
    assert [(r[0], r[3], r[4]) for r in got] == [(1, "net/", "block"), (1, "net/", "block"), (2, "net/x", "allow"), (None, None, "allow")]
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
