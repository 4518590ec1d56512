import itertools
import re

import pytest

from barloom.llm import queries, urls

URLS = [
    "http://a.example.com/en/7?x", "https://EXAMPLE.com/en/70", "http://com/en/", "http://com/en", "http://x.com/EN/", "http://xcom/en/",
    "http://b.example.net/de/8", "http://example.net/de/9#t", "http://net/de/", "http://org/es/x", "http://org/es", "ftp://q.org/es//",
    None, "", "no scheme", "://", "http://", "http:///en/", "a://b.com?/en/", "a://b.com#://c.net/de/", "x://y.com/en/://z.net/de/",
    "http://É.example.com/en/7é", "http://com./en/", "http://.com/en/", "http://a..com/en/", "http://u@h.com:80/en/", "http://a.com\n/en/\n7",
]


def plain(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


def many_rules():
    hosts = ["com", "example.com", "a.example.com", "net", "", "b.com"]
    paths = ["", "/", "/en", "/en/", "/en/7", "/en//", "/de/8"]
    return [(h, p, "block" if i % 3 else "allow") for i, (h, p) in enumerate(itertools.product(hosts, paths))] + [("com", "/en/", "allow")]


@pytest.mark.parametrize("rules", [queries.URL_RULES, many_rules(), []])
@pytest.mark.parametrize("most", [urls.MAX_RULES, -1])
def test_trie_and_join_equal_plain_matching(spark, monkeypatch, rules, most):
    monkeypatch.setattr(urls, "MAX_RULES", most)
    every = [*URLS, *URLS[:3]]
    pages = spark.createDataFrame([(i, u, "r", "v", 1) for i, u in enumerate(every)], "page_id bigint, url string, rule string, host string, at int")
    got = urls.judge(pages, spark.createDataFrame(rules, urls.RULES)).collect()
    assert len(got) == len(every)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(every[r.page_id], rules), every[r.page_id]
        assert r["at"] == 1


def test_default_and_empty(spark):
    rules = spark.createDataFrame(queries.URL_RULES, urls.RULES)
    pages = spark.createDataFrame([(1, "http://q.de/")], "page_id bigint, url string")
    assert urls.judge(pages, rules, default="block").first().verdict == "block"
    assert urls.judge(pages.limit(0), rules).collect() == []
