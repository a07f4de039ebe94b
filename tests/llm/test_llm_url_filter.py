"""Trie rules against a plain longest match."""

from hypothesis import given, settings
from hypothesis import strategies as st

from barflow.llm.url_filter import RULES_HERE, build_trie, judge_urls, match

HOSTS = st.sampled_from(["org", "a.org", "b.a.org", "com", "x.com", "notorg", ""])
PATHS = st.sampled_from(["", "/", "/a", "/a/", "/a/b", "/ab/", "/a/b/c", "//"])


def plain(rules, host, path):
    best = None
    for rule_host, rule_path, verdict in rules:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rank = (rule_host.count(".") + 1, len(rule_path), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, verdict, rule_host + rule_path)
    return best and best[1:]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOSTS, PATHS, st.sampled_from(["allow", "block"])), max_size=8), HOSTS, PATHS)
def test_longest_match(rules, host, path):
    found = match(build_trie(rules), host, path)
    assert (found and found[2:]) == plain(rules, host, path)


URLS = [
    (0, None),
    (1, "no scheme"),
    (2, "http://EXAMPLE.org/es/x?q#f"),
    (3, "https://m.example.org/en/12"),
    (4, "http://example.org"),
    (5, "ftp://x.com/de/?/fr/"),
    (6, "http://x.com/fr/a://b"),
    (7, "http://example.net/"),
    (7, "http://example.net/"),
    (None, ""),
    (8, "http:///path"),
    (9, "http://a.org?x/y"),
    (10, "http://a.org/" + "x" * 50_000),
    (11, "line\nhttp://b.org/\nz"),
]


def test_judged_urls(spark):
    pages = spark.createDataFrame([(*u, "own") for u in URLS], "page_id long, url string, verdict string")
    for size in (200_000, 2):
        out = judge_urls(pages, RULES_HERE, max_rules=size)
        assert {r[0] for r in out.select("row.verdict").collect()} == {"own"}
        for r in out.collect():
            rest = (r.row.url or "").partition("://")[2]
            end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host, tail = rest[:end].lower(), rest[end:]
            path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
            assert (r.host, r.path) == (host, path)
            expected = plain(RULES_HERE, host, path)
            assert (r.verdict, r.rule) == (expected or ("allow", None))
    assert judge_urls(pages.limit(0), RULES_HERE).collect() == []
