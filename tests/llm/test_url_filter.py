from __future__ import annotations

import random

import pytest

from orderloom.llm.queries import RULES
from orderloom.llm.url_filter import Rule, UrlTrie, with_verdict


def plain(rules, host, path):
    """Every rule in turn; the longest fitting one."""
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "allow"), default=None)


def test_trie_equals_every_rule_in_turn():
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "net", "org", "x-y"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: rng.choice(["", "/", "/e", "/en", "/en/", "/en/x", "/de/", "//", "/en/x/y"])
    rules = list({(h, p): Rule(rng.choice(["allow", "block"]), h, p or "/") for h, p in ((host(3), path()) for _ in range(60))}.values())
    rules = list({(r.host, r.path): r for r in rules}.values())
    trie = UrlTrie(rules)
    for _ in range(5000):
        h, p = host(5), path() + rng.choice(["", "z", "/q"])
        found, wanted = trie.match(h, p), plain(rules, h, p)
        assert (found and found.text) == (wanted and wanted.text), (h, p)


def test_allow_beats_block_of_the_same_length():
    trie = UrlTrie([Rule("block", "net"), Rule("allow", "net")])
    assert trie.match("a.net", "/").verdict == "allow"


def test_odd_urls(spark):
    urls = [
        (1, "HTTP://WWW.Example.NET/en/1?x", "www.example.net", "/en/1", "example.net/en/", "allow"),
        (2, "https://example.net", "example.net", "", None, "allow"),
        (3, "https://notnet/", "notnet", "/", None, "allow"),
        (4, "x://net/#top", "net", "/", "net/", "block"),
        (5, None, "", "", None, "allow"),
        (6, "", "", "", None, "allow"),
        (7, "example.net/en/", "", "", None, "allow"),
        (8, "a://b://example.com/de/x", "b:", "//example.com/de/x", None, "allow"),
        (9, "a://fr.org?/fr/", "fr.org", "", None, "allow"),
        (10, "https://x.example.com/de/" + "y" * 50_000, "x.example.com", "/de/" + "y" * 50_000, "example.com/de/", "block"),
        (10, "a://ÀB.org/fr/\n", "Àb.org", "/fr/\n", "org/fr/", "allow"),
    ]
    df = spark.createDataFrame([(i, u, "kept", "old") for i, u, *_ in urls], "page_id int, url string, more string, HOST string")
    got = with_verdict(df, RULES)
    assert sorted(got.columns) == sorted(["page_id", "url", "more", "host", "path", "rule", "verdict"])
    rows = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert rows == {(i, h, p, r, v) for i, _, h, p, r, v in urls}
    assert sorted(map(repr, with_verdict(df, RULES, rules_per_trie=1).collect())) == sorted(map(repr, got.collect()))
    assert with_verdict(df.limit(0), RULES).count() == 0
    assert {r["verdict"] for r in with_verdict(df, [], default="block").collect()} == {"block"}


def test_a_rule_needs_a_verdict():
    with pytest.raises(ValueError):
        UrlTrie([Rule("maybe", "net")])
