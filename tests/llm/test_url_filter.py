"""URL filter: every verdict as string comparison gives it, wildcards, many rules."""

import fnmatch
import random

import numpy as np
import pyarrow as pa

from wattlake.llm.text import buffers
from wattlake.llm.url_filter import RULES, GlobAutomaton, UrlRule, filter_urls

URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://Example.ORG/es/a?b#c", "https://example.org/es", "https://example.org/en/12",
    "http://badexample.org/es/", "http://a.example.org/es/?x", "ftp://a.com/fr/x", "ftp://a.com/FR/x", "x://b.com/de/#", "x://com/de/",
    "http://a.net/x.org/", "a://b://c.org/", "http://a.org\n/x", "http://a.org?/y", "http://é.org/ü", "http://a.org" + "/é" * 3000,
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def judge(url):
    host, path = plain(url)
    fits = [r for r in RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.action if best else "allow"


def test_verdicts(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(3, URLS[5], "again", "again"), (None, URLS[5], "null", "id")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host string")
    got = sorted((tuple(r) for r in filter_urls(pages).collect()), key=repr)
    assert got == sorted(((i, *judge(u)) for i, u, *_ in rows), key=repr)


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(pages).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in filter_urls(one, []).collect()] == [(1, "a.org", "/", None, "allow")]


def test_wildcards_against_fnmatch():
    random.seed(1)
    rules = [UrlRule("block", "".join(random.choice("ab*.") for _ in range(random.randint(1, 5))), "/" + "".join(random.choice("ab*/") for _ in range(random.randint(0, 6)))) for _ in range(60)]
    texts = [("." + "".join(random.choice("ab.") for _ in range(random.randint(0, 5))), "/" + "".join(random.choice("ab/") for _ in range(random.randint(0, 7)))) for _ in range(300)]
    got = GlobAutomaton(rules).match(*buffers(pa.array([h + p for h, p in texts])))
    # a host star takes no "/", so host and path are matched apart
    want = np.array([[fnmatch.fnmatchcase(h, "*." + r.host) and fnmatch.fnmatchcase(p, r.path + "*") for r in rules] for h, p in texts])
    assert (got == want).all()
