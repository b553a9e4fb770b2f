"""Prefix trie of rebuilt conversations, against a trie in dictionaries."""

import collections
import hashlib
import random
import zlib

import pytest

from wattlake.llm import trie
from wattlake.llm.trie import NODES, digest_ends, op13_trie, prefix_trie, rebuilt, running

SCHEMA = "conv_id long, turn long, role string, text string, depth string, size string, key long, place int, path string"


def plain(rows):
    """The contract's rows, from whole conversations in memory."""
    digest = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    own = collections.defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, digest(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, of in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(of) - 1) * len(p[-1][1].encode()) if p else 0
    return {
        (of[0], len(p), members[p[:-1]][0] if p else None, len(of), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in of if paths[c] == p).encode()).hexdigest())
        for p, of in members.items()
    }


def found(rows, depth=trie.DEPTH):
    nodes, pieces = prefix_trie(*rebuilt(rows), depth)
    parted = {(r.conv_id, r.depth): r.ends_sha256 for r in digest_ends(pieces).collect()}
    out = []
    for r in nodes.collect():
        key = (r.conv_id, r.depth)
        sha = parted.get(key) or hashlib.sha256((r.ends or "").encode()).hexdigest()
        out.append((*[r[c] for c in NODES], sha))
    assert len(out) == len(set(out))
    return set(out)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], SCHEMA)


def talks(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("depth", [trie.DEPTH, 2, 5])
def test_against_dictionaries(spark, depth):
    rows = talks(1, 120, 12, ["a", "b", "é日", ""])
    rows += [(1000, None, None, None), (1000, 0, "user", "a"), (1000, 0, "user", "a"), (1003, 1, "user", "only one"), (None, 0, "user", "no conversation")]
    rows += [(5000 + i, t, "user", "same") for i in range(60) for t in range(9)]  # one very common conversation
    rows += [(6000, t, "user", str(t % 3)) for t in range(400)]  # one very long conversation
    assert found(make(spark, rows), depth) == plain(rows)


def test_negative_ids_and_absent_bases(spark):
    rows = [(7, t, "user", "x" * t) for t in range(3)] + [(12, 0, "a", "b"), (-5, 0, "a", "b"), (-10, 3, "a", "b")]
    want = plain([r for r in rows if r[0] >= 0] + [(c, t, r, x) for c, t, r, x in rows if c < 0])
    assert found(make(spark, rows)) == want


def test_empty_table(spark):
    assert found(make(spark, [])) == set()
    assert found(make(spark, [(None, 1, "user", "x")])) == set()


def test_running_over_parts(spark):
    rows = [(k, i, (i * 7) % 11) for k, n in ((1, 3), (2, 200), (3, 1), (4, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(5)
    from pyspark.sql import functions as F

    got = running(df, "k", [F.col("i")], 7, place=("sum", F.lit(1)), total=("sum", F.col("v")), x=("bit_xor", F.col("v")))
    sums, xors = collections.Counter(), collections.Counter()
    want = set()
    for k, i, v in rows:
        sums[k] += v
        xors[k] ^= v
        want.add((k, i, v, i + 1, sums[k], xors[k]))
    assert {tuple(r) for r in got.select("k", "i", "v", "place", "total", "x").collect()} == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    assert {tuple(r) for r in op13_trie(spark, "/root/testdata/sf0.001").collect()} == plain(rows)
