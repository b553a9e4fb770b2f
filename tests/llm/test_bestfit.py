"""Best-fit packing: ids, exact cover, certificates, few sequences."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattlake.llm.bestfit import best_fit, least_bins, op12_bestfit, pack_best_fit, pack_lengths
from wattlake.llm.packing import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")


def fewest(lengths, capacity):
    """The least number of bins, by trying all groupings."""
    best = len(lengths)

    def put(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for r in sorted(set(room)):
            if r >= lengths[i]:
                at = room.index(r)
                put(i + 1, [*room[:at], r - lengths[i], *room[at + 1 :]])
        put(i + 1, [*room, capacity - lengths[i]])

    put(0, [])
    return best


def test_bound_and_packing_against_all_groupings():
    rng = random.Random(5)
    certified = 0
    for trial in range(300):
        capacity = rng.choice([10, 16, 30])
        low, high = rng.choice([(1, capacity), (capacity // 3, capacity // 2 + 2), (capacity // 4, capacity)])
        lengths = sorted((rng.randint(low, high) for _ in range(rng.randint(1, 9))), reverse=True)
        least, want = least_bins(np.bincount(lengths, minlength=capacity + 1)), fewest(lengths, capacity)
        bins, offsets, free = best_fit(lengths, capacity)
        assert least <= want <= len(free) <= want * 11 / 9 + 1, lengths
        certified += least == len(free)
        for b in range(len(free)):
            inside = sorted((o, n) for x, o, n in zip(bins, offsets, lengths) if x == b)
            assert [o for o, _ in inside] == [0, *itertools.accumulate(n for _, n in inside)][:-1]
            assert sum(n for _, n in inside) == capacity - free[b]
    assert certified > 250


@pytest.mark.parametrize("kind", ["even", "large", "few", "thirds", "one"])
def test_partitions_exchange(spark, kind):
    rng = random.Random(7)
    lengths = {
        "even": [rng.randint(1, 60) for _ in range(4000)], "large": [rng.choice([34, 35, 51, 60]) for _ in range(3000)],
        "few": [5, 99], "thirds": [33] * 3000, "one": [1],
    }[kind]
    rows = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    places, certificates = pack_lengths(rows, 100, per_partition=500, shared_by=3)
    placed = {r.key: (r.bin, r.offset) for r in places.collect()}
    assert places.count() == len(lengths) == len(placed)
    bins = collections.defaultdict(list)
    for key, (b, o) in placed.items():
        bins[b].append((o, lengths[key]))
    for inside in bins.values():
        inside.sort()
        assert [o for o, _ in inside] == [0, *itertools.accumulate(n for _, n in inside)][:-1]
        assert sum(n for _, n in inside) <= 100
    listed = certificates.collect()
    whole = [r for r in listed if r["round"] is None][0]
    assert whole.bins == len(bins) and whole.bound == least_bins(np.bincount(lengths, minlength=101))
    assert all(r.bins >= r.bound for r in listed)
    if kind in ("even", "few", "thirds", "one"):
        assert whole.bins == whole.bound
    if kind == "even":
        first = [r for r in listed if r["round"] == 0]
        assert sum(r.bins for r in first) > whole.bins and max(r["round"] or 0 for r in listed) >= 1


def check(rows, pieces, capacity, end):
    tokenizer = Tokenizer.from_file(WORDS)
    want = collections.Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        for k in range(0, len(ids), capacity):
            want[doc, k // capacity, k, tuple(ids[k : k + capacity])] += 1
    got = collections.Counter((p.doc_id, p.piece, p.start, tuple(np.frombuffer(p.ids, "<u4").tolist())) for p in pieces)
    assert got == want
    fill = collections.defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids)
        fill[p.sequence_id].append((p.offset, p.length))
    for inside in fill.values():
        inside.sort()
        assert [o for o, _ in inside] == [0, *itertools.accumulate(n for _, n in inside)][:-1]
        assert sum(n for _, n in inside) <= capacity
    return len(fill), -(-sum(p.length for p in pieces) // capacity)


def test_documents(spark, documents):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (2, ""), (None, "Null id"), (3, "<|endoftext|> É  x"), (4, "one two three " * 50), (4, "one two three " * 50)]
    rows += [(10 + i, " ".join(rng.choice(["grid", "load", "Wärme", "7"]) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    pieces, certificates = pack_best_fit(documents(rows).repartition(3), WORDS, 32, per_partition=40, shared_by=2)
    used, least = check(rows, pieces.collect(), 32, 0)
    assert used <= least + 2
    empty, none = pack_best_fit(documents([]), WORDS)
    assert empty.count() == 0 and none.count() == 1
    with pytest.raises(ValueError):
        pack_best_fit(documents(rows), WORDS, 1)


def test_query(spark):
    rows = op12_bestfit(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    want = set()
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.add((doc, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    used = collections.Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 1
