"""MinHash near-dedup, components and repeated passages against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from wattlake.llm.graph import components
from wattlake.llm.minhash import fast_sketch, near_duplicates, sets_of
from wattlake.llm.passages import compact_windows, passage_pairs, repeated_passages, signatures, spans
from wattlake.llm.text import Hasher, buffers, words


def split(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\f\r" else c for c in text or "").split(" ") if w]


def shingle_set(text, n):
    w = split(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def some_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 90]))]
        for _ in range(rng.choice([1, 3, 9])):
            text = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.02, 0.06]) else w for w in base]
            rows.append((len(rows) * 2, " ".join(text)))
    rows += [(1, None), (3, ""), (5, " \n\t"), (7, "One"), (9, "one"), (11, "one two"), (13, "ONE\x0bTWO "), (15, "two one"), (17, "é É"), (19, "é É"), (21, "é é"), (0, rows[0][1]), (None, rows[0][1]), (None, None)]
    return rows


@pytest.mark.parametrize("n", [2, 5])
def test_components_as_by_brute_force(documents, n):
    rows = some_texts(n)
    sets = [shingle_set(t, n) for _, t in rows]
    nodes = {i: i for i, _ in rows if i is not None}

    def root(i):
        while nodes[i] != i:
            i = nodes[i]
        return i

    for (a, b) in itertools.combinations(range(len(rows)), 2):
        i, j = rows[a][0], rows[b][0]
        if i is not None and j is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            i, j = sorted((root(i), root(j)))
            nodes[j] = i
    want = [(i, len(s), None if i is None else root(i), i is not None and root(i) == i) for (i, _), s in zip(rows, sets, strict=True)]
    got = near_duplicates(documents(rows), words=n).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []
    assert repeated_passages(documents([])).collect() == []


def test_sketches_estimate_and_fill():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 1 << 62, k).astype(np.uint64) for k in (600, 100, 100))
    found = [np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b])), a[:1], a[:0]]
    where = np.cumsum([0] + [len(f) for f in found])
    sketch = fast_sketch(np.concatenate(found), where, 512)
    assert (sketch[:3] != np.iinfo(np.uint64).max).all() and (sketch[3] == np.iinfo(np.uint64).max).all()
    assert abs((sketch[0] == sketch[1]).mean() - 600 / 800) < 0.08
    assert (fast_sketch(found[0], np.array([0, len(found[0])]), 512)[0] == sketch[0]).all()


def test_words_and_hashes():
    texts = ["", None, " A b\x0bC\r", "é x y", "z" * 5000, "\n"]
    data, offsets = buffers(pa.array(texts))
    starts, ends, first = words(data, offsets)
    raw = data.tobytes()
    got = [[raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [[], [], ["A", "b", "C"], ["é x", "y"], ["z" * 5000], []]
    hasher, small = Hasher(), Hasher()
    small.SPAN = 4
    assert (hasher(data, starts, ends) == small(data, starts, ends)).all()
    assert len(set(hasher(data, starts, ends).tolist())) == len(starts)
    assert len(sets_of(pa.array(["a b a b", "x"]), hasher, 2)[0]) == 3


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    ids = list(range(300))
    rng.shuffle(ids)
    links = [(ids[k], ids[k + 1]) for k in range(149)] + [(ids[150], ids[k]) for k in range(151, 299)] + [(5, 5), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: min(ids[:150]) for i in ids[:150]} | {i: min(ids[150:299]) for i in ids[150:299]}
    assert got == want


def test_compact_windows_are_all_wide_spans():
    rng = np.random.default_rng(4)
    found = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    where, t = np.array([0, 3, 3, 200, 300]), 9
    at, keys = compact_windows(found, where, t, 2)
    value = signatures(found, 2) >> np.uint64(24)
    want = []
    for a, b in zip(where[:-1], where[1:], strict=True):
        for c in range(a, b):
            left = next((i + 1 for i in range(c - 1, a - 1, -1) if value[i] < value[c]), a)
            right = next((i - 1 for i in range(c + 1, b) if value[i] < value[c]), b - 1)
            if right - left + 1 >= t:
                want.append((c, left, right))
    first, last = spans(at, keys, where)
    assert sorted(zip(at.tolist(), first.tolist(), last.tolist(), strict=True)) == sorted(tuple(map(int, x)) for x in want)


def test_planted_passages(documents):
    rng = random.Random(8)
    fresh = iter(f"w{i}" for i in range(100_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    shared, longer, short, frame_words = take(51), take(200), take(40), take(18)
    edited = [w if i != 100 else "other" for i, w in enumerate(longer)]
    rows, planted = [], set()
    for i in range(24):
        body = take(rng.choice([60, 300]))
        kind = i % 6
        piece = {0: shared, 1: longer, 2: edited, 3: short, 4: frame_words, 5: []}[kind]
        at = rng.randrange(len(body))
        rows.append((i, " ".join(body[:at] + piece + body[at:]).upper() if i % 4 == 0 else " ".join(body[:at] + piece + body[at:])))
        if kind < 3:
            planted.add(i)
    rows += [(50, None), (51, ""), (52, " ".join(take(49))), (53, rows[-1][1]), (54, rows[5][1] + " "), (None, rows[0][1]), (55, " ".join(take(30) * 4))]
    copies = {5, 23, 53, 54}
    got = repeated_passages(documents(rows)).collect()
    assert {r.doc_id for r in got} == planted | copies
    assert len(got) == len(planted | copies) and all(r.n_words >= 50 for r in got)
    assert {r.doc_id: r.class_id for r in got if r.doc_id in copies} == {5: 5, 54: 5, 23: 23, 53: 23}
    assert all(r.other_doc_id != r.doc_id and r.other_doc_id in planted | copies for r in got)
    texts = dict(r for r in rows if r[0] is not None)
    pairs = passage_pairs(documents(rows))[1].collect()
    assert {r.u for r in pairs} | {r.v for r in pairs} == planted
    for r in pairs:
        a, b = split(texts[r.u]), split(texts[r.v])
        x = shingle_set(" ".join(a[r.start_u : r.start_u + r.words_u]), 5)
        y = shingle_set(" ".join(b[r.start_v : r.start_v + r.words_v]), 5)
        assert r.u != r.v and min(r.words_u, r.words_v) >= 50
        assert r.similarity == pytest.approx(len(x & y) / len(x | y)) and r.similarity >= 0.8
    assert max(r.words_u for r in pairs if r.u % 6 in (1, 2)) >= 200
