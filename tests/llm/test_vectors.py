"""Embedding near-dedup and top-k search against brute force, with unusable vectors, ties and repeats."""

import math

import numpy as np
import pytest

from wattlake.llm import embeddings
from wattlake.llm.embeddings import near_duplicate_vectors
from wattlake.llm.topk import search_blocks, top_k

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, id string, weight string, score string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash", "w", "s", "n") for i, v in rows], SCHEMA)


def rows_of(seed, n, dims, groups):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(groups)] + rng.standard_normal(dims) * rng.choice([0.05, 0.2, 0.3, 2])
        rows.append((3 * i + 1, [float(x) for x in np.float32(v)]))
    rows += [(2, rows[0][1]), (5, rows[0][1]), (5, rows[0][1]), (8, [float(np.float32(x * 4)) for x in rows[1][1]])]
    rows += [(11, None), (14, []), (17, [0.0] * dims), (20, [NAN] + [1.0] * (dims - 1)), (23, [INF] * dims), (26, [None] + [1.0] * (dims - 1)), (29, [1.0, 2.0]), (32, [1.0, 2.1]), (35, [1.0]), (38, [2.0]), (None, rows[0][1])]
    return rows


def good(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("dims,chunk,grid", [(64, 2048, 2), (24, 7, 2), (5, 16, 3)])
def test_links_as_by_brute_force(spark, dims, chunk, grid):
    rows = rows_of(dims, 160, dims, 9)
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            (a, u), (b, v) = rows[i], rows[j]
            if a is None or b is None or not good(u) or not good(v) or len(u) != len(v):
                continue
            u, v = np.float64(u), np.float64(v)
            if u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= 0.95:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[root(i)] = root(j)
    least = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            least[root(i)] = min(a, least.get(root(i), a))
    want = []
    for i, (a, _) in enumerate(rows):
        component = least.get(root(i)) if a is not None else None
        want.append((a, links[i], component, a is not None and a == component))
    got = near_duplicate_vectors(frame(spark, rows), chunk=chunk, grid_dims=grid).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(links) > 100


def test_top_k_as_by_brute_force(spark):
    rows = rows_of(3, 120, 16, 4)
    queries = [(i, v) for i, v in rows if i is not None and i % 2 == 0]
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ints = {id(v): [math.floor(256 * x) for x in v] for _, v in usable}
    want, asked = [], set()
    for q, v in sorted(((i, v) for i, v in queries if (i, v) in usable), key=lambda r: (r[0], r[1])):
        if q in asked:
            continue
        asked.add(q)
        scored = sorted((-sum(a * b for a, b in zip(ints[id(v)], ints[id(w)], strict=True)), i) for i, w in usable if i != q and len(w) == len(v))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    got = [tuple(r) for r in top_k(frame(spark, rows), frame(spark, queries), block_rows=16).collect()]
    assert sorted(got) == sorted(want)


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.integers(-5, 5, (50, 8)) + 40 * k for k in range(10)])
    blocks = [(np.arange(50 * k, 50 * k + 50), rows[50 * k : 50 * k + 50]) for k in range(10)]
    asked = rng.integers(1, 9, (20, 8))
    scores, ids, scored = search_blocks(asked, np.full(20, -5), blocks, 5)
    every = asked @ rows.T
    for q in range(20):
        best = sorted(range(500), key=lambda i: (-every[q, i], i))[:5]
        assert ids[q].tolist() == best and scores[q].tolist() == [every[q, i] for i in best]
    assert scored < every.size / 2


def test_empty_tables(spark):
    none = frame(spark, [])
    assert near_duplicate_vectors(none).collect() == []
    assert top_k(none, none).collect() == []
    assert near_duplicate_vectors(frame(spark, [(1, None), (2, [0.0])])).where("n_links > 0 OR NOT kept").count() == 0


def test_top_k_of_large_components(spark):
    """Exact whatever the size; beyond 64 bits an error."""
    def best(rows, query):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return [tuple(r) for r in top_k(df, df.where(f"vec_id = {query}")).orderBy("rank").select("vec_id", "score").collect()]

    assert best([(0, [1.0]), (1, [600000.0]), (2, [900000.0])], 0) == [(2, 256 * 256 * 900000), (1, 256 * 256 * 600000)]
    big = 2.0**35
    rows = [(0, [big, -big, 1.0]), (1, [big, big, 3.0]), (2, [big, big - 1, 3.0]), (3, [-big, -big, 2.0])]
    exact = lambda a, b: sum(int(256 * x) * int(256 * y) for x, y in zip(a, b))
    want = sorted(((exact(rows[0][1], v), i) for i, v in rows[1:]), key=lambda x: (-x[0], x[1]))
    assert best(rows, 0) == [(i, s) for s, i in want]
    with pytest.raises(Exception, match="beyond 64 bits"):
        best([(0, [1e18]), (1, [1e18])], 0)


def test_rows_sent_grow_as_the_vectors_do(spark, monkeypatch):
    """A chunk is a share of all vectors: four times as many send about four times the rows to tasks, not sixteen times."""
    monkeypatch.setattr(embeddings, "LEAST_CHUNK", 8)
    joined, sent = embeddings._joined, []

    def counted(tasks, *rest):
        sent.append(tasks.count())
        return joined(tasks, *rest)

    monkeypatch.setattr(embeddings, "_joined", counted)
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.standard_normal((1600, 16)))]
    for n in (400, 1600):
        got = near_duplicate_vectors(frame(spark, rows[:n])).select("vec_id", "n_links").collect()
        unit = np.array([v for _, v in rows[:n]])
        unit /= np.sqrt((unit * unit).sum(1))[:, None]
        assert dict(map(tuple, got)) == dict(enumerate(((unit @ unit.T >= 0.95).sum(1) - 1).tolist()))
    assert sent[1] < 5 * sent[0]


def test_near_copies_in_chunks_are_counted_and_united(spark):
    """A third of all vectors within one range of each other, in many chunks of the same cell."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((300, 32))
    x[::3] = x[0] + 0.1 * rng.standard_normal((100, 32))
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]
    unit = np.array([v for _, v in rows])
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    got = near_duplicate_vectors(frame(spark, rows), chunk=9).orderBy("vec_id").collect()
    assert [r["n_links"] for r in got] == want.tolist() and want.sum() > 5000
    assert [r["component_id"] for r in got] == [0 if i % 3 == 0 else i for i in range(300)]
