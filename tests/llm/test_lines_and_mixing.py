"""Line dedup and source mixing: edge rows, brute force, incremental runs, quotas."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from wattlake.llm.lines import LineRuns, dedup_lines
from wattlake.llm.mixing import apply_mix, mix_sources, sainte_lague, source_targets, split_repeats, word_count

LICENCE = "  Licence \t"
ROWS = [(i, f"own {i}\n{LICENCE if i % 2 else 'LICENCE'}\n\nlast", "s") for i in range(12)] + [
    (20, None), (21, ""), (22, "\n\n"), (23, "licence\r"), (24, "ownÄ 1\nOWNÄ 1"), (25, "x\n" * 3000 + "licence"), (0, "own 0\nLICENCE\n\nlast"), (None, "licence\nz"), (26, " \n\x0b")]


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def test_dedup_lines(documents):
    where = collections.defaultdict(set)
    for i, t in [r[:2] for r in ROWS]:
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    want = []
    for i, t in [r[:2] for r in ROWS]:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 1 and len(where[key(x)]) >= 10)]
        want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = dedup_lines(documents(ROWS)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert dedup_lines(documents(ROWS)).columns[:12] == documents(ROWS).columns


def test_empty_tables(documents):
    assert dedup_lines(documents([])).collect() == []
    assert mix_sources(documents([])).collect() == []
    assert apply_mix(documents([])).collect() == []


def test_runs_are_levelled(spark):
    runs = LineRuns(spark, min_docs=3, fan_out=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(b"a", 1), (bytes([k]), 1)], "hash binary, n long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [bytes(r.hash) for r in runs.frequent().collect()] == [b"a"]
    # a hash known to be frequent isn't added again
    assert sum(r.n for run in runs.runs() for r in run.where(F.col("hash") == b"a").collect()) == 4


MIX = [(1, "a b c", "x"), (2, "", "x"), (3, None, None), (4, "d " * 40, None), (5, "e\tf", "y"), (6, "g " * 500, "y"), (7, "one", "z"), (5, "e\tf", "y"), (None, "h i", "x")]


def test_mix_keeps_to_the_rules(documents):
    rows = mix_sources(documents(MIX)).collect()
    assert len(rows) == len(MIX)
    total = sum(r["size"] for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] == len((dict((i, t) for i, t, _ in MIX)[r["doc_id"]] or "").split())
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(total)
    for v in by.values():
        assert v[0]["target"] <= 3 * v[0]["source_size"] + 1e-9
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 2 * 16
    again = mix_sources(documents(MIX).repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_targets_by_repeated_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, None: 50, "d": 0, "é": 400}
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, target, free = float(sum(sizes.values())), {}, set(names)
    while True:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target.update({s: 3.0 * sizes[s] for s in over})
        left, free = left - sum(3 * sizes[s] for s in over), free - over
    target.update({s: unit * weight[s] for s in free})
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(target)


def test_sainte_lague_by_hand(spark):
    weights, seats = [530.0, 240.0, 160.0, 70.0, 0.0, 70.0], 37
    want, left = [0] * len(weights), seats
    while left:
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * want[i] + 1), -i))
        want[best], left = want[best] + 1, left - 1
    df = spark.createDataFrame([("g", i, w, seats) for i, w in enumerate(weights)], "g string, i int, w double, s long")
    got = {r["i"]: r["quota"] for r in sainte_lague(df, ["g"], "w", "s", "i").collect()}
    assert [got[i] for i in range(len(weights))] == want


def test_apply_mix_writes_what_is_taken(documents):
    rows = [(i, f"w{i} " * (5 * i + 1), "x" if i % 2 else "y") for i in range(1, 9)]
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mix_sources(documents(rows)).collect()}
    out = apply_mix(documents(rows))
    assert out.columns == documents(rows).columns
    words = collections.Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert dict(words) == {i: t for i, (_, t) in taken.items() if t}


def test_kept_digest(documents):
    from wattlake.llm.shared import QUERIES
    import wattlake.llm.queries  # noqa: F401

    assert {"op6_mixing", "op7_line_dedup"} <= set(QUERIES)
    assert hashlib.sha256(b"").hexdigest() == documents([(1, "")]).select(F.sha2("text", 256)).first()[0]


def test_repeated_ids_fill_no_shard(spark):
    """One id, null too, with a third of all rows: blocks of equal rows, numbered whatever the files' order."""
    rows = spark.range(9000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("a b")).when(F.col("id") % 2 == 0, F.lit("c")).otherwise(F.lit("d e f")).alias("text"),
        F.when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.lit("s")).alias("source"),
    )
    sized = rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("at"))
    parts = split_repeats(sized, 100).groupBy("doc_id", "source", "size", "part").count().collect()
    by = collections.defaultdict(list)
    for r in parts:
        by[r["doc_id"], r["source"], r["size"]].append((r["part"], r["count"]))
    assert sorted(by[5, "s", 2]) == [(k, 100) for k in range(30)]
    assert all(sorted(by[None, None, n]) == [(k, 100) for k in range(15)] for n in (1, 3))
    assert sum(len(v) == 1 and v[0] == (0, 1) for v in by.values()) == 3000
    mixed = mix_sources(rows, shard_rows=1000)
    got = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {"s": 6000, None: 3000}
    assert all(abs(r["taken"] - r["target"]) <= 16 * 8 for r in got)
    assert mixed.groupBy("doc_id", "size", "taken").count().exceptAll(mix_sources(rows.repartition(3), shard_rows=1000).groupBy("doc_id", "size", "taken").count()).isEmpty()
