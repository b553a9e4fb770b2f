"""Boundaries in time from the index: the same rows, few reads."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from readings import SF, START, reading
from catalog.base import seconds, silver
from wattlake.operators import filters, timeindex, trends
from wattlake.operators.ranks import with_position


def plain_rank(rows):
    import hashlib

    return sorted(rows, key=lambda r: (r[0], int(hashlib.md5((r[1] or "").encode()).hexdigest()[:8], 16) >> 12, r[1] or ""))


def test_boundary_at_every_rank(spark, frame, monkeypatch):
    stamps = [START + timedelta(microseconds=m) for m in (0, 1, 1, 1, 900_000, 1_000_000, 3_700_000_000)]
    rows = [reading(i, timestamp=stamps[i % 7], event_id=None if i == 3 else f"E{i}") for i in range(60)] + [reading(99, timestamp=None)]
    df = frame(rows)
    order = plain_rank([(r["timestamp"], r["event_id"]) for r in df.where("timestamp IS NOT NULL").collect()])
    for most in (20_000, 5):
        monkeypatch.setattr(timeindex, "MOST", most)
        for k in (0, 7, 21, 30, 59):
            found = timeindex.boundary(df, lambda n, k=k: F.lit(k))
            newer = df.where(timeindex.at_or_after(found)).count()
            assert (found.stamp, found.event) == (order[k][0], order[k][1] or "") and newer == 60 - k
    assert timeindex.boundary(df, lambda n: n) is None
    assert timeindex.boundary(frame([]), lambda n: F.lit(0)) is None


def test_stored_index_gives_the_same(spark):
    df, index = silver(spark, SF), seconds(spark, SF)
    assert index.agg(F.sum("n")).first()[0] == df.where("timestamp IS NOT NULL").count()
    for n in (1, 100, 2000):
        a, b = trends.newest(df, n, index), trends.newest(df, n)
        assert a.count() == n and a.exceptAll(b).count() == 0
    assert trends.trends(df, index=index).collect() == trends.trends(df).collect()


def test_newest_reads_no_old_days_and_trends_read_once(spark):
    df, index = silver(spark, SF), seconds(spark, SF)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    newest = plan(trends.newest(df, 50, index))
    assert newest.count("FileScan parquet") == 1 and "Exchange" not in newest
    days = [r["event_date"] for r in trends.newest(df, 50, index).select("event_date").distinct().collect()]
    assert f"event_date#" in newest and ">= " in newest.split("PartitionFilters: ")[1][:200] and len(days) < 90
    assert plan(trends.trends(df, index=index)).count("FileScan parquet") == 1


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("k"))
    got = {r["v"]: r["position"] for r in with_position(df, [F.col("k").desc(), F.col("v").asc()], parts=7).collect()}
    want = sorted(((r["k"], r["v"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert got == {v: i + 1 for i, (_, v) in enumerate(want)}
    placed = with_position(df, [F.col("v")])
    windows = [line for line in placed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in line]
    assert windows and all("_range" in w for w in windows)
    assert with_position(df.limit(0), [F.col("v")]).count() == 0


def test_sorted_table(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "transformer_id string, avg_temp double")
    assert [r[0] for r in filters.sort_table(df, "Temperature").collect()] == ["c", "a", "b"]
    at = {r[0]: r["position"] for r in filters.positioned(df, "Temperature", ascending=True).collect()}
    assert at == {"a": 1, "b": 2, "c": 3}
