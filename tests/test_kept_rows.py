"""Rows that must not vanish: damaged files, null times and ids, unreadable tables, other zones and folders."""

import gzip
import os
import subprocess
import sys
from datetime import datetime

import pytest
from readings import reading
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_streaming import write_events

from wattlake.operators import sampling, trends
from wattlake.sources import layers
from wattlake.sources.raw import to_timestamp_lenient
from wattlake.streaming import ingest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_damaged_file_is_seen(spark, frame, tmp_path):
    events = tmp_path / "in"
    write_events(frame, events, [reading(i) for i in range(3000)], "a.jsonl")
    packed = gzip.compress((events / "a.jsonl").read_bytes())
    (events / "b.jsonl.gz").write_bytes(packed[: len(packed) // 2])
    with pytest.raises(Exception, match="b.jsonl.gz|EOF|Unexpected end"):
        ingest.drain(spark, str(events), f"{tmp_path}/sink", f"{tmp_path}/check")
    lines = {os.path.basename(r["file"]): r["lines"] for r in ingest.lines_by_file(spark, str(events)).collect()}
    assert lines["a.jsonl"] == 3000 and lines["b.jsonl.gz"] < 3000
    ingest.ingest(spark, str(events), f"{tmp_path}/s", f"{tmp_path}/c", None, skip_damaged=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/s").count() >= 3000


def test_newest_keeps_undated_and_nameless_rows(frame):
    rows = [reading(i) for i in range(20)] + [reading(20 + i, timestamp=None) for i in range(5)]
    rows += [reading(30, event_id=None), reading(31, event_id=None, timestamp=None)]
    df = frame(rows)
    assert trends.newest(df, 100).count() == 27
    assert trends.newest(df, 23).filter("timestamp IS NULL").count() == 2
    assert trends.newest(df, 21).filter("timestamp IS NULL").count() == 0
    assert trends.newest(df, 1).first()["event_id"] is None
    assert trends.mark_recent(df).count() == 27
    assert sampling.uniform_sample(df, 27).count() == 27
    assert frame([]).transform(lambda d: trends.newest(d, 5)).count() == 0


def test_rank_boundary_counts_few_groups_with_microseconds(spark):
    df = spark.range(50_000).select(
        F.concat(F.lit("E"), "id").alias("event_id"),
        (F.lit(datetime(2025, 4, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") % 7000).cast("decimal(18,6)") + F.col("id") / 1e6)).alias("timestamp"),
    )
    marked = trends.mark_recent(df)
    assert marked.filter("is_recent").count() == 10_000
    low, high = (marked.filter(c).agg(f).first()[0] for c, f in (("NOT is_recent", F.max("timestamp")), ("is_recent", F.min("timestamp"))))
    assert low <= high


def test_only_a_missing_table_is_passed_over(spark, frame, tmp_path):
    frame([reading(0)]).write.option("header", True).csv(f"{tmp_path}/t_csv")
    loaded = layers.load_silver(spark, [f"{tmp_path}/none", f"{tmp_path}/t_csv"])
    types = dict(loaded.dtypes)
    assert (types["voltage_kv"], types["timestamp"], loaded.count()) == ("double", "timestamp_ntz", 1)
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        layers.load_silver(spark, [f"{tmp_path}/empty", f"{tmp_path}/t_csv"])


def test_times_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = [("2025-03-09 02:30:00",), ("2025-03-09T02:30:00.5",), ("2025-03-09T02:30:00+05:00",), ("soon",), (None,)]
        got = [r[0] for r in spark.createDataFrame(texts, "t string").select(to_timestamp_lenient(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    at = datetime(2025, 3, 9, 2, 30)
    assert got == [at, at.replace(microsecond=500_000), at, None, None]


def test_the_forest_runs_where_workers_lack_the_package(tmp_path):
    """The driver alone knows the repository; workers start in an empty folder without a path to it."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry
from wattlake.session import build_session
spark = build_session("local[2]", "elsewhere")
queries = entry.queries()
for name in ("ml3_forest_facts", "ml4_score_facts", "ml8_loaded_equals_fitted"):
    print(name, queries[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ml8_loaded_equals_fitted 1" in done.stdout, done.stderr[-2000:]
