"""What crosses a shuffle or is written on the way to silver, the stream's sinks and the detections."""

import glob

import duckdb
from readings import SF

from catalog import ml as forests
from catalog import streaming
from catalog.base import silver, stage, work
from wattlake.operators import cleaning
from wattlake.plans import ml
from wattlake.schema import TELEMETRY_COLUMNS
from wattlake.sources import derived


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.split("\n") if "Exchange" in line and "Broadcast" not in line]


def copies(tmp_path):
    """Order lines of which one stands 300 times with other parts, and some several times."""
    for name in ("supplier", "nation", "region"):
        duckdb.sql(f"COPY (SELECT * FROM '{SF}/{name}.parquet') TO '{tmp_path}/{name}.parquet'")
    duckdb.sql(f"""COPY (WITH l AS (SELECT * FROM '{SF}/lineitem.parquet' ORDER BY l_orderkey, l_linenumber LIMIT 900),
        again AS (SELECT l.* REPLACE (l_partkey + i AS l_partkey) FROM l, range(5) r(i)),
        hot AS (SELECT f.* REPLACE (l_partkey + i AS l_partkey, l_extendedprice + i % 3 AS l_extendedprice)
          FROM (SELECT * FROM l LIMIT 1) f, range(300) r(i))
        SELECT * FROM again UNION ALL SELECT * FROM hot) TO '{tmp_path}/lineitem.parquet'""")
    return str(tmp_path)


def test_distinct_readings_are_those_that_dedup_keeps(spark, tmp_path):
    folder = copies(tmp_path)
    want = cleaning.dedup(derived.telemetry(spark, folder)).select(TELEMETRY_COLUMNS)
    found = derived.distinct_telemetry(spark, folder).select(TELEMETRY_COLUMNS)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    assert found.count() < derived.telemetry(spark, folder).count() / 4


def test_readings_are_derived_behind_the_shuffles(spark):
    plan = derived.distinct_telemetry(spark, SF)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "anomaly_type" in plan and "anomaly_type" not in below and "voltage_kv" not in below
    assert "Partial" in below  # a frequent event sends one row per task


def test_stage_has_its_days_together(spark):
    rows = stage(spark, SF)
    assert rows.columns == TELEMETRY_COLUMNS
    assert rows.count() == silver(spark, SF).count() == cleaning.dedup(derived.telemetry(spark, SF)).count()
    assert not exchanges(rows)


def test_stream_files_are_compressed(spark):
    files = glob.glob(f"{streaming.events_dir(spark, SF)}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)


def test_detections_are_written_once(spark):
    found = forests.detected(spark, SF)
    folder = work(spark, SF, "forest")
    assert not glob.glob(f"{folder}/detected/part-*")
    again = ml.detections(spark, folder)
    columns = ["event_id", "anomaly_flag", "anomaly_score_ml", "anomaly_type", "risk_score", "status"]
    assert found.count() == silver(spark, SF).count()
    assert not found.select(columns).exceptAll(again.select(columns)).count()
