import json
from datetime import datetime

from readings import reading
from pyspark.sql import functions as F

from wattlake.schema import STREAM_COLUMNS
from wattlake.sources.dimensions import substation_dimension
from wattlake.streaming import ingest


def write_events(frame, folder, rows, name):
    folder.mkdir(parents=True, exist_ok=True)
    df = frame(rows).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")).select(*STREAM_COLUMNS)
    (folder / name).write_text("\n".join(df.toJSON().collect()) + "\n")


def test_restart_neither_repeats_nor_loses(spark, frame, tmp_path):
    events, sink, check = tmp_path / "in", f"{tmp_path}/sink", f"{tmp_path}/check"
    write_events(frame, events, [reading(i) for i in range(30)], "a.jsonl")
    assert ingest.drain(spark, str(events), sink, check).count() == 30
    assert ingest.drain(spark, str(events), sink, check).count() == 30
    write_events(frame, events, [reading(i, fault_indicator=1) for i in range(30, 40)], "b.jsonl")
    out = ingest.drain(spark, str(events), sink, check, max_files=1)
    assert out.count() == 40 and out.select("event_id").distinct().count() == 40
    assert out.columns == ingest.SINK_COLUMNS
    summary = ingest.end_summary(out).first()
    assert (summary["events_processed"], summary["anomalies_detected"]) == (40, 10)


def test_bad_lines_are_kept_aside_and_empty_files_do_no_harm(spark, frame, tmp_path):
    events = tmp_path / "in"
    write_events(frame, events, [reading(i) for i in range(5)], "a.jsonl")
    (events / "empty.jsonl").write_text("")
    (events / "bad.jsonl").write_text('{"event_id": "EVT-9", "load_\n{"event_id": "EVT-8", "load_percent": "high"}\n')
    out = ingest.drain(spark, str(events), f"{tmp_path}/sink", f"{tmp_path}/check")
    assert out.count() == 5
    ingest.quarantine(spark, str(events), f"{tmp_path}/bad", f"{tmp_path}/bad_check", None).awaitTermination()
    assert spark.read.schema("line string").json(f"{tmp_path}/bad").count() == 2
    ingest.run_totals(spark, str(events), f"{tmp_path}/totals", f"{tmp_path}/totals_check", None).awaitTermination()
    totals = spark.read.parquet(f"{tmp_path}/totals").first()
    assert (totals["received"], totals["processed"], totals["anomalies"]) == (7, 5, 0)


def test_totals_run_on(spark, frame, tmp_path):
    events = tmp_path / "in"
    for name, start in (("a.jsonl", 0), ("b.jsonl", 10)):
        write_events(frame, events, [reading(start + i, anomaly_score=0.9) for i in range(10)], name)
        ingest.run_totals(spark, str(events), f"{tmp_path}/t", f"{tmp_path}/c", None).awaitTermination()
    totals = spark.read.parquet(f"{tmp_path}/t").first()
    assert (totals["received"], totals["anomalies"]) == (20, 20)


def test_live_message_uses_names(spark, frame):
    df = frame([reading(0), reading(1, load_percent=95.0, temperature_c=80.0), reading(2, substation_id="SUB-999")])
    df = df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    got = [r["message"] for r in ingest.score_live(df, substation_dimension(spark)).orderBy("event_id").collect()]
    assert got == ["Normal operation at Delhi", "Warning: Compound Anomaly at SUB-001", "Normal operation at SUB-999"]


def test_freshness_and_heartbeat(spark, frame, tmp_path):
    now = F.lit(datetime(2025, 4, 1, 0, 1, 0)).cast("timestamp_ntz")
    sink = frame([reading(0), reading(1, substation_id="SUB-002")]).withColumnRenamed("timestamp", "ts")
    got = {r["substation_id"]: r["status_text"] for r in ingest.freshness(sink, now, "ts").collect()}
    assert got == {"SUB-001": "STREAM OFFLINE", "SUB-002": "STREAM ONLINE", "ALL": "STREAM ONLINE"}
    for status, at, online in (("running", "2025-04-01T00:00:45", True), ("stopped", "2025-04-01T00:00:45", False),
                               ("running", "2025-04-01T00:00:10", False), ("running", None, False)):
        path = tmp_path / f"{status}{online}{at is None}.json"
        path.write_text(json.dumps({"last_update": at, "events_generated": 3, "anomalies_detected": 1, "status": status}))
        assert ingest.read_heartbeat(spark, str(path), now).first()["online"] is online


def test_lines_of_a_packed_file_are_dealt_out_each_once(spark, frame, tmp_path):
    """One gzip file in a micro-batch, with equal and unreadable lines: all sinks have each line once, from more tasks than files, also after a
    restart with another number of files."""
    rows = [reading(i) for i in range(60)] + [reading(7)] * 3
    df = frame(rows).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")).select(*STREAM_COLUMNS)
    lines = df.toJSON().collect() + ['{"event_id": "EVT-9', "  ", "{}"]
    one = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    one.write.option("compression", "gzip").text(f"{tmp_path}/in")
    out = ingest.drain(spark, f"{tmp_path}/in", f"{tmp_path}/sink", f"{tmp_path}/check", max_files=2)
    ids = sorted(r["event_id"] or "" for r in out.select("event_id").collect())
    assert ids == sorted([f"EVT-{i:06d}" for i in range(60)] + ["EVT-000007"] * 3 + [""])
    assert out.select(F.input_file_name()).distinct().count() > 1
    one.limit(5).coalesce(1).write.mode("append").option("compression", "gzip").text(f"{tmp_path}/in")
    assert ingest.drain(spark, f"{tmp_path}/in", f"{tmp_path}/sink", f"{tmp_path}/check", max_files=20).count() == 69
    ingest.quarantine(spark, f"{tmp_path}/in", f"{tmp_path}/bad", f"{tmp_path}/bad_check", None, max_files=1).awaitTermination()
    assert [r["line"] for r in spark.read.schema("line string").json(f"{tmp_path}/bad").collect()] == ['{"event_id": "EVT-9']
    ingest.run_totals(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c", None, max_files=3).awaitTermination()
    totals = spark.read.parquet(f"{tmp_path}/t").first()
    assert (totals["received"], totals["processed"]) == (70, 69)


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"event_id": "EVT-1"}\n')
    events = ingest.parse_lines(spark.read.text(str(tmp_path)))
    for df in (ingest.enrich(ingest.readable(events)), ingest.unreadable(events)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
