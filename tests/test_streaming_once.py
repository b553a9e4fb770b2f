"""All sinks from one read: a failure between two of them loses nothing and repeats nothing."""

import pytest
from pyspark.errors import StreamingQueryException

from readings import reading
from test_streaming import write_events
from wattlake.streaming import once


def test_failure_between_sinks(spark, frame, tmp_path, monkeypatch):
    events, folder, check = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/check"
    write_events(frame, events, [reading(i) for i in range(20)], "a.jsonl")
    assert once.published(spark, f"{folder}/totals") is None
    once.ingest_once(spark, str(events), folder, check, None).awaitTermination()
    first = once.published(spark, f"{folder}/totals").first()
    assert (first["received"], first["processed"], first["anomalies"]) == (20, 20, 0)
    write_events(frame, events, [reading(i, fault_indicator=1) for i in range(20, 30)], "b.jsonl")
    (events / "bad.jsonl").write_text('{"event_id": "EVT-9", "load_\n')
    publish = once.publish

    def stop(table, path, batch_id):
        """The table is written, the pointer is not."""
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        raise RuntimeError("stopped before publishing")

    monkeypatch.setattr(once, "publish", stop)
    with pytest.raises(StreamingQueryException):
        once.ingest_once(spark, str(events), folder, check, None).awaitTermination()
    assert once.published(spark, f"{folder}/totals").first() == first
    monkeypatch.setattr(once, "publish", publish)
    once.ingest_once(spark, str(events), folder, check, None).awaitTermination()
    out = spark.read.parquet(f"{folder}/events")
    assert out.count() == 30 and out.select("event_id").distinct().count() == 30
    assert spark.read.schema("line string").json(f"{folder}/quarantine").where("line IS NOT NULL").count() == 1
    last = once.published(spark, f"{folder}/totals").first()
    assert (last["received"], last["processed"], last["anomalies"]) == (31, 30, 10)
    once.publish(once.published(spark, f"{folder}/totals"), f"{tmp_path}/again", 5)
    once.publish(once.published(spark, f"{folder}/totals"), f"{tmp_path}/again", 5)
    assert once.published(spark, f"{tmp_path}/again").collect() == [last]
