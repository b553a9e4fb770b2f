"""Stream queries: the readings as JSON files, ingested by a real streaming query."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import QUERIES, on_raw, raw, register, work
from catalog.scoring import LIVE_RISK, LIVE_STATUS, LIVE_TYPE, STREAM_RISK, stream_status_sql
from catalog.topology import DIM_CTES
from wattlake.operators import dashboard
from wattlake.schema import STREAM_COLUMNS
from wattlake.sources.dimensions import substation_dimension
from wattlake.streaming import ingest, once

_DONE: set[tuple[str, str]] = set()


def events_dir(spark, sf_dir):
    """The readings as stream files, written once per application."""
    path = work(spark, sf_dir, "stream/events")
    key = (spark.sparkContext.applicationId, path)
    if key not in _DONE:
        text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
        events = raw(spark, sf_dir).withColumns({"timestamp": text, "risk_score": F.lit(0)}).select(*STREAM_COLUMNS)
        events.write.mode("overwrite").option("compression", "gzip").json(path)
        _DONE.add(key)
    return path


def sink(spark, sf_dir):
    return ingest.drain(
        spark, events_dir(spark, sf_dir), work(spark, sf_dir, "stream/sink"), work(spark, sf_dir, "stream/checkpoint"), 4)


_EVENTS = """ev AS (SELECT * REPLACE (0 AS risk_score) FROM raw),
sc AS (SELECT *, {risk} AS r FROM (SELECT * REPLACE (coalesce(anomaly_score, 0) AS anomaly_score,
    coalesce(load_percent, 0) AS load_percent, coalesce(temperature_c, 0) AS temperature_c), load_percent AS load0,
    temperature_c AS temp0 FROM ev)),
sk AS (SELECT *, {status} AS s FROM sc)""".format(risk=STREAM_RISK, status=stream_status_sql("r"))
_KEEP = [c for c in STREAM_COLUMNS if c not in
         ("timestamp", "risk_score", "status", "load_percent", "temperature_c")]


def on_sink(sql: str) -> str:
    return on_raw(sql).replace("\nSELECT", f",\n{_EVENTS}\nSELECT", 1)


@register("st1_enrich_stream", on_sink(f"""SELECT {', '.join(_KEEP)}, load0 AS load_percent, temp0 AS temperature_c,
    "timestamp" AS ts, r AS risk_score, s AS status, 'stream' AS source, TRUE AS has_ingestion_time FROM sk"""),
    source="none")
def _(spark, sf_dir):
    out = sink(spark, sf_dir)
    return out.withColumn("has_ingestion_time", F.col("ingestion_time").isNotNull()).drop("ingestion_time")


@register("st2_append_exactly_once", on_sink("""SELECT substation_id, count(*) AS events FROM sk GROUP BY 1"""),
          source="none")
def _(spark, sf_dir):
    sink(spark, sf_dir)
    return sink(spark, sf_dir).groupBy("substation_id").agg(F.count(F.lit(1)).alias("events"))


@register("st3_quarantine_unreadable", on_raw("""SELECT outage_duration_min > 0 AS bad_line, count(*) AS events FROM raw
    GROUP BY 1"""), source="none")
def _(spark, sf_dir):
    """Readings with an outage arrive as truncated lines."""
    folder = work(spark, sf_dir, "stream/mixed")
    events = raw(spark, sf_dir)
    line = F.to_json(F.struct(*[c for c in STREAM_COLUMNS if c != "timestamp"]))
    cut = F.when(F.col("outage_duration_min") > 0, F.substring(line, 1, 60)).otherwise(line)
    if (spark.sparkContext.applicationId, folder) not in _DONE:
        events.select(cut.alias("value")).write.mode("overwrite").option("compression", "gzip").text(f"{folder}/events")
        _DONE.add((spark.sparkContext.applicationId, folder))
    good = ingest.drain(spark, f"{folder}/events", f"{folder}/sink", f"{folder}/checkpoint")
    ingest.quarantine(spark, f"{folder}/events", f"{folder}/bad", f"{folder}/bad_checkpoint", None).awaitTermination()
    bad = spark.read.schema("event_id string, line string").json(f"{folder}/bad")
    counts = [df.agg(F.count(F.lit(1)).alias("events")).select(F.lit(b).alias("bad_line"), "events")
              for b, df in ((False, good), (True, bad))]
    return counts[0].unionByName(counts[1])


@register("st3_quarantined_events", on_raw("""SELECT event_id, outage_duration_min > 0 AS bad_line FROM raw"""), source="none")
def _(spark, sf_dir):
    """Every event once, on the side it belongs to."""
    folder = work(spark, sf_dir, "stream/mixed")
    QUERIES["st3_quarantine_unreadable"](spark, sf_dir)
    good = spark.read.parquet(f"{folder}/sink").select("event_id", F.lit(False).alias("bad_line"))
    bad = spark.read.schema("line string").json(f"{folder}/bad")
    return good.unionByName(bad.select(F.regexp_extract("line", '"event_id":"([^"]*)"', 1).alias("event_id"), F.lit(True).alias("bad_line")))


@register("st4_running_totals", on_sink("""SELECT count(*) AS received, count(*) AS processed,
    count(*) FILTER (s <> 'Normal') AS anomalies, max("timestamp") AS last_ts FROM sk"""), source="none")
def _(spark, sf_dir):
    path = work(spark, sf_dir, "stream/totals")
    ingest.run_totals(
        spark, events_dir(spark, sf_dir), path, work(spark, sf_dir, "stream/totals_checkpoint"), None).awaitTermination()
    return spark.read.parquet(path)


@register("st4_published_totals", on_sink("""SELECT count(*) AS received, count(*) AS processed,
    count(*) FILTER (s <> 'Normal') AS anomalies, max("timestamp") AS last_ts FROM sk"""), source="none")
def _(spark, sf_dir):
    """All sinks from one read; the totals as a dashboard reads them while they are written."""
    folder = work(spark, sf_dir, "stream/once")
    once.ingest_once(spark, events_dir(spark, sf_dir), folder, f"{folder}/checkpoint", None, 4).awaitTermination()
    return once.published(spark, f"{folder}/totals")


@register("st3_events_from_one_read", on_sink("SELECT event_id, s AS status FROM sk"), source="none")
def _(spark, sf_dir):
    folder = work(spark, sf_dir, "stream/once")
    once.ingest_once(spark, events_dir(spark, sf_dir), folder, f"{folder}/checkpoint", None, 4).awaitTermination()
    return spark.read.parquet(f"{folder}/events").select("event_id", "status")


@register("st5_end_summary", on_sink("""SELECT count(*) AS events_processed,
    count(*) FILTER (s <> 'Normal') AS anomalies_detected, max("timestamp") AS last_event_ts FROM sk"""), source="none")
def _(spark, sf_dir):
    return ingest.end_summary(sink(spark, sf_dir))


@register("st6_drain_and_stop", on_sink("SELECT region, s AS status, count(*) AS events FROM sk GROUP BY 1, 2"),
          source="none")
def _(spark, sf_dir):
    folder = work(spark, sf_dir, "stream/drained")
    out = ingest.drain(spark, events_dir(spark, sf_dir), f"{folder}/sink", f"{folder}/checkpoint", 2)
    return out.groupBy("region", "status").agg(F.count(F.lit(1)).alias("events"))


_NOW = "2025-06-29 00:00:10"


@register("st7_stream_freshness", on_sink(f"""SELECT *, CASE WHEN age_seconds < 30 THEN 'STREAM ONLINE'
    ELSE 'STREAM OFFLINE' END AS status_text FROM (SELECT substation_id, last_update,
    epoch_us(TIMESTAMP '{_NOW}') / 1e6 - epoch_us(last_update) / 1e6 AS age_seconds FROM
    (SELECT substation_id, max("timestamp") AS last_update FROM sk GROUP BY 1
     UNION ALL SELECT 'ALL', max("timestamp") FROM sk))"""), source="none")
def _(spark, sf_dir):
    return ingest.freshness(sink(spark, sf_dir), F.lit(_NOW).cast("timestamp_ntz"), column="ts")


_LIVE = f"""lv AS (SELECT raw.*, coalesce(name, raw.substation_id) AS place, {LIVE_RISK} AS r
    FROM raw LEFT JOIN dim USING (substation_id)),
ls AS (SELECT *, {LIVE_STATUS} AS s FROM lv), lt AS (SELECT *, {LIVE_TYPE} AS t FROM ls),
lm AS (SELECT *, CASE s WHEN 'Critical' THEN '⚠ Critical: ' || t || ' at ' || substation_id
    WHEN 'High Risk' THEN 'High Risk: ' || t || ' at ' || substation_id
    WHEN 'Warning' THEN 'Warning: ' || t || ' at ' || substation_id ELSE 'Normal operation at ' || place END AS message
    FROM lt)"""


def on_live(sql: str) -> str:
    return on_raw(sql).replace("\nSELECT", f",\n{DIM_CTES},\n{_LIVE}\nSELECT", 1)


def _live(spark, sf_dir):
    folder = work(spark, sf_dir, "stream/live")
    events = ingest.readable(ingest.read_stream(spark, events_dir(spark, sf_dir), 4))
    scored = ingest.score_live(events, substation_dimension(spark))
    ingest.write_stream(scored, f"{folder}/sink", f"{folder}/checkpoint", None).awaitTermination()
    return spark.read.parquet(f"{folder}/sink")


@register("st8_live_scoring", on_live("""SELECT event_id, "timestamp", substation_id, r AS risk_score, s AS status,
    t AS anomaly_type, message FROM lm"""), source="none")
def _(spark, sf_dir):
    return _live(spark, sf_dir).select(
        "event_id", "timestamp", "substation_id", "risk_score", "status", "anomaly_type", "message")


_READ = ["region", "transformer_id", "voltage_kv", "current_amp", "power_mw", "frequency_hz", "load_percent", "power_factor",
         "temperature_c", "fault_indicator", "anomaly_score"]


@register("st8_live_scoring_whole", on_live(f"""SELECT event_id, "timestamp", substation_id, r AS risk_score, s AS status,
    t AS anomaly_type, message, {', '.join(_READ)} FROM lm"""), source="none")
def _(spark, sf_dir):
    return _live(spark, sf_dir)


@register("st7_heartbeat", on_sink("""SELECT count(*) AS events_generated, count(*) FILTER (s <> 'Normal') AS anomalies_detected,
    TRUE AS online FROM sk"""), source="none")
def _(spark, sf_dir):
    """A heartbeat written from the counts of the readings, read five seconds later."""
    path = work(spark, sf_dir, "stream/heartbeat")
    summary = ingest.end_summary(sink(spark, sf_dir))
    text = F.date_format("last_event_ts", "yyyy-MM-dd'T'HH:mm:ss")
    summary.select(
        text.alias("last_update"), F.col("events_processed").alias("events_generated"), "anomalies_detected",
        F.lit("running").alias("status"),
    ).coalesce(1).write.mode("overwrite").json(path)
    now = F.lit(summary.first()["last_event_ts"]).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(5))
    return ingest.read_heartbeat(spark, path, now).select("events_generated", "anomalies_detected", "online")


@register("t09_live_feed", on_live("""SELECT event_id, "timestamp", message FROM (SELECT * FROM lm
    WHERE risk_score >= 0 ORDER BY "timestamp" DESC, event_id LIMIT 50) ORDER BY "timestamp" DESC, event_id LIMIT 10"""),
    source="none")
def _(spark, sf_dir):
    return dashboard.live_feed(_live(spark, sf_dir)).select("event_id", "timestamp", "message")


@register("s08_read_stream", on_raw("""SELECT transformer_id, count(*) AS events, count(load_percent) AS with_load
    FROM raw GROUP BY 1"""), source="none")
def _(spark, sf_dir):
    """The events as read, before scoring, carried through a streaming query to a table."""
    folder = work(spark, sf_dir, "stream/as_read")
    events = ingest.readable(ingest.read_stream(spark, events_dir(spark, sf_dir)))
    ingest.write_stream(events, f"{folder}/sink", f"{folder}/checkpoint", None).awaitTermination()
    return spark.read.parquet(f"{folder}/sink").groupBy("transformer_id").agg(
        F.count(F.lit(1)).alias("events"), F.count("load_percent").alias("with_load"))


@register("s09_write_stream", on_sink("""SELECT s AS status, count(*) AS events FROM sk GROUP BY 1"""), source="none")
def _(spark, sf_dir):
    return sink(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("events"))


@register("u02_concat_files", on_sink("SELECT region, count(*) AS events, count(DISTINCT event_id) AS ids FROM sk GROUP BY 1"),
          source="none")
def _(spark, sf_dir):
    """All stream files as one frame: the file source unites them."""
    return sink(spark, sf_dir).groupBy("region").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"))
