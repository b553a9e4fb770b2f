"""Event stream: JSON files in, scored Parquet out.

The file source log and the checkpoint make the Parquet sink exactly-once: a restarted
query neither repeats nor loses a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattlake.functions.labels import live_anomaly_type, live_message, live_status, stream_status
from wattlake.functions.scoring import live_risk, stream_risk
from wattlake.schema import NORMAL, STREAM_COLUMNS, STREAM_SCHEMA
from wattlake.sources.raw import to_timestamp_lenient

CORRUPT = "_corrupt_record"
SINK_COLUMNS = ["event_id", "ts"] + [c for c in STREAM_COLUMNS if c not in ("event_id", "timestamp")] + [
    "ingestion_time", "source",
]
FRESH_SECONDS = 30
#: Cores for each file of a micro-batch from which on its lines are dealt out.
IDLE_CORES = 4


def read_stream(spark: SparkSession, events_dir: str, max_files: int = 10, skip_damaged: bool = False) -> DataFrame:
    """JSON lines with the declared schema; an unparsable line keeps its text in one column.

    A damaged file, for example a truncated gzip, fails the query, so nothing is lost unseen.
    ``skip_damaged`` goes on with what could be read of it; ``lines_by_file`` then shows what that was.

    Lines are read as text and parsed as a whole.  The JSON source would parse only the
    columns a query uses, and two queries on the same files could then disagree on which
    lines are good.

    A gzip file can't be split, so a micro-batch has no more reading tasks than files.  Where that leaves most cores idle,
    the lines are dealt out before they are parsed.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("ignoreCorruptFiles", skip_damaged)
    cores = spark.sparkContext.defaultParallelism
    lines = reader.text(events_dir)
    return parse_lines(dealt_out(lines, cores) if cores >= IDLE_CORES * max_files else lines)


def dealt_out(lines: DataFrame, tasks: int) -> DataFrame:
    """The same lines in as many partitions, at random but alike in a repeated task: equal lines don't meet, and nothing is sorted."""
    return lines.repartition(tasks, F.rand(0))


def lines_by_file(spark: SparkSession, events_dir: str) -> DataFrame:
    """(file, size, lines): the lines readable in each file, damaged ones included up to the damage."""
    files = spark.read.format("binaryFile").load(events_dir).select(F.col("path").alias("file"), F.col("length").alias("size"))
    text = spark.read.option("ignoreCorruptFiles", True).text(events_dir)
    read = text.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("lines"))
    return files.join(read, F.regexp_replace("file", "^file:/+", "/") == F.regexp_replace("_file", "^file:/+", "/"), "left").select(
        "file", "size", F.coalesce("lines", F.lit(0)).alias("lines")
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """The events of the lines.  A generator makes them, since a filter on plain columns would parse each line once more."""
    schema = T.StructType(STREAM_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    event = F.from_json("value", schema, options)
    return lines.filter(F.length(F.trim("value")) > 0).select(F.inline(F.array(event)))


def readable(events: DataFrame) -> DataFrame:
    return events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(events: DataFrame) -> DataFrame:
    """Bad lines with whatever id could still be read from them."""
    return events.filter(F.col(CORRUPT).isNotNull()).select(
        "event_id", F.col(CORRUPT).alias("line"), F.current_timestamp().alias("quarantined_at")
    )


def enrich(events: DataFrame) -> DataFrame:
    """Parse the time, score and label; the arriving risk and status are replaced."""
    c = F.col
    scored = events.withColumn(
        "risk_score", stream_risk(c("anomaly_score"), c("load_percent"), c("temperature_c"), c("fault_indicator"))
    )
    return (
        scored.withColumns(
            {
                "ts": to_timestamp_lenient(c("timestamp")),
                "status": stream_status(c("risk_score"), c("anomaly_score"), c("fault_indicator")),
                "ingestion_time": F.current_timestamp(),
                "source": F.lit("stream"),
            }
        )
        .select(*SINK_COLUMNS)
    )


def score_live(events: DataFrame, dimension: DataFrame) -> DataFrame:
    """Live risk, status, type and feed text; substations missing from the dimension show their id."""
    c = F.col
    names = dimension.select("substation_id", c("name").alias("_name"))
    scored = events.join(names, "substation_id", "left").withColumn(
        "risk_score", live_risk(c("load_percent"), c("temperature_c"), c("voltage_kv"), c("fault_indicator"))
    )
    scored = scored.withColumn("status", live_status(c("risk_score")))
    scored = scored.withColumn("anomaly_type", live_anomaly_type(
        c("status"), c("load_percent"), c("temperature_c"), c("voltage_kv"), c("frequency_hz"), c("power_factor"),
        c("event_id"),
    ))
    place = F.coalesce(c("_name"), c("substation_id"))
    message = live_message(c("status"), c("anomaly_type"), c("substation_id"), place)
    return scored.withColumns({"message": message, "timestamp": to_timestamp_lenient(c("timestamp"))}).select(
        "event_id", "timestamp", "region", "substation_id", "transformer_id", "voltage_kv", "current_amp", "power_mw",
        "frequency_hz", "load_percent", "power_factor", "temperature_c", "fault_indicator", "anomaly_score",
        "risk_score", "status", "anomaly_type", "message",
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = "5 seconds", fmt: str = "parquet"
) -> StreamingQuery:
    """Append to files; ``interval=None`` takes all files now present and stops."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.option("compression", "zstd" if fmt == "parquet" else "gzip")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def ingest(
    spark: SparkSession, events_dir: str, sink: str, checkpoint: str, interval: str | None = "5 seconds",
    max_files: int = 10, skip_damaged: bool = False,
) -> StreamingQuery:
    events = read_stream(spark, events_dir, max_files, skip_damaged)
    return write_stream(enrich(readable(events)), sink, checkpoint, interval)


def quarantine(
    spark: SparkSession, events_dir: str, path: str, checkpoint: str, interval: str | None = "5 seconds",
    max_files: int = 10, skip_damaged: bool = False,
) -> StreamingQuery:
    """A second query on the same files that keeps the lines ``ingest`` skips."""
    events = read_stream(spark, events_dir, max_files, skip_damaged)
    return write_stream(unreadable(events), path, checkpoint, interval, "json")


def drain(spark: SparkSession, events_dir: str, sink: str, checkpoint: str, max_files: int = 10) -> DataFrame:
    """Ingest every file present, wait for the end and return a reader of the sink."""
    ingest(spark, events_dir, sink, checkpoint, None, max_files).awaitTermination()
    return spark.read.parquet(sink)


def _is_anomaly() -> Column:
    return F.col("status") != NORMAL


def totals(events: DataFrame) -> DataFrame:
    """Received and readable lines, anomalies among them and the newest time, on a stream or a table."""
    c = F.col
    ok = c(CORRUPT).isNull()
    risk = stream_risk(c("anomaly_score"), c("load_percent"), c("temperature_c"), c("fault_indicator"))
    status = stream_status(risk, c("anomaly_score"), c("fault_indicator"))
    return events.agg(
        F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("processed"),
        F.count_if(ok & (status != NORMAL)).alias("anomalies"),
        F.max(to_timestamp_lenient(c("timestamp"))).alias("last_ts"),
    )


def run_totals(
    spark: SparkSession, events_dir: str, path: str, checkpoint: str, interval: str | None = "5 seconds",
    max_files: int = 10, skip_damaged: bool = False,
) -> StreamingQuery:
    """Keep the running totals in a one-row table, rewritten after every micro-batch.

    The state is one row; rewriting the same totals after a retry changes nothing.
    """

    def rewrite(batch: DataFrame, _: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(path)

    writer = totals(read_stream(spark, events_dir, max_files, skip_damaged)).writeStream.outputMode("complete").option(
        "checkpointLocation", checkpoint
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.foreachBatch(rewrite).trigger(**trigger).start()


def end_summary(sink: DataFrame) -> DataFrame:
    return sink.agg(
        F.count(F.lit(1)).alias("events_processed"), F.count_if(_is_anomaly()).alias("anomalies_detected"),
        F.max("ts").alias("last_event_ts"),
    )


def freshness(sink: DataFrame, now: Column, column: str = "ingestion_time", limit: int = FRESH_SECONDS) -> DataFrame:
    """Newest time overall ("ALL") and per substation, its age at ``now`` and ONLINE or OFFLINE."""
    per = sink.groupBy("substation_id").agg(F.max(column).alias("last_update"))
    overall = per.agg(F.max("last_update").alias("last_update")).select(F.lit("ALL").alias("substation_id"), "last_update")
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_update").cast("timestamp"))
    seconds = age / 1000000.0
    return per.unionByName(overall).withColumns(
        {
            "age_seconds": seconds,
            "status_text": F.when(seconds < limit, "STREAM ONLINE").otherwise("STREAM OFFLINE"),
        }
    )


def read_heartbeat(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """The producer's heartbeat and whether it counts as online."""
    schema = "last_update string, events_generated bigint, anomalies_detected bigint, stream_start string, status string"
    beat = spark.read.schema(schema).option("multiLine", True).json(path)
    at = to_timestamp_lenient(F.col("last_update"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / 1000000.0
    online = F.coalesce((F.col("status") != "stopped") & (age < FRESH_SECONDS), F.lit(False))
    return beat.select(
        online.alias("online"), F.when(online, "STREAM ONLINE").otherwise("STREAM OFFLINE").alias("status_text"),
        "events_generated", "anomalies_detected", "last_update",
    )
