"""One read of the event files for all sinks: scored events, quarantined lines and running totals.

Each micro-batch is read and parsed once and kept while its sinks are written.  Every sink has a folder per
batch id, which a repeated batch writes anew, so a restart after a failure between two sinks loses no event and
has none twice.  Totals become visible through a pointer that is written last; their readers always see
one whole table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.streaming.ingest import enrich, read_stream, readable, totals, unreadable

TOTALS = "received long, processed long, anomalies long, last_ts timestamp_ntz"


def publish(table: DataFrame, path: str, batch_id: int) -> None:
    """Write a small table as that of one batch, then point to it."""
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    pointer = table.sparkSession.createDataFrame([(batch_id,)], "batch long")
    pointer.coalesce(1).write.mode("append").parquet(f"{path}_pointer")


def published(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest published table, or the newest before a batch; None if there is none yet."""
    try:
        pointer = spark.read.schema("batch long").parquet(f"{path}_pointer")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        pointer = pointer.where(F.col("batch") < before)
    newest = pointer.agg(F.max("batch")).first()[0]
    return None if newest is None else spark.read.schema(TOTALS).parquet(f"{path}/batch_id={newest}")


def add_totals(spark: SparkSession, batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The totals up to this batch: its own and those published before it."""
    own = totals(batch).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in TOTALS.split(", ")])
    earlier = published(spark, path, batch_id)
    both = own if earlier is None else own.unionByName(earlier)
    return both.agg(*[F.sum(c).alias(c) for c in ("received", "processed", "anomalies")], F.max("last_ts").alias("last_ts"))


def write_batch(batch: DataFrame, batch_id: int, folder: str) -> None:
    """All sinks of one micro-batch."""
    kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        enrich(readable(kept)).write.mode("overwrite").parquet(f"{folder}/events/batch_id={batch_id}", compression="zstd")
        unreadable(kept).write.mode("overwrite").json(f"{folder}/quarantine/batch_id={batch_id}")
        publish(add_totals(batch.sparkSession, kept, f"{folder}/totals", batch_id), f"{folder}/totals", batch_id)
    finally:
        kept.unpersist()


def ingest_once(
    spark: SparkSession, events_dir: str, folder: str, checkpoint: str, interval: str | None = "5 seconds", max_files: int = 10,
    skip_damaged: bool = False,
) -> StreamingQuery:
    """Scored events, quarantined lines and totals under ``folder``; ``interval=None`` takes all files now present and stops."""
    writer = read_stream(spark, events_dir, max_files, skip_damaged).writeStream.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, folder)).trigger(**trigger).start()
