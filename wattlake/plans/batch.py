"""Bronze, silver and gold layers as written Parquet tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators import cleaning
from wattlake.operators.quantiles import exact_quantiles
from wattlake.operators.timeindex import time_index
from wattlake.schema import IMPUTED_COLUMNS, PARTITION_COLUMN, SILVER_SCHEMA, TELEMETRY_SCHEMA
from wattlake.sources.dimensions import settled

#: of the layers' files
COMPRESSION = "zstd"
#: Row groups of unpartitioned layers: a task that sorts their rows by day reads no more than one of this size.
ROW_GROUP_BYTES = 16 << 20


def add_ingestion_metadata(df: DataFrame, batch: str = "batch_001", at: datetime | None = None) -> DataFrame:
    when = F.lit(at) if at is not None else F.current_timestamp()
    return df.withColumns({"ingestion_time": when, "ingestion_batch": F.lit(batch)})


def write_layer(df: DataFrame, path: str, partition_by: str | None = None, placed: bool = False) -> None:
    """Overwrite one layer.

    A partitioned layer is rebalanced on its partition column first: AQE then splits a day
    that holds too many rows and packs small days, so file sizes stay even under skew.
    ``placed`` rows stand together by that column already and are written without a shuffle.
    """
    if partition_by is None:
        df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path, compression=COMPRESSION)
    else:
        rows = df if placed else df.hint("rebalance", F.col(partition_by))
        rows.write.mode("overwrite").partitionBy(partition_by).parquet(path, compression=COMPRESSION)


def build_bronze(spark: SparkSession, raw: DataFrame, path: str, batch: str = "batch_001") -> DataFrame:
    write_layer(add_ingestion_metadata(raw, batch), path)
    return spark.read.parquet(path)


def build_silver(
    spark: SparkSession, bronze: DataFrame, stage_path: str, silver_path: str, profile: str = "default", index_path: str | None = None,
    settled_rows: bool = False,
) -> DataFrame:
    """Write the silver table, partitioned by day, and return a reader of it.

    The deduplicated rows are written once to ``stage_path``, days together: medians, means and the final
    rows each read that table (medians and means only their own columns) instead of
    shuffling the raw rows three times.  The stage also survives the loss of executors.
    ``settled_rows`` says that ``bronze`` has each event once and its days together, as ``derived.distinct_telemetry``.
    Medians and means, one row each, become constants of the final projection.
    ``index_path`` gets the counts of rows by second (see ``timeindex``), for boundaries in time.
    """
    day = F.to_date("timestamp")
    if not settled_rows:
        bronze = cleaning.dedup(bronze).withColumn(PARTITION_COLUMN, day).hint("rebalance", F.col(PARTITION_COLUMN)).drop(PARTITION_COLUMN)
    write_layer(bronze, stage_path)
    stage = spark.read.schema(TELEMETRY_SCHEMA).parquet(stage_path)
    cleaned = cleaning.clean(stage, settled(exact_quantiles(stage, IMPUTED_COLUMNS)), profile)
    scored = cleaning.add_zscores(cleaned, settled(cleaning.zscore_statistics(cleaned)))
    final = cleaning.project_final(cleaning.silver_metadata(scored))
    write_layer(final.withColumn(PARTITION_COLUMN, day), silver_path, PARTITION_COLUMN, placed=True)
    silver = read_silver(spark, silver_path)
    if index_path is not None:
        write_layer(time_index(silver), index_path)
    return silver


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Reader with the declared schema, which spares the inference job."""
    return spark.read.schema(T.StructType(SILVER_SCHEMA.fields).add(PARTITION_COLUMN, "date")).parquet(path)
