"""Written layers: counts, exports, loading."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.rounding import round_half_even
from wattlake.schema import NOMINAL_FREQUENCY_HZ, NOMINAL_VOLTAGE_KV, NORMAL, SILVER_SCHEMA


def verify_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(layer, record_count) for each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def export_csv(tables: dict[str, DataFrame], folder: str, single_file: Collection[str] = ()) -> None:
    """Headered CSV files per table, as many as the table needs.

    Tables named in ``single_file`` get one file; only those whose rows are bounded (a row per
    region, hour, day, status or anomaly type) should be.
    """
    for name, df in tables.items():
        out = df.coalesce(1) if name in single_file else df
        out.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def complete_silver(df: DataFrame) -> DataFrame:
    """Add the columns an older silver table may lack."""
    added = {}
    if "voltage_deviation_kv" not in df.columns:
        added["voltage_deviation_kv"] = round_half_even(F.col("voltage_kv") - NOMINAL_VOLTAGE_KV, 6)
    if "frequency_deviation_hz" not in df.columns:
        added["frequency_deviation_hz"] = round_half_even(F.col("frequency_hz") - NOMINAL_FREQUENCY_HZ, 6)
    if "anomaly_flag" not in df.columns:
        added["anomaly_flag"] = (F.col("status") != NORMAL).cast("int")
    return df.withColumns(added) if added else df


def _silver_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headered CSV whose columns have the declared silver types; only its first line is read twice."""
    names = spark.read.option("header", True).csv(path).columns
    types = {f.name: f for f in SILVER_SCHEMA}
    schema = T.StructType([types.get(n, T.StructField(n, T.StringType())) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def load_silver(spark: SparkSession, candidates: list[str]) -> DataFrame:
    """The first existing table among the candidates (folders ending in csv are CSV).

    Only a missing path moves on to the next candidate; a table that can't be read is an error.
    """
    for path in candidates:
        try:
            return complete_silver(_silver_csv(spark, path) if path.rstrip("/").endswith("csv") else spark.read.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no silver table among {candidates}")


def load_summary(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def data_status(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(table_name, available, record_count, last_update) per expected table."""
    parts = []
    for name in names:
        try:
            df = spark.read.parquet(f"{folder}/{name}")
            stats = df.select(F.col("_metadata.file_modification_time").alias("at")).agg(
                F.count(F.lit(1)).alias("record_count"), F.max("at").alias("last_update")
            )
            parts.append(stats.select(F.lit(name).alias("table_name"), F.lit(True).alias("available"), "*"))
        except AnalysisException:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("table_name"), F.lit(False).alias("available"),
                    F.lit(0).cast("bigint").alias("record_count"),
                    F.lit(None).cast("timestamp").alias("last_update"),
                )
            )
    return reduce(DataFrame.unionByName, parts)
