"""Raw telemetry files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.schema import RAW_SCHEMA


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with the declared schema, so no inference pass reads the data twice."""
    return spark.read.schema(RAW_SCHEMA).option("header", True).csv(path)


def write_raw(df: DataFrame, path: str) -> None:
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    df.withColumn("timestamp", text).write.mode("overwrite").option("header", True).csv(path)


def validate_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, state, filled): present, missing or extra, and how many rows have a value.

    A missing column fails the check; extra columns are ignored by the readers.
    """
    expected, actual = schema.fieldNames(), df.columns
    states = {c: "present" if c in actual else "missing" for c in expected}
    states.update({c: "extra" for c in actual if c not in expected})
    filled = df.agg(*[(F.count(c) if c in actual else F.lit(None).cast("bigint")).alias(c) for c in states])
    label = F.lit(None).cast("string")
    for name, state in states.items():
        label = F.when(F.col("column_name") == name, state).otherwise(label)
    return filled.unpivot([], list(states), "column_name", "filled").select("column_name", label.alias("state"), "filled")


def to_timestamp_lenient(text: Column) -> Column:
    """ISO or blank-separated date-time, with or without fractions; unreadable text becomes null.

    The wall time of the text, whatever the session's zone; an offset in the text is dropped.
    """
    return text.try_cast("timestamp_ntz")


def parse_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumn(column, to_timestamp_lenient(F.col(column)))
