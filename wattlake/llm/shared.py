"""Registration of the queries and written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: What separates words, as a character class of the JVM's regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share."""
    return work_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, a folder per value of ``by``, and read again: later jobs start from these files."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of the Arrow batches that texts travel in where their workers hold much besides.
BATCH_BYTES = "2m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python tasks of the jobs run inside get their rows in batches of ``BATCH_BYTES``: executor and worker hold a copy of
    each, and buffers that grow to it double."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as no column of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hash_sample(df: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if it has no more), chosen by a hash of ``columns``."""
    count, parts = df.count(), 1 << 40
    return df if count <= rows else df.where(F.pmod(F.xxhash64(*columns), F.lit(parts)) < rows * parts // count)
