"""Positions in an order over a whole table, without one task that sees all rows."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import work_path


def with_position(df: DataFrame, order: list[Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """``df`` with each row's position, from 1, in ``order``.

    Rows are dealt out by range and written; each range ranks its own rows, and the rows of the ranges before it are
    added.  The driver sees one count per range.  Rows that ``order`` ties stay in one range; their positions are
    distinct, which of them comes first is not defined.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_path(spark, "positions", uuid.uuid4().hex[:12])
    df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    starts = spark.createDataFrame([(part, b) for (part, _), b in zip(counts, before)], "_range int, _before long")
    here = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = dealt.withColumn(name, here).join(F.broadcast(starts), "_range")  # one row per range
    return placed.withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)
