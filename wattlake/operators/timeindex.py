"""Counts of rows by second, to find the row at a rank in time without reading the rows before it.

The index has at most one row per second, whatever the number of readings.  It is written with the
silver table; of a filtered frame it is counted from the timestamps alone.  The boundary second is found
in the index, and only that second's rows are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.picks import hash32
from wattlake.functions.times import floor_hour, hours
from wattlake.schema import PARTITION_COLUMN

#: Rows of a second that are ranked at once; more are narrowed down first.
MOST = 20_000


@dataclass(frozen=True)
class Boundary:
    """The row at a rank, by time, then hash slice of its event id, then id (a null one counts as empty)."""

    stamp: datetime
    part: int
    event: str


def moment(value: datetime) -> Column:
    """A time without a zone as a constant, whatever the session's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def event() -> Column:
    return F.coalesce(F.col("event_id"), F.lit(""))


def slice_of_event() -> Column:
    return F.shiftright(hash32(event()), 12)


def time_index(df: DataFrame) -> DataFrame:
    """(second, n, latest): the rows of each second and their newest time; rows without a time aren't counted."""
    ts = F.col("timestamp")
    second = F.date_trunc("second", ts).cast("timestamp_ntz").alias("second")
    return df.where(ts.isNotNull()).groupBy(second).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("latest"))


def _holding(counted: DataFrame, by: list[str], rank: Column | int) -> DataFrame:
    """The row of ``counted`` that holds rank ``rank`` (from 0), with the ``rank`` left inside of it."""
    upto = F.sum("n").over(Window.orderBy(*by))
    wanted = rank if isinstance(rank, Column) else F.lit(rank)
    held = counted.withColumn("_upto", upto).withColumn("_wanted", wanted).where("_upto > _wanted AND _upto - n <= _wanted")
    return held.withColumn("rank", F.col("_wanted") - (F.col("_upto") - F.col("n")))


def _boundary_second(index: DataFrame, target: Callable[[Column], Column]):
    """(second, n, rank inside of it) of the row at rank ``target(rows)``, or None."""
    per_hour = index.groupBy(floor_hour(F.col("second")).alias("hour")).agg(F.sum("n").alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    hour = _holding(per_hour, ["hour"], target(everything).cast("bigint")).select("hour", F.col("rank").alias("in_hour"))
    inside = (F.col("second") >= F.col("hour")) & (F.col("second") < F.col("hour") + hours(1))
    in_hour = index.join(F.broadcast(hour), inside)  # one row
    return _holding(in_hour, ["second"], F.col("in_hour")).select("second", "n", "rank").first()


def within_second(df: DataFrame, second: datetime) -> DataFrame:
    """Rows of one second; on a table partitioned by day only that day's files are read."""
    ts = F.col("timestamp")
    rows = df.where((ts >= moment(second)) & (ts < moment(second + timedelta(seconds=1))))
    if PARTITION_COLUMN in df.columns:
        rows = rows.where(F.col(PARTITION_COLUMN) == F.lit(second.date()))
    return rows


def boundary(df: DataFrame, target: Callable[[Column], Column], index: DataFrame | None = None) -> Boundary | None:
    """The row of ``df`` at rank ``target(number of rows)``, oldest first; None if there is none.

    ``index`` is the ``time_index`` of ``df``; without it the timestamps are counted once.  A second with more than ``MOST``
    rows is narrowed down by microseconds and by hash slices (a million of each at most), so that what is ranked stays about a
    millionth of the rows even where a third of them have one time, provided that event ids are distinct.
    """
    found = _boundary_second(time_index(df) if index is None else index, target)
    if found is None:
        return None
    rows = within_second(df, found["second"]).select("timestamp", event().alias("event_id"))
    rank, n = found["rank"], found["n"]
    for key in (F.col("timestamp"), slice_of_event()):
        if n > MOST:
            held = _holding(rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")), ["key"], rank).first()
            rows, rank, n = rows.where(key == (moment(held["key"]) if isinstance(held["key"], datetime) else F.lit(held["key"]))), held["rank"], held["n"]
    ordered = rows.select("timestamp", slice_of_event().alias("part"), "event_id")
    place = F.row_number().over(Window.orderBy("timestamp", "part", "event_id")) - 1
    row = ordered.withColumn("place", place).where(F.col("place") == rank).first()
    return Boundary(row["timestamp"], row["part"], row["event_id"])


def at_or_after(b: Boundary) -> Column:
    """Whether a row is the boundary's or a newer one."""
    ts, part = F.col("timestamp"), slice_of_event()
    tie = (part > b.part) | ((part == b.part) & (event() >= F.lit(b.event)))
    return (ts > moment(b.stamp)) | ((ts == moment(b.stamp)) & tie)


def from_boundary(df: DataFrame, b: Boundary) -> DataFrame:
    """Rows at or after the boundary; on a table partitioned by day older days aren't read."""
    rows = df.where(F.col("timestamp") >= moment(b.stamp)).where(at_or_after(b))
    if PARTITION_COLUMN in df.columns:
        rows = rows.where(F.col(PARTITION_COLUMN) >= F.lit(b.stamp.date()))
    return rows
