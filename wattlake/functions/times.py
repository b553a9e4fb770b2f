"""Time helpers for zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_hour(ts: Column) -> Column:
    """Start of the hour.

    ``date_trunc`` would hand back a zoned timestamp; subtracting the minutes and seconds
    keeps the zone-free type and so cannot meet a daylight-saving gap.
    """
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))
