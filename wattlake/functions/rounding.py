"""Rounding that is reproducible whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round a single reading: scale, nearest even integer, unscale.

    ``+ 0.0`` turns a negative zero into zero.
    """
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round_stable(value: Column, digits: int) -> Column:
    """Round an aggregated double.

    The last bits of a distributed double sum depend on the order of addition, which
    could flip a value lying exactly between two results.  Rounding to six guard digits
    first removes that noise, so one partition and a thousand give the same answer, as long as
    the steps of a double at the sum's size are finer than the guard digits (with one digit, up
    to about 1e8).
    """
    guarded = F.rint(value * F.lit(float(10 ** (digits + 6)))) / F.lit(1e6)
    return F.rint(guarded) / F.lit(float(10 ** digits)) + F.lit(0.0)


def round_columns(df: DataFrame, digits: int, only: list[str] | None = None) -> DataFrame:
    """Round every double column (or those named) of an aggregated frame."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if only is not None:
        names = [n for n in names if n in only]
    return df.withColumns({n: round_stable(F.col(n), digits) for n in names}) if names else df
