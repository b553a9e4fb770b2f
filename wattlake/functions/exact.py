"""Sums of double readings that do not depend on the order of addition.

A reading is taken as a whole number of hundred-millionths, split into thousandths and the rest,
and both are added as 64-bit integers.  Integer sums are exact, so any number of partitions, retries
or partial results gives the same total, and the total is rounded to a double once, at its end.

Limits: a reading is kept to eight decimal digits; a total may reach 9.2e15 and a group 9.2e13 rows,
beyond which Spark raises an overflow error instead of a wrong number.  Readings that do not fit
(NaN, infinite, or above 9.2e10) are added as doubles beside, so they show as they do in a plain sum.
Nulls are skipped; a group of nulls has no total.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1e8
#: hundred-millionths in a thousandth
STEP = 100_000


def exact_parts(value: Column) -> dict[str, Column]:
    """The three sums of a total, by suffix; all of them merge by addition."""
    value = value.cast("double")
    units = F.rint(value * F.lit(SCALE)).try_cast("bigint")
    rest = units % F.lit(STEP)
    return {
        "thousandths": F.sum(((units - rest) / F.lit(STEP)).cast("bigint")),
        "rest": F.sum(rest),
        "beyond": F.sum(F.when(units.isNull(), value)),
    }


def merged(thousandths: Column, rest: Column, beyond: Column) -> Column:
    """The total as a double from its three sums."""
    whole = (
        thousandths.cast("decimal(19,0)") * F.lit(Decimal("0.001")) + rest.cast("decimal(19,0)") * F.lit(Decimal("0.00000001"))
    ).cast("double")
    return F.when(beyond.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + beyond)


def exact_sum(value: Column) -> Column:
    """Aggregate: the total of a double column."""
    parts = exact_parts(value)
    return merged(parts["thousandths"], parts["rest"], parts["beyond"])


def exact_avg(value: Column) -> Column:
    """Aggregate: the mean of a double column; null for a group without values."""
    return F.try_divide(exact_sum(value), F.count(value))
