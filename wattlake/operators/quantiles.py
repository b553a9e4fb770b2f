"""Exact quantiles that no single task has to hold.

``percentile`` keeps every distinct value of a group in one task's buffer.  Here approximate
quantiles just below and above the wanted rank bracket the answer.  They are found for all
columns in one pass with map-side combine; a second pass counts the values below and inside
each bracket.  A bracket with more than ``MOST`` values is cut again by its own quantiles, which
leaves about a two-hundredth of it, whatever the spread of the values: infinities and far outliers are values
like others.  Where values equal to an end are a large share, they are counted apart and the search goes on strictly
inside.  Only the values inside the last brackets are shuffled and ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: values a bracket may keep; the last window of a column sees no more different ones
MOST = 20_000
#: how far, as a share of the ranks, the bracket's ends lie from the wanted one
MARGIN = 0.0025
#: the error of the approximate quantiles is 1 / ACCURACY, well inside the margin
ACCURACY = 2_000


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def brackets(df: DataFrame, columns: list[str], fraction: float, most: int = MOST) -> dict[str, dict]:
    """Per column with values: ends, values below and inside, and the two ranks around the quantile."""
    values = df.select(*[_number(c).alias(c) for c in columns])
    first = values.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).first()
    found = {}
    for c in columns:
        if first[c]["n"]:
            position = (first[c]["n"] - 1) * float(fraction)
            found[c] = {"lo": first[c]["lo"], "hi": first[c]["hi"], "below": 0, "inside": first[c]["n"],
                        "low": math.floor(position), "high": math.ceil(position), "part": position - math.floor(position)}
    while wide := {c: b for c, b in found.items() if b["inside"] > most and b["lo"] < b["hi"] and not b.get("met")}:
        ends = values.agg(*[
            F.percentile_approx(
                F.when(F.col(c).between(b["lo"], b["hi"]), F.col(c)),
                [max(0.0, (b["low"] - b["below"]) / b["inside"] - MARGIN), min(1.0, (b["high"] - b["below"] + 1) / b["inside"] + MARGIN)],
                ACCURACY,
            ).alias(c)
            for c, b in wide.items()
        ]).first()
        counts = values.agg(*[
            F.struct(F.count_if(F.col(c) < ends[c][0]).alias("below"), F.count_if(F.col(c).between(*ends[c])).alias("inside")).alias(c)
            for c in wide
        ]).first()
        heavy = {}
        for c, b in wide.items():
            below, inside = counts[c]["below"], counts[c]["inside"]
            if not below <= b["low"] <= b["high"] < below + inside:
                raise ArithmeticError(f"the approximate quantiles of {c} miss its rank")
            if 2 * inside > b["inside"]:  # an end holds a large share of the values
                heavy[c] = b
            b.update(lo=ends[c][0], hi=ends[c][1], below=below, inside=inside)
        if heavy := {c: b for c, b in heavy.items() if b["inside"] > most and b["lo"] < b["hi"]}:
            _set_ends_apart(values, heavy)
    return found


def _set_ends_apart(values: DataFrame, wide: dict[str, dict]) -> None:
    """Take the values equal to either end out of each bracket, if the wanted ranks lie between them.

    A rank among the values equal to an end makes that value the bracket, with its neighbour where the two ranks
    fall on both sides of the border; such a bracket has two values at most, however many rows have them.
    """
    facts = values.agg(*[
        F.struct(
            F.count_if(F.col(c) == b["lo"]).alias("at_lo"), F.count_if(F.col(c) == b["hi"]).alias("at_hi"),
            F.min(F.when((F.col(c) > b["lo"]) & (F.col(c) <= b["hi"]), F.col(c))).alias("next"),
            F.max(F.when((F.col(c) >= b["lo"]) & (F.col(c) < b["hi"]), F.col(c))).alias("last"),
        ).alias(c)
        for c, b in wide.items()
    ]).first()
    for c, b in wide.items():
        f = facts[c]
        first, after = b["below"] + f["at_lo"], b["below"] + b["inside"] - f["at_hi"]  # ranks strictly inside: first to after - 1
        if b["high"] < first:
            b.update(hi=b["lo"], inside=f["at_lo"])
        elif b["low"] >= after:
            b.update(lo=b["hi"], below=after, inside=f["at_hi"])
        elif b["low"] < first:
            b.update(hi=f["next"], met=True)
        elif b["high"] >= after:
            n = values.where(F.col(c) == f["last"]).count() if f["last"] > b["lo"] else f["at_lo"]
            b.update(lo=f["last"], below=after - n, met=True)
        else:
            b.update(lo=f["next"], hi=f["last"], below=first, inside=after - first)


def bracket_values(df: DataFrame, found: dict[str, dict]) -> DataFrame:
    """(name, value, n): the counted values inside the brackets."""
    kept = [
        F.when(_number(c).between(b["lo"], b["hi"]), F.struct(F.lit(c).alias("name"), _number(c).alias("value")))
        for c, b in found.items()
    ]
    values = df.select(F.explode(F.array_compact(F.array(*kept))).alias("v"))
    return values.groupBy("v.name", "v.value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, columns: list[str], fraction: float = 0.5) -> DataFrame:
    """One row; each column holds its linearly interpolated quantile (null if it has no values)."""
    found = brackets(df, columns, fraction)
    if not found:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(c) for c in columns])
    upto = F.sum("n").over(Window.partitionBy("name").orderBy("value"))
    ranked = bracket_values(df, found).withColumn("upto", upto)

    def at(c: str, rank: int) -> Column:
        rank -= found[c]["below"]
        holds = (F.col("name") == c) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(holds, F.col("value")))

    ends = {c: (at(c, found[c]["low"]), at(c, found[c]["high"])) for c in found}

    def between(low: Column, high: Column, part: float) -> Column:
        return F.when(low == high, low).otherwise(low + (high - low) * part)  # also of two infinities

    return ranked.agg(*[
        (between(*ends[c], found[c]["part"]) if c in found else F.lit(None).cast("double")).alias(c) for c in columns
    ])
