"""Comparisons over time: newest fifth against the rest, last day against the days before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.rounding import round_stable
from wattlake.functions.times import hours
from wattlake.operators.rollup import Measure, distinct_where, rollup, rows, rows_where, total
from wattlake.operators.sampling import smallest_hashes
from wattlake.operators.timeindex import at_or_after, boundary, from_boundary, time_index

TREND_LIMIT = 50.0


def mark_recent(df: DataFrame, share: float = 0.8, index: DataFrame | None = None) -> DataFrame:
    """Add ``is_recent``: false for the oldest ``int(share * n)`` rows, true for the rest.

    Rows without a timestamp are not ranked and count as recent.  ``index`` is the stored ``time_index`` of ``df``.  The
    boundary is found when this is called; the rows themselves are only compared with it.
    """
    found = boundary(df, lambda n: F.floor(n * F.lit(float(share))), index)
    recent = F.lit(True) if found is None else F.coalesce(at_or_after(found), F.lit(True))
    return df.withColumn("is_recent", recent)


def newest(df: DataFrame, n: int = 50000, index: DataFrame | None = None) -> DataFrame:
    """The ``n`` newest rows, found by their boundary and not by a top-n through one task.

    With the stored ``index`` of a table partitioned by day, older days aren't read.  Rows without a timestamp come last:
    they fill up what is left of ``n``, in hash order.
    """
    seconds = time_index(df) if index is None else index
    dated = seconds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = boundary(df, lambda total: F.greatest(total - n, F.lit(0)), seconds)
    rows = df.filter(F.lit(False)) if found is None else from_boundary(df, found)
    if dated >= n:
        return rows
    undated = smallest_hashes(df.filter(F.col("timestamp").isNull()), n)
    rank = F.row_number().over(Window.orderBy("_order", "event_id"))  # n rows at most
    filling = undated.withColumn("_rank", rank).filter(F.col("_rank") <= n - dated)
    return rows.unionByName(filling.select(*df.columns))


def percent_change(recent: Column, earlier: Column, limit: float | None = TREND_LIMIT) -> Column:
    """100 * (recent - earlier) / |earlier|, one digit; 0 where it is undefined."""
    change = F.try_divide(recent - earlier, F.abs(earlier)) * 100.0
    if limit is not None:
        change = F.when(change.isNotNull(), F.greatest(F.least(change, F.lit(limit)), F.lit(-limit)))
    return round_stable(F.coalesce(change, F.lit(0.0)), 1)


_SUMMED = ("energy_generated_mwh", "energy_consumed_mwh", "load_percent")


def split_measures() -> list[Measure]:
    """Sums, counts and distinct critical transformers on each side of ``is_recent``."""
    out = []
    for tag, side in (("recent", F.col("is_recent")), ("earlier", ~F.col("is_recent"))):
        for value in _SUMMED:
            out += [total(f"{value}_sum_{tag}", F.when(side, F.col(value))), rows_where(f"{value}_n_{tag}", side & F.col(value).isNotNull())]
        out += [total(f"{value}_sum_{tag}", F.when(side, F.col(value))) for value in ("fault_indicator", "anomaly_flag")]
        out.append(distinct_where(f"critical_{tag}", "transformer_id", (F.col("status") == "Critical") & side))
    return out


def trend_columns(min_rows: int = 10) -> dict[str, Column]:
    """The six trends from ``split_measures`` and the number of rows ``n``; all 0 below ``min_rows`` rows."""

    def mean(value: str, side: str) -> Column:
        return F.try_divide(F.col(f"{value}_sum_{side}").cast("double"), F.col(f"{value}_n_{side}"))

    def trend_of_mean(value: str) -> Column:
        return percent_change(mean(value, "recent"), mean(value, "earlier"))

    def trend_of_sum(value: str) -> Column:
        recent, earlier = (F.coalesce(F.col(f"{value}_sum_{s}"), F.lit(0)) for s in ("recent", "earlier"))
        return percent_change(recent, earlier)

    criticals = [F.coalesce(F.col(f"critical_{s}"), F.lit(0)) for s in ("recent", "earlier")]
    values = {
        "generation_trend": trend_of_mean("energy_generated_mwh"),
        "consumption_trend": trend_of_mean("energy_consumed_mwh"),
        "load_trend": trend_of_mean("load_percent"),
        "transformer_trend": percent_change(*criticals, limit=None),
        "fault_trend": trend_of_sum("fault_indicator"),
        "anomaly_trend": trend_of_sum("anomaly_flag"),
    }
    enough = F.coalesce(F.col("n"), F.lit(0)) >= min_rows
    return {k: F.when(enough, v).otherwise(0.0) for k, v in values.items()}


def trends(df: DataFrame, min_rows: int = 10, index: DataFrame | None = None) -> DataFrame:
    """One row of six percentage trends, from one pass over ``df`` besides its boundary second."""
    facts = rollup(mark_recent(df, index=index), [], [rows("n"), *split_measures()])
    return facts.select(*[c.alias(k) for k, c in trend_columns(min_rows).items()])


def with_latest(df: DataFrame) -> DataFrame:
    """Attach the newest timestamp of ``df`` to every row as ``latest``."""
    return df.withColumn("latest", df.agg(F.max("timestamp")).scalar())


def period_columns(n_hours: int, previous_hours: int) -> tuple[Column, Column]:
    """(is in the last ``n_hours``, is in the ``previous_hours`` before that), given ``latest``."""
    start = F.col("latest") - hours(n_hours)
    ts = F.col("timestamp")
    return ts >= start, (ts < start) & (ts >= start - hours(previous_hours))


def day_over_previous(df: DataFrame) -> DataFrame:
    """Difference of means, last 24 hours minus the 48 hours before; 0 if either is empty."""
    current, previous = period_columns(24, 48)
    names = {"load_trend": "load_percent", "temp_trend": "temperature_c", "risk_trend": "risk_score"}
    facts = with_latest(df).agg(
        F.count_if(current).alias("n_now"), F.count_if(previous).alias("n_before"),
        *[F.avg(F.when(side, F.col(c))).alias(f"{a}_{tag}")
          for a, c in names.items() for tag, side in (("now", current), ("before", previous))],
    )
    filled = (F.col("n_now") > 0) & (F.col("n_before") > 0)
    return facts.select(
        *[F.when(filled, F.col(f"{a}_now") - F.col(f"{a}_before")).otherwise(0.0).alias(a) for a in names]
    )
