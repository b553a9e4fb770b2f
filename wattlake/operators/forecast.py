"""Short forecasts from hourly aggregates.

Windows without a partition run over the hourly table, whose size is the covered time
span in hours and does not grow with the number of readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.times import floor_hour

HORIZON = 6


def hourly_series(df: DataFrame) -> DataFrame:
    return df.groupBy(floor_hour(F.col("timestamp")).alias("hour")).agg(
        F.avg("load_percent").alias("avg_load"),
        F.sum("energy_consumed_mwh").alias("total_consumption"),
        F.avg("temperature_c").alias("avg_temp"),
    )


def _steps() -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(HORIZON)))


def linear_forecast(hourly: DataFrame, value: str, upper: float | None = None, min_hours: int = 6) -> DataFrame:
    """(step, forecast_hour, forecast): least squares on the position of each hour, next six hours.

    Values are clipped to 0 and, if given, ``upper``.  Fewer than ``min_hours`` hours give no
    rows: too few points for a line.
    """
    position = F.row_number().over(Window.orderBy("hour")) - 1
    indexed = hourly.select("hour", F.col(value).alias("y"), position.cast("double").alias("x"))
    line = indexed.agg(
        F.count(F.lit(1)).alias("n"), F.max("hour").alias("last_hour"),
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
    ).filter(F.col("n") >= min_hours)
    steps = line.select("*", _steps().alias("step"))
    estimate = F.greatest(F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step")), F.lit(0.0))
    if upper is not None:
        estimate = F.least(estimate, F.lit(upper))
    ahead = F.col("last_hour") + F.make_dt_interval(F.lit(0), F.col("step"))
    return steps.select("step", ahead.alias("forecast_hour"), estimate.alias("forecast")).orderBy("step")


def load_forecast(df: DataFrame) -> DataFrame:
    return linear_forecast(hourly_series(df), "avg_load", upper=100.0)


def consumption_forecast(df: DataFrame) -> DataFrame:
    return linear_forecast(hourly_series(df), "total_consumption")


def forecast_report(df: DataFrame) -> DataFrame:
    """One row: load expected in one, three and six hours."""
    f = load_forecast(df)
    return f.agg(*[
        F.max(F.when(F.col("step") == s, F.col("forecast"))).alias(f"in_{s}h") for s in (1, 3, 6)
    ])


def moving_average_forecast(energy_by_hour: DataFrame, moving_hours: int = 3) -> DataFrame:
    """Mean of the last ``moving_hours`` hours of day, carried six hours ahead; hours wrap after 23.

    With fewer hours there is no such mean and no row.
    """
    order = Window.orderBy(F.desc("hour_of_day"))
    last = energy_by_hour.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= moving_hours)
    facts = last.agg(
        F.count(F.lit(1)).alias("n"), F.max("hour_of_day").alias("last_hour"),
        F.avg("avg_energy_generated_mwh").alias("generation_forecast"),
        F.avg("avg_energy_consumed_mwh").alias("consumption_forecast"),
    ).filter(F.col("n") == moving_hours)
    steps = facts.select("*", _steps().alias("step"))
    return steps.select(
        "step", ((F.col("last_hour") + F.col("step")) % 24).alias("hour_of_day"),
        "generation_forecast", "consumption_forecast",
    ).orderBy("step")
