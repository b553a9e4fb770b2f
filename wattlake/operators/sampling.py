"""Samples and projections for scatter charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.picks import hash_slice, sample_order
from wattlake.functions.rounding import round_half_even
from wattlake.schema import NOMINAL_VOLTAGE_KV

SEED = 42
UNIFORM_SIZE = 1000
CHART_POINTS = 2500
PRIORITY_STATUSES = ["Critical", "High Risk", "Warning"]


def smallest_hashes(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """The ``n`` rows with the smallest hash of their event id, as ``_order`` and ``event_id`` sort them.

    A plain top-n would send ``n`` rows of every input partition to one task.  Here the
    rows are counted per hash slice first (a million small counts at most); only slices up
    to the one holding the n-th row go on, about ``n`` rows plus a millionth of the data,
    provided that event ids are distinct (rows after ``dedup``).  A null id counts as an empty one.
    """
    hashed = df.withColumn("_order", sample_order(F.coalesce("event_id", F.lit("")), seed))
    slice_ = hash_slice(F.col("_order"))
    counted = hashed.groupBy(slice_.alias("slice")).agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.orderBy("slice")) - F.col("c")
    last = counted.withColumn("before", before).filter(F.col("before") < n).agg(F.max("slice")).scalar()
    return hashed.filter(slice_ <= last).orderBy("_order", "event_id").limit(n)


def uniform_sample(df: DataFrame, n: int = UNIFORM_SIZE, seed: int = SEED) -> DataFrame:
    """``n`` rows in hash order: the same sample on every run."""
    return smallest_hashes(df, n, seed).drop("_order")


def priority_sample(df: DataFrame, target: int = CHART_POINTS, seed: int = SEED) -> DataFrame:
    """Every critical, high-risk and warning row, filled up to ``target`` with sampled others.

    At most ``target`` rows of the second kind are ranked, whatever the size of ``df``.
    """
    important = df.filter(F.col("status").isin(PRIORITY_STATUSES))
    room = F.lit(target) - important.agg(F.count(F.lit(1))).scalar()
    others = smallest_hashes(df.filter(F.col("status").isin("Normal", "Low")), target, seed)
    rank = F.row_number().over(Window.orderBy("_order", "event_id"))
    filling = others.withColumn("_rank", rank).filter(F.col("_rank") <= room)
    return important.unionByName(filling.drop("_rank", "_order"))


def _text(value: Column, digits: int) -> Column:
    return round_half_even(value, digits).cast(f"decimal(20,{digits})").cast("string")


def _hover(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def risk_landscape(df: DataFrame) -> DataFrame:
    """x voltage, y temperature, z risk."""
    c = F.col
    hover = _hover(
        "Transformer: ", c("transformer_id"), "<br>Region: ", c("region"),
        "<br>Voltage: ", _text(c("voltage_kv"), 1), " kV<br>Temperature: ", _text(c("temperature_c"), 1),
        "°C<br>Risk: ", c("risk_score"), "<br>Status: ", c("status"), "<br>Anomaly: ", c("anomaly_type"),
    )
    return df.select(
        "event_id", "status", round_half_even(c("voltage_kv"), 2).alias("x"),
        round_half_even(c("temperature_c"), 2).alias("y"), c("risk_score").alias("z"), hover.alias("hover"),
    )


def load_performance(df: DataFrame) -> DataFrame:
    """x load, y power factor, z temperature."""
    c = F.col
    hover = _hover(
        "Transformer: ", c("transformer_id"), "<br>Region: ", c("region"), "<br>Load: ", _text(c("load_percent"), 1),
        "%<br>Power Factor: ", _text(c("power_factor"), 3), "<br>Temperature: ", _text(c("temperature_c"), 1),
        "°C<br>Risk: ", c("risk_score"), "<br>Status: ", c("status"),
    )
    return df.select(
        "event_id", "status", round_half_even(c("load_percent"), 2).alias("x"),
        round_half_even(c("power_factor"), 4).alias("y"), round_half_even(c("temperature_c"), 2).alias("z"),
        hover.alias("hover"),
    )


def energy_space(df: DataFrame) -> DataFrame:
    """x generated, y consumed, z load, grouped by region."""
    c = F.col
    hover = _hover(
        "<b>", c("transformer_id"), "</b><br>Region: ", c("region"), "<br>Substation: ", c("substation_id"),
        "<br>Generated: ", F.format_number(F.rint("energy_generated_mwh").cast("bigint"), 0),
        " MWh<br>Consumed: ", F.format_number(F.rint("energy_consumed_mwh").cast("bigint"), 0),
        " MWh<br>Load: ", _text(c("load_percent"), 1), "%",
    )
    return df.select(
        "event_id", "region", c("energy_generated_mwh").alias("x"), c("energy_consumed_mwh").alias("y"),
        c("load_percent").alias("z"), hover.alias("hover"),
    )


def anomaly_space(df: DataFrame) -> DataFrame:
    """x distance from nominal voltage, y temperature, z anomaly score (or risk / 100)."""
    z = F.col("anomaly_score") if "anomaly_score" in df.columns else F.col("risk_score") / 100.0
    x = F.abs(round_half_even(F.col("voltage_kv") - NOMINAL_VOLTAGE_KV, 6))
    return df.select("event_id", "status", x.alias("x"), F.col("temperature_c").alias("y"), z.alias("z"))


def overview_space(df: DataFrame) -> DataFrame:
    """x load, y temperature, z risk."""
    c = F.col
    hover = _hover(
        "Transformer: ", c("transformer_id"), "<br>Substation: ", c("substation_id"), "<br>Load: ",
        _text(c("load_percent"), 1), "%<br>Temperature: ", _text(c("temperature_c"), 1), "°C<br>Risk Score: ",
        c("risk_score"), "<br>Status: ", c("status"),
    )
    return df.select(
        "event_id", "status", c("load_percent").alias("x"), c("temperature_c").alias("y"), c("risk_score").alias("z"),
        hover.alias("hover"),
    )
