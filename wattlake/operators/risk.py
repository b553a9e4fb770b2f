"""Risk summaries and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.bands import risk_band
from wattlake.operators.gold import critical_rows
from wattlake.operators.quantiles import exact_quantiles
from wattlake.operators.rollup import avg, distinct, peak, rollup, rows, rows_where, total
from wattlake.schema import NORMAL, STATUSES, SUBSTATION_KEYS, TRANSFORMER_KEYS


def transformer_risk_summary(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(*TRANSFORMER_KEYS).agg(
        F.avg("load_percent").alias("avg_load_percent"), F.max("load_percent").alias("max_load_percent"),
        F.avg("temperature_c").alias("avg_temperature_c"), F.max("temperature_c").alias("max_temperature_c"),
        F.avg("voltage_kv").alias("avg_voltage_kv"), F.min("voltage_kv").alias("min_voltage_kv"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.avg("risk_score").alias("avg_risk_score"), F.max("risk_score").alias("max_risk_score"),
        F.coalesce(F.stddev_samp("risk_score"), F.lit(0.0)).alias("risk_score_std"),
        F.sum("fault_indicator").alias("fault_count"), F.count("event_id").alias("record_count"),
        F.avg("anomaly_score").alias("avg_anomaly_score"),
        F.avg("communication_latency_ms").alias("avg_latency_ms"),
    )
    return grouped.withColumn("worst_status", risk_band(F.col("max_risk_score"))).orderBy(
        F.desc("max_risk_score"), "transformer_id"
    )


def _risk_measures(anomaly):
    return [
        avg("avg_load_percent", "load_percent"), peak("max_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"), avg("avg_voltage_kv", "voltage_kv"),
        avg("avg_power_factor", "power_factor"), avg("avg_risk_score", "risk_score"),
        peak("max_risk_score", "risk_score"), total("fault_count", "fault_indicator"), anomaly,
        distinct("transformer_count", "transformer_id"),
    ]


def substation_risk_summary(df: DataFrame) -> DataFrame:
    if "anomaly_flag" in df.columns:
        anomaly = total("anomaly_count", "anomaly_flag")
    else:
        anomaly = rows_where("anomaly_count", F.col("risk_score") > 50)
    grouped = rollup(df, SUBSTATION_KEYS, _risk_measures(anomaly) + [rows("record_count")])
    return grouped.withColumn("worst_status", risk_band(F.col("max_risk_score"))).orderBy(
        F.desc("max_risk_score"), *SUBSTATION_KEYS
    )


def region_risk_summary(df: DataFrame) -> DataFrame:
    anomaly = rows_where("anomaly_count", F.col("risk_score") > 50)
    measures = _risk_measures(anomaly) + [distinct("substation_count", "substation_id"), rows("record_count")]
    grouped = rollup(df, ["region"], measures)
    return grouped.withColumn("worst_status", risk_band(F.col("max_risk_score"))).orderBy(
        F.desc("avg_risk_score"), "region"
    )


def critical_with_types(df: DataFrame, skip_normal: bool = False) -> DataFrame:
    """Transformers with rows at risk 85 or more and the sorted list of their anomaly types.

    With ``skip_normal`` the Normal label is left out, and stands in when nothing is left.
    The set per transformer holds at most the eleven known labels.
    """
    kind = F.when(F.col("anomaly_type") != NORMAL, F.col("anomaly_type")) if skip_normal else F.col("anomaly_type")
    joined = F.array_join(F.array_sort(F.collect_set(kind)), ", ")
    grouped = critical_rows(df).groupBy(*TRANSFORMER_KEYS).agg(
        F.avg("load_percent").alias("avg_load"), F.max("temperature_c").alias("max_temp"),
        F.avg("voltage_kv").alias("avg_voltage"), F.avg("risk_score").alias("avg_risk"),
        F.max("risk_score").alias("max_risk"),
        F.when(joined == "", NORMAL).otherwise(joined).alias("anomaly_types"),
    )
    return grouped.orderBy(F.desc("max_risk"), "transformer_id")


def risk_distribution(df: DataFrame) -> DataFrame:
    """(risk_level, records) with a row for every level, zeros included."""
    counts = df.agg(*[F.count_if(risk_band(F.col("risk_score")) == s).alias(s) for s in STATUSES])
    return counts.unpivot([], [F.col(f"`{s}`") for s in STATUSES], "risk_level", "records")


def risk_statistics(df: DataFrame) -> DataFrame:
    """Mean, median, deviation, lowest and highest risk."""
    facts = df.agg(
        F.avg("risk_score").alias("mean_risk"), F.stddev_samp("risk_score").alias("std_risk"),
        F.min("risk_score").alias("min_risk"), F.max("risk_score").alias("max_risk"),
    )
    middle = exact_quantiles(df, ["risk_score"]).select(F.col("risk_score").alias("median_risk"))
    return facts.crossJoin(F.broadcast(middle))


def top_risk_records(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc("risk_score"), "event_id").limit(n).select(
        "event_id", *TRANSFORMER_KEYS, "load_percent", "temperature_c", "voltage_kv", "risk_score", "status"
    )
