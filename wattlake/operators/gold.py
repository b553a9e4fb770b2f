"""Gold layer: the eight summary tables, numbers rounded to two digits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.bands import risk_band, severity_rank
from wattlake.functions.rounding import round_columns
from wattlake.operators.rollup import (
    Measure, avg, combine, distinct, most_frequent, partials, peak, rollup, rows, total,
)
from wattlake.schema import NORMAL, SUBSTATION_KEYS, TRANSFORMER_KEYS

GOLD_TABLES = [
    "transformer_summary", "substation_summary", "region_summary", "hourly_summary", "daily_summary",
    "anomaly_summary", "severity_summary", "critical_transformers",
]
CRITICAL_RISK = 85


def transformer_measures() -> list[Measure]:
    return [
        total("total_power_mw", "power_mw"),
        avg("avg_voltage_kv", "voltage_kv"),
        avg("avg_current_amp", "current_amp"),
        avg("avg_power_mw", "power_mw"),
        avg("avg_frequency_hz", "frequency_hz"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_power_factor", "power_factor"),
        avg("avg_temperature_c", "temperature_c"),
        peak("max_temperature_c", "temperature_c"),
        total("total_energy_generated_mwh", "energy_generated_mwh"),
        total("total_energy_consumed_mwh", "energy_consumed_mwh"),
        avg("avg_latency_ms", "communication_latency_ms"),
        total("total_faults", "fault_indicator"),
        peak("max_risk_score", "risk_score"),
        avg("avg_risk_score", "risk_score"),
        rows("record_count"),
        distinct("distinct_anomaly_types", "anomaly_type"),
    ]


def region_measures() -> list[Measure]:
    return [
        total("total_power_mw", "power_mw"),
        avg("avg_voltage_kv", "voltage_kv"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_power_factor", "power_factor"),
        total("total_energy_generated_mwh", "energy_generated_mwh"),
        total("total_energy_consumed_mwh", "energy_consumed_mwh"),
        total("total_faults", "fault_indicator"),
        distinct("transformer_count", "transformer_id"),
        distinct("substation_count", "substation_id"),
        peak("max_risk_score", "risk_score"),
        avg("avg_risk_score", "risk_score"),
        rows("record_count"),
    ]


def hourly_measures() -> list[Measure]:
    return [
        total("total_power_mw", "power_mw"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_energy_generated_mwh", "energy_generated_mwh"),
        avg("avg_energy_consumed_mwh", "energy_consumed_mwh"),
        total("total_faults", "fault_indicator"),
        rows("record_count"),
        avg("avg_risk_score", "risk_score"),
    ]


def anomaly_measures() -> list[Measure]:
    return [
        rows("anomaly_count"),
        avg("avg_risk_score", "risk_score"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_voltage_kv", "voltage_kv"),
    ]


def dominant_anomaly_type(df: DataFrame) -> DataFrame:
    """Most frequent type among each transformer's non-normal rows; ties go to the first name."""
    counted = df.filter(F.col("status") != NORMAL).groupBy("transformer_id", "anomaly_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("anomaly_type")))
    return counted.groupBy("transformer_id").agg(best.alias("best")).select(
        "transformer_id", F.col("best.anomaly_type").alias("dominant_anomaly_type")
    )


def with_dominant_type(summary: DataFrame, df: DataFrame) -> DataFrame:
    joined = summary.join(dominant_anomaly_type(df), "transformer_id", "left")
    return joined.withColumn("dominant_anomaly_type", F.coalesce("dominant_anomaly_type", F.lit(NORMAL)))


def _dominant_measure() -> Measure:
    return most_frequent("dominant_anomaly_type", "anomaly_type", F.col("status") != NORMAL, NORMAL)


def _band_transformers(summary: DataFrame, digits: int | None) -> DataFrame:
    if digits is not None:
        summary = round_columns(summary, digits)
    banded = summary.withColumns(
        {"worst_status": risk_band(F.col("max_risk_score")), "status": risk_band(F.col("avg_risk_score"))}
    )
    order = [c for c in banded.columns if c != "dominant_anomaly_type"] + ["dominant_anomaly_type"]
    return banded.select(*order).orderBy(F.desc("avg_risk_score"), "transformer_id")


def transformer_rollup(df: DataFrame, digits: int | None) -> DataFrame:
    """One row per transformer with both bands; ``digits`` rounds before banding.

    The dominant type comes out of the same pass as the averages: the inner grouping by
    anomaly type that the distinct count needs already holds its frequencies.
    """
    return _band_transformers(rollup(df, TRANSFORMER_KEYS, transformer_measures() + [_dominant_measure()]), digits)


def transformer_summary(df: DataFrame) -> DataFrame:
    return transformer_rollup(df, digits=2)


def substation_measures() -> list[Measure]:
    return [m for m in region_measures() if m.alias != "substation_count"]


def substation_summary(df: DataFrame) -> DataFrame:
    return round_columns(rollup(df, SUBSTATION_KEYS, substation_measures()), 2).orderBy(*SUBSTATION_KEYS)


def region_summary(df: DataFrame) -> DataFrame:
    return round_columns(rollup(df, ["region"], region_measures()), 2).orderBy("region")


def hourly_summary(df: DataFrame) -> DataFrame:
    by_hour = df.withColumn("hour_of_day", F.hour("timestamp"))
    return round_columns(rollup(by_hour, ["hour_of_day"], hourly_measures()), 2).orderBy("hour_of_day")


def daily_summary(df: DataFrame) -> DataFrame:
    measures = [
        total("total_power_mw", "power_mw"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        total("total_energy_generated_mwh", "energy_generated_mwh"),
        total("total_energy_consumed_mwh", "energy_consumed_mwh"),
        total("total_faults", "fault_indicator"),
        rows("record_count"),
        avg("avg_risk_score", "risk_score"),
    ]
    by_day = df.withColumn("date", F.to_date("timestamp"))
    return round_columns(rollup(by_day, ["date"], measures), 2).orderBy("date")


def anomaly_summary(df: DataFrame) -> DataFrame:
    return _order_anomalies(
        rollup(df.filter(F.col("status") != NORMAL), ["anomaly_type", "status"], anomaly_measures())
    )


def _order_anomalies(grouped: DataFrame) -> DataFrame:
    return round_columns(grouped, 2).orderBy(F.desc("anomaly_count"), "anomaly_type", "status")


def severity_measures() -> list[Measure]:
    return [
        rows("count"),
        avg("avg_risk_score", "risk_score"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
    ]


def _order_severity(grouped: DataFrame) -> DataFrame:
    return round_columns(grouped, 2).orderBy(severity_rank(F.col("status")), "status")


def severity_summary(df: DataFrame) -> DataFrame:
    return _order_severity(rollup(df, ["status"], severity_measures()))


def critical_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("risk_score") >= CRITICAL_RISK)


def critical_transformers(df: DataFrame) -> DataFrame:
    measures = [
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_voltage_kv", "voltage_kv"),
        avg("avg_power_factor", "power_factor"),
        avg("avg_risk_score", "risk_score"),
        peak("max_risk_score", "risk_score"),
        distinct("distinct_anomaly_types", "anomaly_type"),
        total("total_faults", "fault_indicator"),
    ]
    grouped = rollup(critical_rows(df), TRANSFORMER_KEYS, measures)
    return round_columns(grouped, 2).orderBy(F.desc("max_risk_score"), "transformer_id")


def gold_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All eight tables, each as its own plan over the silver rows."""
    makers = [
        transformer_summary, substation_summary, region_summary, hourly_summary, daily_summary,
        anomaly_summary, severity_summary, critical_transformers,
    ]
    return {name: make(df) for name, make in zip(GOLD_TABLES, makers)}


GRAIN_KEYS = TRANSFORMER_KEYS + ["anomaly_type", "status"]


def gold_grain(df: DataFrame) -> DataFrame:
    """Partial sums per transformer, anomaly type and status: five gold tables in one pass.

    Written once, it replaces four further passes over the silver rows; it has at most a
    few dozen rows per transformer.
    """
    measures = {
        m.alias: m
        for m in transformer_measures() + [_dominant_measure()] + region_measures() + anomaly_measures()
        + severity_measures()
    }
    return partials(df, GRAIN_KEYS, list(measures.values()))


def tables_from_grain(grain: DataFrame) -> dict[str, DataFrame]:
    abnormal = grain.filter(F.col("status") != NORMAL)
    transformers = combine(grain, TRANSFORMER_KEYS, transformer_measures() + [_dominant_measure()])
    return {
        "transformer_summary": _band_transformers(transformers, 2),
        "substation_summary": round_columns(combine(grain, SUBSTATION_KEYS, substation_measures()), 2).orderBy(
            *SUBSTATION_KEYS
        ),
        "region_summary": round_columns(combine(grain, ["region"], region_measures()), 2).orderBy("region"),
        "anomaly_summary": _order_anomalies(combine(abnormal, ["anomaly_type", "status"], anomaly_measures())),
        "severity_summary": _order_severity(combine(grain, ["status"], severity_measures())),
    }
