"""What the monitoring service answers, over silver rows and a filter.

Averages stay unrounded here except where the answer is a headline number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.bands import grid_health_label, risk_band
from wattlake.functions.exact import exact_sum
from wattlake.functions.rounding import round_half_even, round_stable
from wattlake.operators import gold
from wattlake.operators.filters import FilterSpec, apply_service_filters, flagged_rows
from wattlake.operators.rollup import (
    Measure, avg, distinct, distinct_where, peak, rollup, rows, rows_where, total,
)
from wattlake.operators.trends import mark_recent, split_measures, trend_columns
from wattlake.schema import STATUSES, SUBSTATION_KEYS

ALL = FilterSpec()
ALERT_COLUMNS = [
    "event_id", "timestamp", "transformer_id", "substation_id", "region", "anomaly_type", "risk_score",
    "status", "voltage_kv", "temperature_c", "load_percent",
]


def regions(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    return rollup(apply_service_filters(df, spec), ["region"], gold.region_measures()).orderBy("region")


def transformers(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    """As the gold table, but banded on the unrounded averages."""
    return gold.transformer_rollup(apply_service_filters(df, spec), digits=None)


def anomalies(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    flagged = apply_service_filters(flagged_rows(df), spec)
    return rollup(flagged, ["anomaly_type", "status"], gold.anomaly_measures()).orderBy(
        F.desc("anomaly_count"), "anomaly_type", "status"
    )


def substations(df: DataFrame, region: str | None = None) -> DataFrame:
    measures = [
        total("total_power_mw", "power_mw"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_risk_score", "risk_score"),
        peak("max_risk_score", "risk_score"),
        total("total_faults", "fault_indicator"),
        distinct("transformer_count", "transformer_id"),
        avg("avg_energy_generated", "energy_generated_mwh"),
        avg("avg_energy_consumed", "energy_consumed_mwh"),
    ]
    grouped = rollup(apply_service_filters(df, FilterSpec(region=region)), SUBSTATION_KEYS, measures)
    return grouped.withColumn("status", risk_band(F.col("max_risk_score"))).orderBy(*SUBSTATION_KEYS)


def energy_by_hour(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    rows_ = apply_service_filters(df, spec).withColumn("hour_of_day", F.hour("timestamp"))
    return rollup(rows_, ["hour_of_day"], gold.hourly_measures()).orderBy("hour_of_day")


def energy_totals(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    """Generated and consumed energy of the filtered rows, one digit, 0 when there are none."""
    summed = apply_service_filters(df, spec).agg(
        exact_sum(F.col("energy_generated_mwh")).alias("g"), exact_sum(F.col("energy_consumed_mwh")).alias("c")
    )
    return summed.select(
        round_stable(F.coalesce("g", F.lit(0.0)), 1).alias("total_generated"),
        round_stable(F.coalesce("c", F.lit(0.0)), 1).alias("total_consumed"),
    )


def risk(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    """Rows per status (zeros kept), average and highest risk."""
    facts = apply_service_filters(df, spec).agg(
        *[F.count_if(F.col("status") == s).alias(s.lower().replace(" ", "_") + "_count") for s in STATUSES],
        F.avg("risk_score").alias("avg"),
        F.max("risk_score").alias("max"),
    )
    return facts.select(
        *[s.lower().replace(" ", "_") + "_count" for s in STATUSES],
        round_stable(F.coalesce("avg", F.lit(0.0)), 1).alias("avg_risk_score"),
        F.coalesce("max", F.lit(0)).alias("max_risk_score"),
    )


def alerts(df: DataFrame, spec: FilterSpec = ALL, n: int = 20) -> DataFrame:
    """The ``n`` riskiest flagged rows, newest first among equals."""
    flagged = apply_service_filters(flagged_rows(df), spec)
    top = flagged.orderBy(F.desc("risk_score"), F.desc("timestamp"), "event_id").limit(n)
    rounded = {c: round_half_even(F.col(c), 2) for c in ("voltage_kv", "temperature_c", "load_percent")}
    return top.select(*ALERT_COLUMNS).withColumns(rounded)


def transformer_counts(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    """Distinct transformers: all, with any non-critical row, with any row at risk 85 or more."""
    return rollup(apply_service_filters(df, spec), [], _transformer_count_measures())


def _transformer_count_measures() -> list[Measure]:
    return [
        distinct("total_transformers", "transformer_id"),
        distinct_where("active_transformers", "transformer_id", F.col("status") != "Critical"),
        distinct_where("critical_transformers", "transformer_id", F.col("risk_score") >= gold.CRITICAL_RISK),
    ]


def _health_measures() -> list[Measure]:
    status = F.col("status")
    return _transformer_count_measures() + [
        rows("n"),
        *[rows_where(f"{s.lower().replace(' ', '_')}_count", status == s) for s in STATUSES],
        avg("mean_dv", "voltage_deviation_kv"),
        avg("mean_df", "frequency_deviation_hz"),
        rows_where("overloads", F.col("load_percent") > 90),
        rows_where("hot", F.col("temperature_c") > 70),
        rows_where("late", F.col("communication_latency_ms") > 50),
    ]


def _health_expressions() -> dict[str, Column]:
    """Health score parts from the one-row aggregate of ``_health_measures``."""
    n = F.col("n")

    def rate(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c).cast("double"), n), F.lit(0.0))

    def floor0(c: Column) -> Column:
        return F.greatest(F.lit(0.0), c)

    voltage = floor0(F.lit(1.0) - F.abs("mean_dv") / 5.0)
    frequency = floor0(F.lit(1.0) - F.abs("mean_df") / 0.5)
    score = (
        rate("normal_count") * 30.0
        + (F.lit(1.0) - rate("critical_count")) * 20.0
        + (F.lit(1.0) - rate("warning_count")) * 10.0
        + voltage * 12.0
        + frequency * 10.0
        + floor0(F.lit(1.0) - rate("overloads") * 5.0) * 8.0
        + floor0(F.lit(1.0) - rate("hot") * 5.0) * 5.0
        + floor0(F.lit(1.0) - rate("late") * 10.0) * 5.0
    )
    empty = n == 0
    raw_score = F.when(empty, 50.0).otherwise(F.least(F.lit(100.0), floor0(score)))

    def unless_empty(c: Column) -> Column:
        return F.when(empty, 0.0).otherwise(c)

    return {
        "health_score": round_stable(raw_score, 1),
        "status": F.when(empty, "Unknown").otherwise(grid_health_label(raw_score)),
        "avg_voltage_stability": unless_empty(round_stable(voltage * 100.0, 1)),
        "avg_frequency_stability": unless_empty(round_stable(frequency * 100.0, 1)),
        "overload_rate": round_stable(rate("overloads") * 100.0, 2),
        "communication_failure_rate": round_stable(rate("late") * 100.0, 2),
    }


def grid_health(df: DataFrame, spec: FilterSpec = ALL) -> DataFrame:
    """One row: weighted health score 0-100, its label, counts and rates."""
    facts = rollup(apply_service_filters(df, spec), [], _health_measures())
    parts = _health_expressions()
    counts = ["normal_count", "warning_count", "high_risk_count", "critical_count", "low_count"]
    return facts.select(
        parts["health_score"].alias("health_score"), parts["status"].alias("status"),
        "total_transformers", "active_transformers", "critical_transformers", *counts,
        *[parts[c].alias(c) for c in ("avg_voltage_stability", "avg_frequency_stability", "overload_rate",
                                      "communication_failure_rate")],
    )


def summary(df: DataFrame, spec: FilterSpec = FilterSpec(time_range="24h")) -> DataFrame:
    """One row of headline numbers: values and trends from one aggregation of the marked rows."""
    filtered = apply_service_filters(df, spec)
    measures = _health_measures() + [
        total("generation", "energy_generated_mwh"),
        total("consumption", "energy_consumed_mwh"),
        avg("load", "load_percent"),
        total("faults", "fault_indicator"),
        total("flags", "anomaly_flag"),
    ]
    facts = rollup(mark_recent(filtered), [], measures + split_measures())
    change = trend_columns()

    def or_zero(c: str, zero=0.0) -> Column:
        return F.coalesce(F.col(c), F.lit(zero))

    return facts.select(
        round_stable(or_zero("generation"), 1).alias("total_generation_mw"),
        round_stable(or_zero("consumption"), 1).alias("total_consumption_mw"),
        round_stable(or_zero("load"), 1).alias("grid_load_percent"),
        "active_transformers", "total_transformers",
        or_zero("faults", 0).alias("faults_detected"),
        or_zero("flags", 0).alias("anomalies_detected"),
        "critical_transformers",
        _health_expressions()["health_score"].alias("grid_health_score"),
        *[c.alias(k) for k, c in change.items()],
        F.col("n").alias("records_today"),
    )
