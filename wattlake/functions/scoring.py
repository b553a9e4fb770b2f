"""Risk and anomaly scores as column expressions over the reading's own columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.rounding import round_half_even
from wattlake.schema import NOMINAL_FREQUENCY_HZ, NOMINAL_VOLTAGE_KV

# --- fixed values: (bound, points), highest first -------------------------------------
LOAD_POINTS = [(90, 20), (80, 15), (70, 10), (60, 5)]
TEMPERATURE_POINTS = [(75, 20), (70, 15), (65, 10), (60, 5)]
VOLTAGE_POINTS = [(4, 15), (3, 12), (2, 8), (1, 4)]
FREQUENCY_POINTS = [(0.3, 10), (0.2, 7), (0.15, 5), (0.1, 2)]
POWER_FACTOR_POINTS = [(0.7, 10), (0.75, 7), (0.8, 5), (0.85, 2)]
ANOMALY_POINTS = [(0.7, 5), (0.5, 3), (0.3, 1)]
LATENCY_POINTS = [(50, 5), (30, 3), (15, 1)]
FAULT_POINTS = 15
LIVE_LOAD_POINTS = [(90, 20), (80, 15), (70, 10)]
LIVE_TEMPERATURE_POINTS = [(75, 20), (70, 15), (65, 10)]
LIVE_VOLTAGE_POINTS = [(4, 15), (3, 12)]
# --- end of fixed values ----------------------------------------------------------------

COMPONENTS = [
    "load_risk_score", "temperature_risk_score", "voltage_risk_score", "frequency_risk_score",
    "power_factor_risk_score", "fault_risk_score", "anomaly_risk_score", "communication_risk_score",
]


def _above(value: Column, points: list[tuple[float, int]]) -> Column:
    out = F.lit(0)
    for bound, score in reversed(points):
        out = F.when(value > bound, score).otherwise(out)
    return out


def _under(value: Column, points: list[tuple[float, int]]) -> Column:
    out = F.lit(0)
    for bound, score in reversed(points):
        out = F.when(value < bound, score).otherwise(out)
    return out


def voltage_offset(voltage: Column) -> Column:
    """Distance from nominal voltage, free of binary noise so 44.0 kV is exactly 4 away."""
    return F.abs(round_half_even(voltage - F.lit(NOMINAL_VOLTAGE_KV), 6))


def frequency_offset(frequency: Column) -> Column:
    return F.abs(round_half_even(frequency - F.lit(NOMINAL_FREQUENCY_HZ), 6))


def positive_part(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def load_points(load: Column) -> Column:
    return _above(load, LOAD_POINTS)


def temperature_points(temperature: Column) -> Column:
    return _above(temperature, TEMPERATURE_POINTS)


def voltage_points(deviation: Column) -> Column:
    return _above(deviation, VOLTAGE_POINTS)


def frequency_points(deviation: Column) -> Column:
    return _above(deviation, FREQUENCY_POINTS)


def power_factor_points(pf: Column) -> Column:
    return _under(pf, POWER_FACTOR_POINTS)


def fault_points(fault: Column) -> Column:
    return F.when(fault == 1, FAULT_POINTS).otherwise(0)


def anomaly_points(score: Column) -> Column:
    return _above(score, ANOMALY_POINTS)


def latency_points(latency: Column) -> Column:
    return _above(latency, LATENCY_POINTS)


def risk_components(columns: list[str], signed: bool = False) -> dict[str, Column]:
    """The eight components of the rule score.

    Deviations are taken without sign unless ``signed`` asks for the stored signed
    columns, where an under-voltage scores nothing.
    """
    if signed and "voltage_deviation_kv" in columns:
        dv = F.col("voltage_deviation_kv")
    else:
        dv = voltage_offset(F.col("voltage_kv"))
    if signed and "frequency_deviation_hz" in columns:
        df = F.col("frequency_deviation_hz")
    else:
        df = frequency_offset(F.col("frequency_hz"))
    anomaly = F.col("anomaly_score") if "anomaly_score" in columns else F.lit(0.0)
    values = [
        load_points(F.col("load_percent")),
        temperature_points(F.col("temperature_c")),
        voltage_points(dv),
        frequency_points(df),
        power_factor_points(F.col("power_factor")),
        fault_points(F.col("fault_indicator")),
        anomaly_points(anomaly),
        latency_points(F.col("communication_latency_ms")),
    ]
    return dict(zip(COMPONENTS, values))


def with_rule_risk(df: DataFrame, signed: bool = False) -> DataFrame:
    """Add the eight component columns and replace ``risk_score`` by their sum (0-100)."""
    total = sum((F.col(c) for c in COMPONENTS[1:]), F.col(COMPONENTS[0]))
    return df.withColumns(risk_components(df.columns, signed)).withColumn(
        "risk_score", F.least(F.greatest(total, F.lit(0)), F.lit(100)).cast("int")
    )


def composite_risk(load: Column, temperature: Column, voltage: Column, frequency: Column, fault: Column) -> Column:
    """Continuous risk 0-100; the random parts take their expected values."""
    raw = (
        F.lit(0.75) * positive_part(load - 20.0)
        + F.lit(0.35) * positive_part(temperature - 32.0)
        + F.least(F.lit(18.0), F.lit(5.5) * voltage_offset(voltage))
        + F.least(F.lit(15.0), F.lit(25.0) * frequency_offset(frequency))
        + F.when(fault == 1, 11.0).otherwise(0.0)
    )
    return F.least(F.floor(raw + F.lit(0.5)), F.lit(100)).cast("int")


def measurement_anomaly_score(
    load: Column, temperature: Column, voltage: Column, frequency: Column, pf: Column, fault: Column
) -> Column:
    """Anomaly score 0-1 from the measured values, four digits."""
    raw = (
        F.lit(0.25) * (positive_part(load - 70.0) / 30.0)
        + F.lit(0.25) * (positive_part(temperature - 55.0) / 30.0)
        + F.lit(0.2) * (voltage_offset(voltage) / 5.0)
        + F.lit(0.1) * (frequency_offset(frequency) / 0.5)
        + F.lit(0.1) * (positive_part(F.lit(0.9) - pf) / 0.3)
        + F.when(fault == 1, 0.2).otherwise(0.0)
    )
    return round_half_even(F.least(raw, F.lit(1.0)), 4)


def stream_risk(anomaly: Column, load: Column, temperature: Column, fault: Column) -> Column:
    """Score of an arriving event, two digits; missing inputs count as zero."""
    a, l, t = (F.coalesce(c, F.lit(0.0)) for c in (anomaly, load, temperature))
    raw = (
        a * 40.0
        + positive_part(l - 70.0) * 0.3
        + positive_part(t - 55.0) * 0.2
        + F.when(F.coalesce(fault, F.lit(0)) == 1, 25.0).otherwise(0.0)
    )
    return round_half_even(F.least(raw, F.lit(100.0)), 2)


def live_risk(load: Column, temperature: Column, voltage: Column, fault: Column) -> Column:
    points = (
        _above(load, LIVE_LOAD_POINTS)
        + _above(temperature, LIVE_TEMPERATURE_POINTS)
        + _above(voltage_offset(voltage), LIVE_VOLTAGE_POINTS)
        + fault_points(fault)
    )
    return F.least(points, F.lit(100)).cast("int")
