"""Bands, buckets and tiers: one ``CASE`` per rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: lower bound -> label ---------------------------------------------
RISK_BANDS = [(85, "Critical"), (70, "High Risk"), (50, "Warning"), (30, "Low")]
FOUR_BANDS = [(85, "Critical"), (70, "High Risk"), (50, "Warning")]
GRID_HEALTH_BANDS = [(80, "Excellent"), (65, "Healthy"), (50, "Warning")]
STATUS_PRIORITY = {"Critical": 4, "High Risk": 3, "Warning": 2, "Low": 1, "Normal": 0}
SEVERITY_RANK = {"Critical": 1, "High Risk": 2, "Warning": 3, "Low": 4, "Normal": 5}
LOAD_BUCKETS = [(30, "low"), (60, "medium"), (85, "high")]
TEMPERATURE_BUCKETS = [(50, "normal"), (60, "elevated"), (70, "high")]
HEALTH_TIERS = [(80, "success"), (60, "warning"), (40, "high_risk")]
LOAD_TIERS = [(85, "critical"), (70, "high_risk"), (50, "warning")]
TEMPERATURE_TIERS = [(70, "critical"), (60, "high_risk"), (50, "warning")]
RISK_TIERS = [(85, "critical"), (70, "high_risk"), (50, "warning"), (30, "warning")]
# --- end of fixed values --------------------------------------------------------------


def _at_least(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for bound, label in reversed(steps):
        out = F.when(value >= bound, label).otherwise(out)
    return out


def _below(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    out = F.when(value >= steps[-1][0], otherwise)
    for bound, label in reversed(steps):
        out = F.when(value < bound, label).otherwise(out)
    return out


def risk_band(score: Column) -> Column:
    return _at_least(score, RISK_BANDS, "Normal")


def four_band(score: Column) -> Column:
    """As ``risk_band`` without the Low band."""
    return _at_least(score, FOUR_BANDS, "Normal")


def map_status(max_risk: Column, avg_load: Column) -> Column:
    return (
        F.when(max_risk >= 85, "Critical")
        .when((max_risk >= 70) | (avg_load >= 80), "High Load")
        .otherwise("Normal")
    )


def health_band(score: Column) -> Column:
    """Right-closed intervals with an open zero: exactly 0 has no label."""
    return (
        F.when((score > 0) & (score <= 40), "Critical")
        .when((score > 40) & (score <= 60), "Poor")
        .when((score > 60) & (score <= 80), "Fair")
        .when((score > 80) & (score <= 100), "Good")
    )


def grid_health_label(score: Column) -> Column:
    return _at_least(score, GRID_HEALTH_BANDS, "Critical")


def load_bucket(load: Column) -> Column:
    return _below(load, LOAD_BUCKETS, "critical")


def temperature_bucket(temperature: Column) -> Column:
    return _below(temperature, TEMPERATURE_BUCKETS, "critical")


def health_tier(percent: Column) -> Column:
    return _at_least(percent, HEALTH_TIERS, "critical")


def load_tier(load: Column) -> Column:
    return _at_least(load, LOAD_TIERS, "success")


def temperature_tier(temperature: Column) -> Column:
    return _at_least(temperature, TEMPERATURE_TIERS, "success")


def risk_tier(score: Column) -> Column:
    return _at_least(score, RISK_TIERS, "success")


def power_factor_tier(pf: Column) -> Column:
    return F.when(pf < 0.7, "critical").when(pf < 0.8, "warning").otherwise("success")


def _lookup(status: Column, table: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, rank in table.items():
        out = F.when(status == name, rank).otherwise(out)
    return out


def status_priority(status: Column) -> Column:
    """Critical 4 down to Normal 0; anything else 0."""
    return _lookup(status, STATUS_PRIORITY, 0)


def status_of_priority(priority: Column) -> Column:
    out = F.lit("Normal")
    for name, rank in STATUS_PRIORITY.items():
        out = F.when(priority == rank, name).otherwise(out)
    return out


def severity_rank(status: Column) -> Column:
    """Sort key, Critical first; unknown statuses rank with Normal."""
    return _lookup(status, SEVERITY_RANK, 5)
