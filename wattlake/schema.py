"""Telemetry data model: schemas, enumerations and nominal values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
STATUSES = ["Normal", "Low", "Warning", "High Risk", "Critical"]
SEVERITY_ORDER = ["Critical", "High Risk", "Warning", "Low", "Normal"]
ANOMALY_TYPES = [
    "Voltage Fluctuation",
    "Overload",
    "Temperature Spike",
    "Frequency Deviation",
    "Power Factor Anomaly",
    "Transformer Fault",
    "Communication Failure",
    "Unexpected Consumption",
    "Generation Drop",
    "Compound Anomaly",
]
NORMAL = "Normal"
NOMINAL_VOLTAGE_KV = 40.0
NOMINAL_FREQUENCY_HZ = 50.0

IMPUTED_COLUMNS = [
    "voltage_kv", "current_amp", "power_mw", "frequency_hz", "load_percent", "power_factor",
    "temperature_c", "energy_generated_mwh", "energy_consumed_mwh", "outage_duration_min",
    "communication_latency_ms", "anomaly_score",
]
CLIP_PROFILES = {
    "default": {
        "voltage_kv": (28.0, 52.0), "frequency_hz": (49.2, 50.8), "load_percent": (0.0, 100.0),
        "power_factor": (0.5, 1.0), "temperature_c": (30.0, 90.0),
    },
    "strict": {
        "voltage_kv": (35.0, 45.0), "frequency_hz": (49.5, 50.5), "load_percent": (0.0, 100.0),
        "power_factor": (0.6, 1.0), "temperature_c": (35.0, 85.0),
    },
}
ZSCORE_COLUMNS = ["load_percent", "temperature_c", "power_mw"]
FEATURE_COLUMNS = [
    "load_percent", "temperature_c", "voltage_kv", "frequency_hz", "power_factor", "power_mw",
    "energy_consumed_mwh", "communication_latency_ms",
]
# --- end of fixed values ------------------------------------------------------------

TRANSFORMER_KEYS = ["transformer_id", "substation_id", "region"]
SUBSTATION_KEYS = ["substation_id", "region"]


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _I, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

_READING_FIELDS = [
    ("event_id", _S), ("timestamp", _TS), ("region", _S), ("substation_id", _S), ("transformer_id", _S),
    ("latitude", _D), ("longitude", _D), ("voltage_kv", _D), ("current_amp", _D), ("power_mw", _D),
    ("frequency_hz", _D), ("load_percent", _D), ("power_factor", _D), ("temperature_c", _D),
    ("energy_generated_mwh", _D), ("energy_consumed_mwh", _D), ("outage_duration_min", _D),
    ("communication_latency_ms", _D), ("fault_indicator", _I), ("anomaly_score", _D), ("risk_score", _I),
    ("status", _S), ("anomaly_type", _S),
]
_BATCH_ONLY = {"energy_generated_mwh", "outage_duration_min", "communication_latency_ms"}

#: one sensor reading, timestamp parsed
TELEMETRY_SCHEMA = _struct(_READING_FIELDS)
#: the same reading as it stands in a CSV file
RAW_SCHEMA = _struct([(n, _S if n == "timestamp" else t) for n, t in _READING_FIELDS])
#: one JSON line of the event stream
STREAM_SCHEMA = _struct(
    [(n, _S if n == "timestamp" else t) for n, t in _READING_FIELDS if n not in _BATCH_ONLY]
)
TELEMETRY_COLUMNS = TELEMETRY_SCHEMA.fieldNames()
STREAM_COLUMNS = STREAM_SCHEMA.fieldNames()

#: the silver table; ``event_date`` is its partition column
SILVER_SCHEMA = T.StructType(
    TELEMETRY_SCHEMA.fields
    + _struct(
        [(n, _D) for n in (
            "voltage_deviation_kv", "frequency_deviation_hz", "power_quality_score", "voltage_stability_score",
            "calculated_power_mw", "transmission_efficiency", "load_percent_zscore", "temperature_c_zscore",
            "power_mw_zscore",
        )]
        + [("anomaly_flag", _I), ("transformation_time", T.TimestampType()), ("silver_version", _S)]
    ).fields
)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()
PARTITION_COLUMN = "event_date"
