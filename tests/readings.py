"""Data folder and plausible readings for the tests."""

from datetime import datetime, timedelta

from wattlake.schema import TELEMETRY_SCHEMA

SF = "/root/testdata/sf0.001"
START = datetime(2025, 4, 1)


def reading(i=0, **changes):
    """One plausible reading; any column can be changed."""
    row = {
        "event_id": f"EVT-{i:06d}", "timestamp": START + timedelta(minutes=i), "region": "North",
        "substation_id": "SUB-001", "transformer_id": "TR-001001", "latitude": 28.6, "longitude": 77.2,
        "voltage_kv": 40.0, "current_amp": 50.0, "power_mw": 1.9, "frequency_hz": 50.0, "load_percent": 55.0,
        "power_factor": 0.95, "temperature_c": 43.0, "energy_generated_mwh": 10.0, "energy_consumed_mwh": 8.0,
        "outage_duration_min": 0.0, "communication_latency_ms": 5.0, "fault_indicator": 0, "anomaly_score": 0.1,
        "risk_score": 20, "status": "Normal", "anomaly_type": "Normal",
    }
    row.update(changes)
    return tuple(row[c] for c in TELEMETRY_SCHEMA.fieldNames())
