"""Health and risk tables."""

from __future__ import annotations

from catalog.base import band, on_silver, register, rs
from catalog.gold import FAULTS, TK
from wattlake.operators import health, risk, trends

FOUR = ("CASE WHEN {0} >= 85 THEN 'Critical' WHEN {0} >= 70 THEN 'High Risk' WHEN {0} >= 50 THEN 'Warning' "
        "ELSE 'Normal' END").format("max(risk_score)")


def four(pairs: dict[str, str]) -> str:
    return ", ".join(f"{rs(e, 4)} AS {a}" for a, e in pairs.items())


def _count(alias: str, where: str) -> str:
    return f"count(*) FILTER ({where}) AS {alias}"


_STATUSES4 = ", ".join(_count(f"{s.lower().replace(' ', '_')}_count", f"status = '{s}'")
                       for s in ("Normal", "Warning", "High Risk", "Critical"))
_LAST = """lt AS (SELECT max("timestamp") AS latest FROM silver),
now AS (SELECT * FROM silver, lt WHERE "timestamp" >= latest - INTERVAL 24 HOUR),
old AS (SELECT * FROM silver, lt WHERE "timestamp" < latest - INTERVAL 24 HOUR AND "timestamp" >= latest - INTERVAL 72 HOUR)"""


def _diff(c: str) -> str:
    return f"coalesce((SELECT avg({c}) FROM now) - (SELECT avg({c}) FROM old), 0)"


_TRENDS = {"load_trend": _diff("load_percent"), "temp_trend": _diff("temperature_c"), "risk_trend": _diff("risk_score")}
register("w05_day_over_previous", on_silver(f"SELECT {four(_TRENDS)}", _LAST), digits=4)(trends.day_over_previous)


def _spread(prefix: str, expr_by_name: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER ({v}) AS {prefix}_{k}" for k, v in expr_by_name.items())


_NESTED = ("status_distribution", "load_distribution", "temperature_distribution")


def spread_metrics(metrics):
    """The metrics with their nested counts spread into columns."""
    plain = [c for c in metrics.columns if c not in _NESTED]
    spread = [metrics[n][f].alias(f"{n.split('_')[0]}_{f}") for n in _NESTED for f in metrics.schema[n].dataType.names]
    return metrics.select(*plain, *spread)


register("a19_grid_health_metrics", on_silver(f"""SELECT count(*) AS total_records,
    count(DISTINCT transformer_id) AS total_transformers, count(DISTINCT substation_id) AS total_substations,
    count(DISTINCT region) AS total_regions,
    {_spread('status', {s.lower().replace(' ', '_'): f"status = '{s}'"
                        for s in ('Normal', 'Low', 'Warning', 'High Risk', 'Critical')})}, {FAULTS} AS total_faults, CAST(sum(anomaly_flag) AS BIGINT) AS anomaly_count,
    {four({
        'health_percentage': "count(*) FILTER (status = 'Normal') / count(*) * 100",
        'fault_rate': 'sum(fault_indicator) / count(*) * 100', 'anomaly_rate': 'sum(anomaly_flag) / count(*) * 100',
        'avg_load_percent': 'avg(load_percent)', 'avg_temperature_c': 'avg(temperature_c)',
        'avg_voltage_kv': 'avg(voltage_kv)', 'avg_power_factor': 'avg(power_factor)',
        'avg_risk_score': 'avg(risk_score)', 'avg_anomaly_score': 'avg(anomaly_score)',
        'max_load_percent': 'max(load_percent)', 'max_temperature_c': 'max(temperature_c)',
        'total_energy_generated_mwh': 'sum(energy_generated_mwh)',
        'total_energy_consumed_mwh': 'sum(energy_consumed_mwh)', 'avg_efficiency': 'avg(transmission_efficiency)',
        'avg_latency_ms': 'avg(communication_latency_ms)', 'max_latency_ms': 'max(communication_latency_ms)',
        **_TRENDS})}, max(risk_score) AS max_risk_score,
    {_spread('load', {'low': 'load_percent < 30', 'medium': 'load_percent >= 30 AND load_percent < 60',
              'high': 'load_percent >= 60 AND load_percent < 85', 'critical': 'load_percent >= 85'})},
    {_spread('temperature', {'normal': 'temperature_c < 50', 'elevated': 'temperature_c >= 50 AND temperature_c < 60',
              'high': 'temperature_c >= 60 AND temperature_c < 70', 'critical': 'temperature_c >= 70'})}, max("timestamp") AS latest_timestamp, min("timestamp") AS time_range_start
    FROM silver""", _LAST), digits=4)(
    lambda df: spread_metrics(health.grid_health_metrics(df)))

_TH = {
    "avg_load_percent": "avg(load_percent)", "max_load_percent": "max(load_percent)", "min_load_percent": "min(load_percent)",
    "load_std": "coalesce(stddev_samp(load_percent), 0)", "avg_temperature_c": "avg(temperature_c)",
    "max_temperature_c": "max(temperature_c)", "temp_std": "coalesce(stddev_samp(temperature_c), 0)",
    "avg_voltage_kv": "avg(voltage_kv)", "voltage_std": "coalesce(stddev_samp(voltage_kv), 0)",
    "min_voltage_kv": "min(voltage_kv)", "max_voltage_kv": "max(voltage_kv)", "avg_frequency_hz": "avg(frequency_hz)",
    "freq_std": "coalesce(stddev_samp(frequency_hz), 0)", "avg_power_factor": "avg(power_factor)",
    "min_power_factor": "min(power_factor)", "avg_power_mw": "avg(power_mw)",
    "total_energy_generated": "sum(energy_generated_mwh)", "total_energy_consumed": "sum(energy_consumed_mwh)",
    "avg_risk_score": "avg(risk_score)", "risk_std": "coalesce(stddev_samp(risk_score), 0)",
    "avg_anomaly_score": "avg(anomaly_score)", "max_anomaly_score": "max(anomaly_score)",
    "avg_latency_ms": "avg(communication_latency_ms)", "max_latency_ms": "max(communication_latency_ms)",
}
_HEALTH_CTES = f"""th AS (SELECT {TK}, count(*) AS record_count, {', '.join(f'{e} AS {a}' for a, e in _TH.items())},
    max(risk_score) AS max_risk_score, count(*) FILTER (risk_score > 50) AS anomaly_count, {FAULTS} AS fault_count,
    {_STATUSES4}, count(DISTINCT CASE WHEN anomaly_type <> 'Normal' THEN anomaly_type END) AS distinct_anomaly_types,
    max("timestamp") AS last_seen, min("timestamp") AS first_seen FROM silver GROUP BY {TK}),
tops AS (SELECT max(fault_count) AS mf, max(voltage_std) AS mv, max(freq_std) AS mq FROM th),
parts AS (SELECT th.*, CASE WHEN mf > 0 THEN 25 * (1 - fault_count / mf) ELSE 25 END AS reliability_score,
    (CASE WHEN mv > 0 THEN 25 * (1 - voltage_std / mv) ELSE 0 END
      + CASE WHEN mq > 0 THEN 25 * (1 - freq_std / mq) ELSE 0 END) / 2 AS stability_score,
    least(25, greatest(0, 25 * (avg_power_factor - 7e-1) / 3e-1)) AS efficiency_score,
    (25 * (1 - max_temperature_c / 85e0) + 25 * (1 - max_risk_score / 100e0)) / 2 AS safety_score FROM th, tops),
scored AS (SELECT *, least(100, greatest(0, reliability_score + stability_score + efficiency_score + safety_score))
    AS health_score FROM parts)"""
_HB = ("CASE WHEN health_score > 0 AND health_score <= 40 THEN 'Critical' WHEN health_score > 40 AND health_score <= 60 "
       "THEN 'Poor' WHEN health_score > 60 AND health_score <= 80 THEN 'Fair' WHEN health_score > 80 AND "
       "health_score <= 100 THEN 'Good' END")
_SCORES = ["reliability_score", "stability_score", "efficiency_score", "safety_score", "health_score"]
_HEALTH_CTES = _HEALTH_CTES.replace("scored AS", "health_rows AS")
register("a20_transformer_health", on_silver(
    f"SELECT * REPLACE ({', '.join(f'{rs(c, 4)} AS {c}' for c in list(_TH) + _SCORES)}), {_HB} AS health_status "
    "FROM health_rows", _HEALTH_CTES), digits=4)(health.transformer_health)
register("t07_health_extremes", on_silver(
    ctes=_HEALTH_CTES + ",\np AS (SELECT transformer_id, " + four({c: c for c in ("health_score", "avg_load_percent", "avg_temperature_c")})
    + ", fault_count, health_score AS hs FROM health_rows)", sql="SELECT * EXCLUDE (hs), 'healthiest' AS extreme FROM "
    "(SELECT * FROM p ORDER BY hs DESC, transformer_id LIMIT 5) UNION ALL SELECT * EXCLUDE (hs), 'most stressed' FROM "
    "(SELECT * FROM p ORDER BY hs, transformer_id DESC LIMIT 5)"), digits=4)(health.health_extremes)
register("a20_health_score_distribution", on_silver(
    "SELECT CASE WHEN health_score >= 80 THEN 'Good' WHEN health_score >= 60 THEN 'Fair' WHEN health_score >= 40 "
    "THEN 'Poor' ELSE 'Critical' END AS health_range, count(*) AS transformers FROM health_rows GROUP BY 1",
    _HEALTH_CTES))(health.health_score_distribution)

_PLACE = four({"avg_load_percent": "avg(load_percent)", "max_load_percent": "max(load_percent)",
              "avg_temperature_c": "avg(temperature_c)", "max_temperature_c": "max(temperature_c)",
              "avg_voltage_kv": "avg(voltage_kv)", "avg_power_factor": "avg(power_factor)",
              "avg_risk_score": "avg(risk_score)"})
register("a21_substation_health", on_silver(f"""SELECT substation_id, region,
    count(DISTINCT transformer_id) AS transformer_count, count(*) AS record_count, {_PLACE},
    max(risk_score) AS max_risk_score, {FAULTS} AS fault_count, count(*) FILTER (risk_score > 50) AS anomaly_count,
    {_STATUSES4}, {four({'total_energy_generated': 'sum(energy_generated_mwh)',
                        'total_energy_consumed': 'sum(energy_consumed_mwh)'})}, {FOUR} AS health_status
    FROM silver GROUP BY 1, 2"""), digits=4)(health.substation_health)
register("a22_region_health", on_silver(f"""SELECT region, count(DISTINCT substation_id) AS substation_count,
    count(DISTINCT transformer_id) AS transformer_count, count(*) AS record_count, {_PLACE},
    max(risk_score) AS max_risk_score, {FAULTS} AS total_faults, count(*) FILTER (risk_score > 50) AS anomaly_count,
    {_STATUSES4}, {four({'total_generation': 'sum(energy_generated_mwh)', 'total_consumption': 'sum(energy_consumed_mwh)',
                        'avg_efficiency': 'avg(transmission_efficiency)',
                        'health_percentage': "count(*) FILTER (status = 'Normal') / count(*) * 100"})},
    {FOUR} AS health_status FROM silver GROUP BY 1"""), digits=4)(health.region_health)

_WORST = f"{band('max(risk_score)')} AS worst_status"
register("a23_transformer_risk_summary", on_silver(f"""SELECT {TK}, {four({
    'avg_load_percent': 'avg(load_percent)', 'max_load_percent': 'max(load_percent)',
    'avg_temperature_c': 'avg(temperature_c)', 'max_temperature_c': 'max(temperature_c)',
    'avg_voltage_kv': 'avg(voltage_kv)', 'min_voltage_kv': 'min(voltage_kv)', 'avg_power_factor': 'avg(power_factor)',
    'avg_risk_score': 'avg(risk_score)', 'risk_score_std': 'coalesce(stddev_samp(risk_score), 0)',
    'avg_anomaly_score': 'avg(anomaly_score)', 'avg_latency_ms': 'avg(communication_latency_ms)'})},
    max(risk_score) AS max_risk_score, {FAULTS} AS fault_count, count(*) AS record_count, {_WORST}
    FROM silver GROUP BY {TK}"""), digits=4)(risk.transformer_risk_summary)
_RISK4 = four({"avg_load_percent": "avg(load_percent)", "max_load_percent": "max(load_percent)",
              "avg_temperature_c": "avg(temperature_c)", "avg_voltage_kv": "avg(voltage_kv)",
              "avg_power_factor": "avg(power_factor)", "avg_risk_score": "avg(risk_score)"})
register("a24_substation_risk_summary", on_silver(f"""SELECT substation_id, region, {_RISK4},
    max(risk_score) AS max_risk_score, {FAULTS} AS fault_count, CAST(sum(anomaly_flag) AS BIGINT) AS anomaly_count,
    count(DISTINCT transformer_id) AS transformer_count, count(*) AS record_count, {_WORST}
    FROM silver GROUP BY 1, 2"""), digits=4)(risk.substation_risk_summary)
register("a25_region_risk_summary", on_silver(f"""SELECT region, {_RISK4},
    max(risk_score) AS max_risk_score, {FAULTS} AS fault_count, count(*) FILTER (risk_score > 50) AS anomaly_count,
    count(DISTINCT transformer_id) AS transformer_count, count(DISTINCT substation_id) AS substation_count,
    count(*) AS record_count, {_WORST} FROM silver GROUP BY 1"""), digits=4)(risk.region_risk_summary)
_CRIT = (f"""SELECT {TK}, {four({'avg_load': 'avg(load_percent)', 'max_temp': 'max(temperature_c)',
                               'avg_voltage': 'avg(voltage_kv)', 'avg_risk': 'avg(risk_score)'})},
    max(risk_score) AS max_risk, {{types}} AS anomaly_types FROM silver WHERE risk_score >= 85 GROUP BY {TK}""")
register("a26_critical_with_types", on_silver(_CRIT.format(
    types="string_agg(DISTINCT anomaly_type, ', ' ORDER BY anomaly_type)")), digits=4)(risk.critical_with_types)
register("a26_critical_with_anomalies", on_silver(_CRIT.format(
    types="coalesce(string_agg(DISTINCT anomaly_type, ', ' ORDER BY anomaly_type) FILTER (anomaly_type <> 'Normal'), "
          "'Normal')")), digits=4)(lambda df: risk.critical_with_types(df, skip_normal=True))
register("a27_risk_distribution", on_silver(f"""SELECT l AS risk_level, count(b) AS records
    FROM (VALUES ('Normal'), ('Low'), ('Warning'), ('High Risk'), ('Critical')) t(l)
    LEFT JOIN (SELECT {band('risk_score')} AS b FROM silver) ON b = l GROUP BY l"""))(risk.risk_distribution)
register("a28_risk_statistics", on_silver(f"""SELECT {four({'mean_risk': 'avg(risk_score)',
    'median_risk': 'median(risk_score)', 'std_risk': 'stddev_samp(risk_score)'})}, min(risk_score) AS min_risk,
    max(risk_score) AS max_risk FROM silver"""), digits=4)(risk.risk_statistics)
register("t06_top_risk_records", on_silver(
    f"SELECT event_id, {TK}, load_percent, temperature_c, voltage_kv, risk_score, status FROM silver "
    "ORDER BY risk_score DESC, event_id LIMIT 10"))(risk.top_risk_records)
