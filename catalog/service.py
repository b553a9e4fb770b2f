"""Service answers and the filters they take."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SPLIT_CTES, band, on_silver, register, rs, seconds, selection, silver
from catalog.gold import ANOMALY_SQL, FAULTS, HOURLY_SQL, transformer_full, TK
from wattlake.operators import filters, service, trends
from wattlake.operators.filters import FilterSpec

ASIA_30D = FilterSpec(region="ASIA", time_range="30d")
ASIA_30D_SQL = selection("region = 'ASIA'", 720)
KEY = 'event_id, "timestamp", risk_score, status'


def _key(df):
    return df.select("event_id", "timestamp", "risk_score", "status")


# --- filters --------------------------------------------------------------------------------
register("q01_equality_filters", on_silver(
    f"SELECT {KEY} FROM silver WHERE region = 'EUROPE' AND substation_id = 'SUB-023' AND status = 'Warning'"))(
    lambda df: _key(filters.apply_equality(df, FilterSpec("EUROPE", "SUB-023", "All", "Warning"))))
register("q01_no_filter", on_silver(f"SELECT {KEY} FROM silver"))(
    lambda df: _key(filters.apply_service_filters(df, FilterSpec("All", "", None))))
register("q02_anomaly_types", on_silver(
    f"SELECT {KEY} FROM silver WHERE anomaly_type IN ('Overload', 'Temperature Spike')"))(
    lambda df: _key(filters.apply_service_filters(df, FilterSpec(anomaly_type=" Overload ,,Temperature Spike"))))
for _level, _where in {
    "critical": "risk_score >= 85", "high_risk": "risk_score >= 70 AND risk_score < 85",
    "warning": "risk_score >= 50 AND risk_score < 70", "low": "risk_score >= 30 AND risk_score < 50",
    "normal": "risk_score < 30",
}.items():
    register(f"q03_risk_level_{_level}", on_silver(f"SELECT {KEY} FROM silver WHERE {_where}"))(
        lambda df, level=_level: _key(filters.apply_service_filters(df, FilterSpec(risk_level=level))))
for _range, _hours in {"6h": 6, "24h": 24, "7d": 168, "30d": 720, "unknown": 2160}.items():
    register(f"q04_service_range_{_range}", on_silver(
        f"SELECT {KEY} FROM sel", selection("region = 'AFRICA' AND risk_score >= 85", _hours)))(
        lambda df, r=_range: _key(filters.apply_service_filters(
            df, FilterSpec(region="AFRICA", risk_level="critical", time_range=r))))
for _range, _hours in {"Last 1 Hour": 1, "Last 12 Hours": 12, "Last 7 Days": 168, "All Time": None}.items():
    register("q05_dashboard_" + _range.lower().replace(" ", "_"), on_silver(
        f"SELECT {KEY} FROM sel", selection("region = 'AMERICA'", _hours)))(
        lambda df, r=_range: _key(filters.apply_dashboard_filters(df, FilterSpec(region="AMERICA", time_range=r))))

_OPTIONS = """SELECT 'region' AS filter, 0 AS position, 'All' AS option UNION ALL SELECT 'substation_id', 0, 'All'
    UNION ALL SELECT 'transformer_id', 0, 'All'
    UNION ALL SELECT DISTINCT 'region', 1, region FROM silver
    UNION ALL SELECT DISTINCT 'substation_id', 1, substation_id FROM silver WHERE {r}
    UNION ALL SELECT DISTINCT 'transformer_id', 1, transformer_id FROM silver WHERE {s}"""
register("q06_filter_options", on_silver(_OPTIONS.format(r="region = 'ASIA'", s="region = 'ASIA'")))(
    lambda df: filters.filter_options(df, FilterSpec(region="ASIA")))
register("q06_filter_options_substation", on_silver(
    _OPTIONS.format(r="TRUE", s="substation_id = 'SUB-012'")))(
    lambda df: filters.filter_options(df, FilterSpec(substation_id="SUB-012")))


def _check(df):
    specs = [FilterSpec(region="ASIA"), FilterSpec(region="Atlantis"), FilterSpec("ASIA", "SUB-000"),
             FilterSpec("AFRICA", "SUB-000"), FilterSpec("AFRICA", "SUB-000", "TR-999999")]
    out = None
    for i, spec in enumerate(specs):
        one = filters.check_consistency(df, spec).select(F.lit(i).alias("check_no"), "is_valid", "message")
        out = one if out is None else out.unionByName(one)
    return out


register("q07_filter_consistency", on_silver(ctes="""f AS (SELECT
      bool_or(region = 'ASIA') AS asia, bool_or(region = 'Atlantis') AS atlantis,
      bool_or(region = 'ASIA' AND substation_id = 'SUB-000') AS asia0,
      bool_or(region = 'AFRICA' AND substation_id = 'SUB-000') AS africa0,
      bool_or(substation_id = 'SUB-000' AND transformer_id = 'TR-999999') AS t9 FROM silver)""", sql="""
    SELECT 0 AS check_no, asia AS is_valid, CASE WHEN asia THEN 'Filters are valid'
      ELSE 'Region ''ASIA'' not found in data' END AS message FROM f
    UNION ALL SELECT 1, atlantis, CASE WHEN atlantis THEN 'Filters are valid'
      ELSE 'Region ''Atlantis'' not found in data' END FROM f
    UNION ALL SELECT 2, asia AND asia0, CASE WHEN asia0 THEN 'Filters are valid'
      ELSE 'Substation ''SUB-000'' not found in selected region' END FROM f
    UNION ALL SELECT 3, africa0, CASE WHEN africa0 THEN 'Filters are valid'
      ELSE 'Substation ''SUB-000'' not found in selected region' END FROM f
    UNION ALL SELECT 4, africa0 AND t9, CASE WHEN NOT africa0 THEN 'Substation ''SUB-000'' not found in selected region'
      WHEN NOT t9 THEN 'Transformer ''TR-999999'' not found in selected scope' ELSE 'Filters are valid' END FROM f"""
    ))(_check)
register("q08_search_transformers", on_silver(
    "SELECT event_id, transformer_id FROM silver WHERE lower(transformer_id) LIKE '%tr-00004%'"))(
    lambda df: filters.search_transformers(df, "Tr-00004").select("event_id", "transformer_id"))
register("q12_anomalous_subset", on_silver(f"SELECT {KEY} FROM silver WHERE status <> 'Normal'"))(
    lambda df: _key(filters.anomalous_rows(df)))
register("q12_flagged_subset", on_silver(f"SELECT {KEY} FROM silver WHERE anomaly_flag = 1"))(
    lambda df: _key(filters.flagged_rows(df)))

# --- answers --------------------------------------------------------------------------------
_R4 = {"total_power_mw": "sum(power_mw)", "avg_voltage_kv": "avg(voltage_kv)", "avg_load_percent": "avg(load_percent)",
       "avg_temperature_c": "avg(temperature_c)", "avg_power_factor": "avg(power_factor)",
       "total_energy_generated_mwh": "sum(energy_generated_mwh)",
       "total_energy_consumed_mwh": "sum(energy_consumed_mwh)", "avg_risk_score": "avg(risk_score)"}
_REGIONS = (f"SELECT region, {', '.join(rs(e, 4) + f' AS {a}' for a, e in _R4.items())}, {FAULTS} AS total_faults, "
            "count(DISTINCT transformer_id) AS transformer_count, count(DISTINCT substation_id) AS substation_count, "
            "max(risk_score) AS max_risk_score, count(*) AS record_count FROM {src} GROUP BY region")
register("a10_regions", on_silver(_REGIONS.format(src="silver")), digits=4)(service.regions)
register("a10_regions_critical_7d", on_silver(
    _REGIONS.format(src="sel"), selection("risk_score >= 85", 168)), digits=4)(
    lambda df: service.regions(df, FilterSpec(risk_level="critical", time_range="7d")))
register("a11_transformers", on_silver(transformer_full("silver", 4, "exact_risk")), digits=4)(service.transformers)
register("a11_transformers_asia_30d", on_silver(
    transformer_full("sel", 4, "exact_risk"), ASIA_30D_SQL), digits=4)(
    lambda df: service.transformers(df, ASIA_30D))
_ANOM4 = ("SELECT anomaly_type, status, count(*) AS anomaly_count, " + ", ".join(
    rs(f"avg({c})", 4) + f" AS avg_{c}" for c in ("risk_score", "load_percent", "temperature_c", "voltage_kv")))
register("a12_anomalies", on_silver(_ANOM4 + " FROM silver WHERE anomaly_flag = 1 GROUP BY 1, 2"), digits=4)(
    service.anomalies)
register("a12_anomalies_7d", on_silver(
    _ANOM4 + " FROM sel GROUP BY 1, 2", selection("anomaly_flag = 1 AND region = 'EUROPE'", 168)), digits=4)(
    lambda df: service.anomalies(df, FilterSpec(region="EUROPE", time_range="7d")))
_SUB = (f"""SELECT substation_id, region, {rs('sum(power_mw)', 4)} AS total_power_mw,
    {rs('avg(load_percent)', 4)} AS avg_load_percent, {rs('avg(temperature_c)', 4)} AS avg_temperature_c,
    {rs('avg(risk_score)', 4)} AS avg_risk_score, max(risk_score) AS max_risk_score, {FAULTS} AS total_faults,
    count(DISTINCT transformer_id) AS transformer_count, {rs('avg(energy_generated_mwh)', 4)} AS avg_energy_generated,
    {rs('avg(energy_consumed_mwh)', 4)} AS avg_energy_consumed, {band('max(risk_score)')} AS status
    FROM silver WHERE {{where}} GROUP BY 1, 2""")
register("a13_substations", on_silver(_SUB.format(where="TRUE")), digits=4)(service.substations)
register("a13_substations_region", on_silver(_SUB.format(where="region = 'MIDDLE EAST'")), digits=4)(
    lambda df: service.substations(df, "MIDDLE EAST"))
_H4 = ("""SELECT CAST(hour("timestamp") AS INTEGER) AS hour_of_day, """ + ", ".join(
    rs(e, 4) + f" AS {a}" for a, e in {
        "total_power_mw": "sum(power_mw)", "avg_load_percent": "avg(load_percent)",
        "avg_temperature_c": "avg(temperature_c)", "avg_energy_generated_mwh": "avg(energy_generated_mwh)",
        "avg_energy_consumed_mwh": "avg(energy_consumed_mwh)", "avg_risk_score": "avg(risk_score)"}.items())
       + f", {FAULTS} AS total_faults, count(*) AS record_count FROM {{src}} GROUP BY 1")
register("a14_energy_by_hour", on_silver(_H4.format(src="silver")), digits=4)(service.energy_by_hour)
register("a14_energy_by_hour_24h", on_silver(_H4.format(src="sel"), selection(n_hours=24)), digits=4)(
    lambda df: service.energy_by_hour(df, FilterSpec(time_range="24h")))
register("a14_energy_totals", on_silver(
    f"""SELECT {rs('sum(energy_generated_mwh)', 1)} AS total_generated, {rs('sum(energy_consumed_mwh)', 1)} AS total_consumed
      FROM sel""", selection(n_hours=24)))(lambda df: service.energy_totals(df, FilterSpec(time_range="24h")))
register("a14_energy_totals_all_rows", on_silver(
    f"""SELECT {rs('sum(energy_generated_mwh)', 1)} AS total_generated, {rs('sum(energy_consumed_mwh)', 1)} AS total_consumed
      FROM silver"""))(service.energy_totals)
_ST = ["Normal", "Low", "Warning", "High Risk", "Critical"]
_COUNTS = ", ".join(
    f"count(*) FILTER (status = '{s}') AS {s.lower().replace(' ', '_')}_count" for s in _ST)
_RISK = (f"SELECT {_COUNTS}, coalesce({rs('avg(risk_score)', 1)}, 0) AS avg_risk_score, "
         "coalesce(max(risk_score), 0) AS max_risk_score FROM {src}")
register("a15_risk", on_silver(_RISK.format(src="silver")))(service.risk)
register("a15_risk_no_rows", on_silver(_RISK.format(src="(SELECT * FROM silver WHERE region = 'Atlantis')")))(
    lambda df: service.risk(df, FilterSpec(region="Atlantis")))

_ACTIVE = """count(DISTINCT transformer_id) AS total_transformers,
    count(DISTINCT CASE WHEN status <> 'Critical' THEN transformer_id END) AS active_transformers,
    count(DISTINCT CASE WHEN risk_score >= 85 THEN transformer_id END) AS critical_transformers"""
HEALTH_CTES = f"""hf AS (SELECT count(*) AS n, {_COUNTS}, {_ACTIVE}, avg(voltage_deviation_kv) AS mdv,
    avg(frequency_deviation_hz) AS mdf, count(*) FILTER (load_percent > 90) AS overloads,
    count(*) FILTER (temperature_c > 70) AS hot, count(*) FILTER (communication_latency_ms > 50) AS late FROM sel),
hs AS (SELECT *, greatest(0, 1 - abs(mdv) / 5) AS vs, greatest(0, 1 - abs(mdf) / 5e-1) AS fs,
    overloads / nullif(n, 0) AS orate, late / nullif(n, 0) AS lrate FROM hf),
hh AS (SELECT *, CASE WHEN n = 0 THEN 50 ELSE least(100, greatest(0, normal_count / n * 30
    + (1 - critical_count / n) * 20 + (1 - warning_count / n) * 10 + vs * 12 + fs * 10
    + greatest(0, 1 - orate * 5) * 8 + greatest(0, 1 - hot / n * 5) * 5 + greatest(0, 1 - lrate * 10) * 5)) END AS h
  FROM hs)"""
_HEALTH = f"""SELECT {rs('h', 1)} AS health_score, CASE WHEN n = 0 THEN 'Unknown' WHEN h >= 80 THEN 'Excellent'
    WHEN h >= 65 THEN 'Healthy' WHEN h >= 50 THEN 'Warning' ELSE 'Critical' END AS status, total_transformers,
    active_transformers, critical_transformers, normal_count, warning_count, high_risk_count, critical_count, low_count,
    CASE WHEN n = 0 THEN 0 ELSE {rs('vs * 100', 1)} END AS avg_voltage_stability,
    CASE WHEN n = 0 THEN 0 ELSE {rs('fs * 100', 1)} END AS avg_frequency_stability,
    coalesce({rs('orate * 100', 2)}, 0) AS overload_rate, coalesce({rs('lrate * 100', 2)}, 0) AS communication_failure_rate
    FROM hh"""
register("a17_grid_health", on_silver(_HEALTH, selection() + ",\n" + HEALTH_CTES))(service.grid_health)
register("a17_grid_health_asia_30d", on_silver(_HEALTH, ASIA_30D_SQL + ",\n" + HEALTH_CTES))(
    lambda df: service.grid_health(df, ASIA_30D))
register("a17_grid_health_no_rows", on_silver(_HEALTH, selection("region = 'Atlantis'") + ",\n" + HEALTH_CTES))(
    lambda df: service.grid_health(df, FilterSpec(region="Atlantis")))
register("a18_transformer_counts", on_silver(f"SELECT {_ACTIVE} FROM sel", ASIA_30D_SQL))(
    lambda df: service.transformer_counts(df, ASIA_30D))

register("a18_transformer_counts_all_rows", on_silver(f"SELECT {_ACTIVE} FROM silver"))(service.transformer_counts)


def _change(recent: str, earlier: str, limit: bool = True) -> str:
    ratio = f"({recent} - {earlier}) / nullif(abs({earlier}), 0) * 100"
    return f"coalesce({rs(f'greatest(least({ratio}, 50), -50)' if limit else ratio, 1)}, 0)"


def _sides(expr: str) -> tuple[str, str]:
    return expr.replace("@", "recent"), expr.replace("@", "NOT recent")


_TREND_PARTS = {
    "generation_trend": _change(*_sides("avg(energy_generated_mwh) FILTER (@)")),
    "consumption_trend": _change(*_sides("avg(energy_consumed_mwh) FILTER (@)")),
    "load_trend": _change(*_sides("avg(load_percent) FILTER (@)")),
    "transformer_trend": _change(*_sides("count(DISTINCT transformer_id) FILTER (@ AND status = 'Critical')"), False),
    "fault_trend": _change(*_sides("coalesce(sum(fault_indicator) FILTER (@), 0)")),
    "anomaly_trend": _change(*_sides("coalesce(sum(anomaly_flag) FILTER (@), 0)")),
}
TREND_CTES = f"""{SPLIT_CTES},
tr AS (SELECT {', '.join(f'CASE WHEN count(*) >= 10 THEN {e} ELSE 0 END AS {a}' for a, e in _TREND_PARTS.items())}
  FROM split)"""
register("w03_trends", on_silver("SELECT * EXCLUDE (transformer_trend) FROM tr", selection() + ",\n" + TREND_CTES), source="none")(
    lambda spark, sf_dir: trends.trends(silver(spark, sf_dir), index=seconds(spark, sf_dir)).drop("transformer_trend"))
register("w03_recent_split", on_silver("SELECT event_id, recent AS is_recent FROM split",
                                       selection() + ",\n" + SPLIT_CTES), source="none")(
    lambda spark, sf_dir: trends.mark_recent(silver(spark, sf_dir), index=seconds(spark, sf_dir)).select("event_id", "is_recent"))
register("w03_trends_few_rows", on_silver(
    "SELECT * FROM tr", selection("region = 'ASIA' AND risk_score >= 99", 24) + ",\n" + TREND_CTES))(
    lambda df: trends.trends(df.filter("region = 'ASIA' AND risk_score >= 99").transform(
        lambda d: filters.newest_within(d, 24))))
register("w04_critical_transformer_trend", on_silver(
    "SELECT transformer_trend FROM tr", selection(n_hours=24) + ",\n" + TREND_CTES))(
    lambda df: trends.trends(filters.newest_within(df, 24)).select("transformer_trend"))

register("w04_critical_transformer_trend_all_rows", on_silver(
    "SELECT transformer_trend FROM tr", selection() + ",\n" + TREND_CTES), source="none")(
    lambda spark, sf_dir: trends.trends(silver(spark, sf_dir), index=seconds(spark, sf_dir)).select("transformer_trend"))

_SUMMARY = f"""SELECT coalesce({rs('(SELECT sum(energy_generated_mwh) FROM sel)', 1)}, 0) AS total_generation_mw,
    coalesce({rs('(SELECT sum(energy_consumed_mwh) FROM sel)', 1)}, 0) AS total_consumption_mw,
    coalesce({rs('(SELECT avg(load_percent) FROM sel)', 1)}, 0) AS grid_load_percent, active_transformers,
    total_transformers, CAST(coalesce((SELECT sum(fault_indicator) FROM sel), 0) AS BIGINT) AS faults_detected,
    CAST(coalesce((SELECT sum(anomaly_flag) FROM sel), 0) AS BIGINT) AS anomalies_detected, critical_transformers,
    {rs('h', 1)} AS grid_health_score, tr.*, n AS records_today FROM hh, tr"""
for _name, _sel, _spec in (
    ("a16_summary", selection(n_hours=24), None),
    ("a16_summary_asia_30d", ASIA_30D_SQL, ASIA_30D),
    ("a16_summary_no_rows", selection("region = 'Atlantis'", 24), FilterSpec(region="Atlantis", time_range="24h")),
):
    register(_name, on_silver(_SUMMARY, f"{_sel},\n{HEALTH_CTES},\n{TREND_CTES}"))(
        lambda df, spec=_spec: service.summary(df) if spec is None else service.summary(df, spec))

register("t02_alerts", on_silver(f"""SELECT event_id, "timestamp", {TK}, anomaly_type, risk_score, status, voltage_kv,
    temperature_c, load_percent FROM silver WHERE anomaly_flag = 1
    ORDER BY risk_score DESC, "timestamp" DESC, event_id LIMIT 20"""))(service.alerts)
