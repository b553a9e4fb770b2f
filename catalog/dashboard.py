"""Dashboard tables, cards and feeds."""

from __future__ import annotations

from catalog.base import on_silver, register, rs, selection
from catalog.gold import FAULTS, TK, transformer_full
from catalog.scoring import EVENT_SQL, PRIORITY
from wattlake.operators import dashboard, filters, service

HOUR = """date_trunc('hour', "timestamp")"""
_ST = ["Normal", "Low", "Warning", "High Risk", "Critical"]


def four(pairs: dict[str, str]) -> str:
    return ", ".join(f"{rs(e, 4)} AS {a}" for a, e in pairs.items())


def _values(names: list[str]) -> str:
    return "(VALUES " + ", ".join(f"('{n}')" for n in names) + ")"


register("a31_status_distribution", on_silver(f"""SELECT l AS status, count(status) AS records,
    {rs('count(status) * 100 / (SELECT count(*) FROM silver)', 4)} AS percent
    FROM {_values(_ST)} t(l) LEFT JOIN silver ON status = l GROUP BY l"""), digits=4)(dashboard.status_distribution)
register("a31_anomaly_type_distribution", on_silver(f"""SELECT anomaly_type, count(*) AS records,
    {rs('count(*) * 100 / sum(count(*)) OVER ()', 4)} AS percent FROM silver WHERE status <> 'Normal' GROUP BY 1"""),
    digits=4)(dashboard.anomaly_type_distribution)
register("a31_region_energy_report", on_silver(f"""SELECT coalesce(region, 'TOTAL') AS region, count(*) AS record_count,
    {four({'percent': 'count(*) * 100 / (SELECT count(*) FROM silver)',
           'total_energy_generated_mwh': 'sum(energy_generated_mwh)',
           'total_energy_consumed_mwh': 'sum(energy_consumed_mwh)'})} FROM silver GROUP BY ROLLUP (region)"""), digits=4)(
    dashboard.region_energy_report)
register("a32_coverage_counts", on_silver("""SELECT count(*) AS record_count, count(DISTINCT transformer_id) AS transformers,
    count(DISTINCT substation_id) AS substations, count(DISTINCT region) AS regions,
    min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp FROM silver"""))(dashboard.coverage_counts)
register("a33_correlations", on_silver(f"""SELECT {four({
    'load_current': 'corr(load_percent, current_amp)', 'load_temperature': 'corr(load_percent, temperature_c)',
    'risk_load': 'corr(risk_score, load_percent)', 'risk_temperature': 'corr(risk_score, temperature_c)'})} FROM silver"""),
    digits=4)(dashboard.correlations)

_WORST = f"(SELECT transformer_id, max({PRIORITY}) AS p FROM {{src}} GROUP BY 1)"
register("a34_health_donut_by_transformer", on_silver(f"""SELECT count(*) FILTER (p = 0) AS normal_count,
    count(*) FILTER (p = 2) AS warning_count, count(*) FILTER (p = 3) AS high_risk_count,
    count(*) FILTER (p = 4) AS critical_count, count(*) FILTER (p <> 1) AS total
    FROM {_WORST.format(src='sel')}""", selection(n_hours=24)))(
    lambda df: dashboard.health_donut_by_transformer(filters.newest_within(df, 24)))
register("a34_health_donut_all_rows", on_silver(f"""SELECT count(*) FILTER (p = 0) AS normal_count,
    count(*) FILTER (p = 2) AS warning_count, count(*) FILTER (p = 3) AS high_risk_count,
    count(*) FILTER (p = 4) AS critical_count, count(*) FILTER (p <> 1) AS total
    FROM {_WORST.format(src='silver')}"""))(dashboard.health_donut_by_transformer)
register("a35_health_donut_by_record", on_silver("""SELECT count(*) FILTER (status IN ('Normal', 'Low')) AS normal_count,
    count(*) FILTER (status = 'Warning') AS warning_count, count(*) FILTER (status = 'High Risk') AS high_risk_count,
    count(*) FILTER (status = 'Critical') AS critical_count, count(*) AS total FROM silver"""))(
    dashboard.health_donut_by_record)
_ENERGY = f"""SELECT region, {four({'total_power_mw': 'sum(power_mw)', 'avg_load': 'avg(load_percent)',
    'total_generation': 'sum(energy_generated_mwh)', 'total_consumption': 'sum(energy_consumed_mwh)'})}
    FROM silver GROUP BY 1"""
register("a36_energy_by_region", on_silver(_ENERGY), digits=4)(dashboard.energy_by_region)
register("a36_energy_by_generation", on_silver(_ENERGY), digits=4)(
    lambda df: dashboard.energy_by_region(df, "total_generation"))
register("a37_top_anomaly_types", on_silver("""SELECT anomaly_type, count(*) AS anomaly_count FROM silver
    WHERE status <> 'Normal' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"""))(dashboard.top_anomaly_types)
register("a37_top_anomaly_groups", on_silver(f"""SELECT anomaly_type, status, anomaly_count,
    {rs('anomaly_count * 100 / max(anomaly_count) OVER ()', 4)} AS percent_of_max FROM (SELECT anomaly_type, status,
    count(*) AS anomaly_count FROM silver WHERE anomaly_flag = 1 AND anomaly_type <> 'Normal' GROUP BY 1, 2
    ORDER BY 3 DESC, 1, 2 LIMIT 5)"""), digits=4)(lambda df: dashboard.top_anomaly_groups(service.anomalies(df)))
register("w06_share_of_max", on_silver(f"""SELECT anomaly_type, records, {rs('records * 100 / sum(records) OVER ()', 4)}
    AS share_percent FROM (SELECT anomaly_type, count(*) AS records FROM silver GROUP BY 1)"""), digits=4)(
    lambda df: dashboard.share_of_total(
        df.groupBy("anomaly_type").count().withColumnRenamed("count", "records"), "records", "share_percent"))
register("a38_generation_vs_consumption", on_silver(f"""SELECT {HOUR} AS hour,
    {four({'total_generation': 'sum(energy_generated_mwh)', 'total_consumption': 'sum(energy_consumed_mwh)',
           'avg_power': 'avg(power_mw)'})} FROM silver GROUP BY 1"""), digits=4)(dashboard.generation_vs_consumption)

_PERIODS = """lt AS (SELECT max("timestamp") AS latest FROM silver),
k AS (SELECT s.*, "timestamp" >= latest - INTERVAL 24 HOUR AS c,
    "timestamp" < latest - INTERVAL 24 HOUR AND "timestamp" >= latest - INTERVAL 48 HOUR AS p FROM silver s, lt),
kf AS (SELECT coalesce(sum(energy_generated_mwh) FILTER (c), 0) AS g1, coalesce(sum(energy_generated_mwh) FILTER (p), 0) AS g0,
    coalesce(sum(energy_consumed_mwh) FILTER (c), 0) AS e1, coalesce(sum(energy_consumed_mwh) FILTER (p), 0) AS e0,
    coalesce(avg(load_percent) FILTER (c), 0) AS l1, coalesce(avg(load_percent) FILTER (p), 0) AS l0,
    count(DISTINCT transformer_id) AS t, count(DISTINCT transformer_id) FILTER (c) AS t1,
    count(DISTINCT transformer_id) FILTER (p) AS t0, coalesce(sum(fault_indicator) FILTER (c), 0) AS f1,
    coalesce(sum(fault_indicator) FILTER (p), 0) AS f0, count(*) FILTER (c AND status <> 'Normal') AS a1,
    count(*) FILTER (p AND status <> 'Normal') AS a0 FROM k)"""


def _pct(x: str) -> str:
    return f"CASE WHEN {x}0 > 0 THEN ({x}1 - {x}0) / ({x}0 + 1) * 100 ELSE 0 END"


def _arrow(change: str, digits: int) -> str:
    number = rs(f"abs({change})", digits)
    return (f"CASE WHEN {change} > 0 THEN '↑ ' ELSE '↓ ' END || CAST(CAST({number} AS DECIMAL(20,{digits})) AS VARCHAR)"
            " || '% vs last 24h'")


register("a39_kpi_metrics", on_silver(f"""SELECT {four({'total_generation_mw': 'g1', 'total_consumption_mwh': 'e1',
    'avg_load_percent': 'l1'})}, t AS total_transformers, t1 AS active_transformers, CAST(f1 AS BIGINT) AS total_faults,
    a1 AS anomaly_count, {_arrow(_pct('g'), 1)} AS generation_trend, {_arrow(_pct('e'), 1)} AS consumption_trend,
    {_arrow('(l1 - l0)', 1)} AS load_trend, {_arrow(_pct('t'), 1)} AS transformers_trend,
    {_arrow(_pct('f'), 0)} AS faults_trend, {_arrow(_pct('a'), 0)} AS anomalies_trend FROM kf""", _PERIODS), digits=4)(
    dashboard.kpi_metrics)
register("a40_kpi_sparklines", on_silver(f"""SELECT hour, {four({'generation': 'g', 'consumption': 'e', 'load': 'l / 100',
    'faults': 'f / (max(f) OVER () + 1)', 'anomalies': 'a / (max(a) OVER () + 1)',
    'transformers': 't / (SELECT count(DISTINCT transformer_id) FROM silver)'})}
    FROM (SELECT {HOUR} AS hour, sum(energy_generated_mwh) AS g, sum(energy_consumed_mwh) AS e, avg(load_percent) AS l,
      CAST(sum(fault_indicator) AS BIGINT) AS f, count(*) FILTER (status <> 'Normal') AS a,
      count(DISTINCT transformer_id) AS t FROM k WHERE c GROUP BY 1)""", _PERIODS), digits=4)(dashboard.kpi_sparklines)
register("a41_regional_overview", on_silver(f"""SELECT region, count(DISTINCT substation_id) AS substation_count,
    count(DISTINCT transformer_id) AS transformer_count, {four({'avg_load': 'avg(load_percent)',
    'max_load': 'max(load_percent)', 'avg_temp': 'avg(temperature_c)', 'avg_risk': 'avg(risk_score)',
    'health_pct': "count(*) FILTER (status = 'Normal') * 100 / count(*)"})}, max(risk_score) AS max_risk,
    {FAULTS} AS fault_count, count(*) FILTER (status = 'Normal') AS normal_count, count(*) AS total_count
    FROM silver GROUP BY 1"""), digits=4)(dashboard.regional_overview)
register("a42_substation_performance", on_silver(f"""SELECT substation_id, region,
    count(DISTINCT transformer_id) AS transformers, {four({'avg_load': 'avg(load_percent)',
    'max_load': 'max(load_percent)', 'avg_temp': 'avg(temperature_c)', 'avg_voltage': 'avg(voltage_kv)',
    'avg_risk': 'avg(risk_score)'})}, max(risk_score) AS max_risk, {FAULTS} AS faults, count(*) AS records
    FROM silver GROUP BY 1, 2 ORDER BY max(risk_score) DESC, substation_id, region LIMIT 20"""), digits=4)(
    dashboard.substation_performance)

_T = transformer_full("silver", 4, "exact_risk")
_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s.lower().replace(' ', '_')}_count" for s in _ST)
register("a45_status_counts_over_transformers", on_silver(f"""SELECT {_COUNTS},
    count(*) FILTER (status <> 'Critical') AS active_count, CAST(sum(total_faults) AS BIGINT) AS total_faults
    FROM ({_T})"""))(lambda df: dashboard.status_counts_over_transformers(service.transformers(df)))
_A12 = "(SELECT anomaly_type, status, count(*) AS n FROM silver WHERE anomaly_flag = 1 GROUP BY 1, 2)"
register("a46_anomaly_totals", on_silver(f"""SELECT CAST(sum(n) AS BIGINT) AS total,
    CAST(sum(n) FILTER (status = 'Critical') AS BIGINT) AS critical, CAST(sum(n) FILTER (status = 'High Risk') AS BIGINT)
    AS high, CAST(sum(n) FILTER (status = 'Warning') AS BIGINT) AS warning FROM {_A12}"""))(
    lambda df: dashboard.anomaly_totals(service.anomalies(df)))
register("a46_anomalies_by_type", on_silver(
    f"SELECT anomaly_type, CAST(sum(n) AS BIGINT) AS anomaly_count FROM {_A12} GROUP BY 1"))(
    lambda df: dashboard.anomalies_by_type(service.anomalies(df)))
_AVGS = {"avg_load": "avg(load_percent)", "avg_temp": "avg(temperature_c)", "avg_voltage": "avg(voltage_kv)",
         "avg_pf": "avg(power_factor)", "avg_risk": "avg(risk_score)"}
_BAND = ("CASE WHEN max(risk_score) >= 85 THEN 'Critical' WHEN max(risk_score) >= 70 THEN 'High Risk' WHEN "
         "max(risk_score) >= 50 THEN 'Warning' WHEN max(risk_score) >= 30 THEN 'Low' ELSE 'Normal' END")
register("a47_top_risk_transformers", on_silver(f"""SELECT {TK}, {four(_AVGS)}, max(risk_score) AS max_risk,
    {_BAND} AS status FROM silver GROUP BY {TK} ORDER BY max(risk_score) DESC, transformer_id LIMIT 5"""), digits=4)(
    dashboard.top_risk_transformers)
_NAMES = ("CASE max({p}) WHEN 4 THEN 'Critical' WHEN 3 THEN 'High Risk' WHEN 2 THEN 'Warning' WHEN 1 THEN 'Low' "
          "ELSE 'Normal' END").format(p=PRIORITY)
_TABLE = f"SELECT {TK}, {four(_AVGS)}, max(risk_score) AS max_risk, {_NAMES} AS status FROM silver {{w}} GROUP BY {TK}"
register("a48_transformer_table", on_silver(_TABLE.format(w="")), digits=4)(dashboard.transformer_table)
_POSITIONS = f"""SELECT * EXCLUDE (avg_temp_raw), row_number() OVER (ORDER BY avg_temp_raw, transformer_id) AS position
    FROM (SELECT {TK}, avg(temperature_c) AS avg_temp_raw, {four(_AVGS)} FROM silver {{w}} GROUP BY {TK})"""
for _name, _text, _where in (
    ("q09_sorted_transformer_table", "00002", "WHERE lower(transformer_id) LIKE '%00002%'"), ("q09_sorted_transformer_table_all", "", ""),
):
    register(_name, on_silver(_POSITIONS.format(w=_where)), digits=4)(
        lambda df, text=_text: filters.positioned(
            filters.search_transformers(dashboard.transformer_table(df), text), "Temperature", ascending=True
        ).drop("max_risk", "status"))


register("a50_system_status", on_silver("""SELECT CASE WHEN count(*) > 0 THEN 'All Systems Operational'
    ELSE 'No Data Available' END AS system_status, count(*) AS record_count,
    count(DISTINCT transformer_id) AS transformer_count, max("timestamp") AS latest_timestamp, count(*) > 0 AS loaded
    FROM silver"""))(dashboard.system_status)

_ALERT = """SELECT event_id, "timestamp", transformer_id, substation_id, anomaly_type, anomaly_score, risk_score, status
    FROM silver WHERE status <> 'Normal' ORDER BY "timestamp" DESC, risk_score DESC, event_id LIMIT {n}"""
register("t03_recent_alerts", on_silver(_ALERT.format(n=5)))(dashboard.recent_alerts)
register("t04_anomaly_detail", on_silver(_ALERT.format(n=50)))(lambda df: dashboard.recent_alerts(df, 50))
register("t05_ticker", on_silver(f"""SELECT event_id, "timestamp",
    strftime("timestamp", '%H:%M') || ' ' || {EVENT_SQL} AS ticker_text FROM silver WHERE status <> 'Normal'
    ORDER BY "timestamp" DESC, event_id LIMIT 5"""))(dashboard.ticker)
for _n in (10, 6):
    register(f"t08_top_transformers_{_n}", on_silver(
        f"SELECT transformer_id, {rs('exact_risk', 4)} AS avg_risk_score FROM (SELECT transformer_id, "
        f"avg(risk_score) AS exact_risk FROM silver GROUP BY 1) ORDER BY exact_risk DESC, transformer_id LIMIT {_n}"),
        digits=4)(lambda df, n=_n: dashboard.top_transformers(service.transformers(df), n).select(
            "transformer_id", "avg_risk_score"))
