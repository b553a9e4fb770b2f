"""Hierarchy joins, samples, projections, set operations and forecasts."""

from __future__ import annotations

from catalog.base import hash32, on_silver, register, rh, rs, seconds, selection, silver
from catalog.dashboard import HOUR, four
from catalog.gold import FAULTS
from wattlake.operators import filters, forecast, sampling, service, topology, trends
from wattlake.sources import derived, dimensions

DIM_CTES = ("dim(substation_id, lat, lon, dregion, name) AS (VALUES "
            + ", ".join(f"('{i}', {a}e0, {b}e0, '{r}', '{n}')" for i, a, b, r, n in dimensions.SUBSTATIONS)
            + "),\nlines(src, dst) AS (VALUES "
            + ", ".join(f"('{a}', '{b}')" for a, b in dimensions.TRANSMISSION_LINES) + ")")


def _dim(df):
    return dimensions.substation_dimension(df.sparkSession)


register("j02_substation_coordinates", on_silver(
    "SELECT substation_id, records, coalesce(lat, 22) AS lat, coalesce(lon, 78) AS lon FROM (SELECT substation_id, "
    "count(*) AS records FROM silver GROUP BY 1) LEFT JOIN dim USING (substation_id)", DIM_CTES))(
    lambda df: topology.with_coordinates(
        df.groupBy("substation_id").count().withColumnRenamed("count", "records"), _dim(df)))
register("j03_row_times_statistics", on_silver(f"""SELECT event_id, {rs('load_percent - m', 4)} AS load_offset
    FROM silver, (SELECT avg(load_percent) AS m FROM silver)"""), digits=4)(
    lambda df: df.crossJoin(df.selectExpr("avg(load_percent) AS m").hint("broadcast")).selectExpr(
        "event_id", "load_percent - m AS load_offset"))
register("a43_map_substations", on_silver(f"""SELECT substation_id, region, {four({'avg_load': 'l'})}, max_risk, fault_count,
    transformer_count, CASE WHEN max_risk >= 85 THEN 'Critical' WHEN max_risk >= 70 OR l >= 80 THEN 'High Load'
    ELSE 'Normal' END AS status, coalesce(lat, 22) AS lat, coalesce(lon, 78) AS lon
    FROM (SELECT substation_id, region, avg(load_percent) AS l, max(risk_score) AS max_risk, {FAULTS} AS fault_count,
      count(DISTINCT transformer_id) AS transformer_count FROM silver GROUP BY 1, 2)
    LEFT JOIN dim USING (substation_id)""", DIM_CTES), digits=4)(lambda df: topology.map_substations(df, _dim(df)))
register("a44_map_from_transformers", on_silver(f"""SELECT substation_id, count(*) AS transformer_count,
    CAST(sum(f) AS BIGINT) AS total_faults, {four({'avg_load': 'avg(l)', 'avg_temp': 'avg(t)', 'avg_risk': 'avg(r)',
    'max_risk': 'max(r)'})}, CASE WHEN max(r) >= 85 THEN 'Critical' WHEN max(r) >= 70 THEN 'High Risk'
    WHEN max(r) >= 50 THEN 'Warning' ELSE 'Normal' END AS status
    FROM (SELECT substation_id, transformer_id, sum(fault_indicator) AS f, avg(load_percent) AS l, avg(temperature_c) AS t,
      avg(risk_score) AS r FROM silver GROUP BY 1, 2) GROUP BY 1"""), digits=4)(
    lambda df: topology.map_substations_from_transformers(service.transformers(df)))
_PLACES = "(SELECT DISTINCT substation_id, region, coalesce(lat, 22) AS lat, coalesce(lon, 78) AS lon FROM silver LEFT JOIN dim USING (substation_id))"
register("w02_neighbour_links", on_silver(f"""SELECT * FROM (SELECT region, substation_id AS src, lat AS src_lat,
    lon AS src_lon, lead(substation_id) OVER w AS dst, lead(lat) OVER w AS dst_lat, lead(lon) OVER w AS dst_lon
    FROM {_PLACES} WINDOW w AS (PARTITION BY region ORDER BY lon, substation_id)) WHERE dst IS NOT NULL""", DIM_CTES))(
    lambda df: topology.neighbour_links(topology.with_coordinates(
        df.select("substation_id", "region").distinct(), _dim(df))))
_LINES = """SELECT src, dst FROM lines WHERE (SELECT count(*) FROM vis) = 0
    OR (src IN (SELECT substation_id FROM vis) AND dst IN (SELECT substation_id FROM vis))"""
_VIS = "vis AS (SELECT DISTINCT substation_id FROM silver JOIN dim USING (substation_id) WHERE {w})"
for _name, _where in (("", "region IN ('ASIA', 'EUROPE', 'AFRICA')"), ("_none_visible", "region = 'Atlantis'")):
    register(f"j04_visible_lines{_name}", on_silver(_LINES, DIM_CTES + ",\n" + _VIS.format(w=_where)))(
        lambda df, w=_where: topology.visible_lines(
            df.filter(w), dimensions.transmission_lines(df.sparkSession), _dim(df)))
register("a51_map_bounds", on_silver(f"""SELECT {four({
    'south': 'min(lat) - greatest((max(lat) - min(lat)) * 8e-2, 7e-1)',
    'west': 'min(lon) - greatest((max(lon) - min(lon)) * 8e-2, 7e-1)',
    'north': 'max(lat) + greatest((max(lat) - min(lat)) * 8e-2, 7e-1)',
    'east': 'max(lon) + greatest((max(lon) - min(lon)) * 8e-2, 7e-1)'})}
    FROM vis JOIN dim USING (substation_id)""", DIM_CTES + ",\n" + _VIS.format(w="region = 'ASIA'")), digits=4)(
    lambda df: topology.map_bounds(df.filter("region = 'ASIA'"), _dim(df)))
register("a51_map_bounds_all_rows", on_silver(f"""SELECT {four({
    'south': 'min(lat) - greatest((max(lat) - min(lat)) * 8e-2, 7e-1)',
    'west': 'min(lon) - greatest((max(lon) - min(lon)) * 8e-2, 7e-1)',
    'north': 'max(lat) + greatest((max(lat) - min(lat)) * 8e-2, 7e-1)',
    'east': 'max(lon) + greatest((max(lon) - min(lon)) * 8e-2, 7e-1)'})}
    FROM vis JOIN dim USING (substation_id)""", DIM_CTES + ",\n" + _VIS.format(w="TRUE")), digits=4)(
    lambda df: topology.map_bounds(df, _dim(df)))
register("j05_referential_violations", on_silver("""SELECT substation_id, region, records,
    CASE WHEN dregion IS NULL THEN 'unknown substation' ELSE 'wrong region' END AS problem FROM (SELECT substation_id,
    region, count(*) AS records FROM silver GROUP BY 1, 2) LEFT JOIN dim USING (substation_id)
    WHERE dregion IS NULL OR dregion <> region""", DIM_CTES))(
    lambda df: topology.referential_violations(df, _dim(df)))


@register("j06_missing_members", on_silver("""SELECT 'transformer_id' AS level,
    'TR-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS member FROM supplier WHERE 'TR-' || lpad(CAST(s_suppkey AS
    VARCHAR), 6, '0') NOT IN (SELECT transformer_id FROM sel) UNION ALL SELECT 'substation_id', 'SUB-' || lpad(CAST(
    n_nationkey AS VARCHAR), 3, '0') FROM nation WHERE 'SUB-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') NOT IN
    (SELECT substation_id FROM sel) UNION ALL SELECT 'region', r_name FROM region WHERE r_name NOT IN
    (SELECT region FROM sel)""", selection("risk_score >= 92", 168)), source="none")
def _(spark, sf_dir):
    rows = filters.newest_within(silver(spark, sf_dir).filter("risk_score >= 92"), 168)
    grid = derived.grid_dimension(spark, sf_dir)
    return topology.missing_members(rows, {
        "transformer_id": derived.transformer_dimension(spark, sf_dir), "substation_id": grid, "region": grid})


@register("j06_missing_members_all_rows", on_silver("""SELECT 'transformer_id' AS level,
    'TR-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS member FROM supplier WHERE 'TR-' || lpad(CAST(s_suppkey AS
    VARCHAR), 6, '0') NOT IN (SELECT transformer_id FROM silver) UNION ALL SELECT 'substation_id', substation_id FROM dim
    WHERE substation_id NOT IN (SELECT substation_id FROM silver)""", DIM_CTES), source="none")
def _(spark, sf_dir):
    """Suppliers without readings, and the fixed grid's substations that the readings lack."""
    rows = silver(spark, sf_dir)
    return topology.missing_members(rows, {
        "transformer_id": derived.transformer_dimension(spark, sf_dir), "substation_id": _dim(rows)})


@register("j07_enrich_parents", on_silver("""SELECT event_id, transformer_id, substation_id, region, power_mw FROM silver"""),
          source="none")
def _(spark, sf_dir):
    enriched = topology.enrich_parents(
        silver(spark, sf_dir), derived.transformer_dimension(spark, sf_dir), derived.grid_dimension(spark, sf_dir))
    return enriched.select("event_id", "transformer_id", "substation_id", "region", "power_mw")


register("u03_set_difference", on_silver("""SELECT transformer_id FROM silver EXCEPT
    SELECT transformer_id FROM sel WHERE risk_score >= 85""", selection(n_hours=24)))(
    lambda df: topology.set_difference(
        df.select("transformer_id"),
        filters.newest_within(df, 24).filter("risk_score >= 85").select("transformer_id")))
register("u03_set_difference_all_rows", on_silver("""SELECT transformer_id FROM silver EXCEPT
    SELECT transformer_id FROM silver WHERE risk_score >= 85"""))(
    lambda df: topology.set_difference(
        df.select("transformer_id"), df.filter("risk_score >= 85").select("transformer_id")))
register("s11_newest_rows", on_silver("""SELECT event_id, "timestamp", risk_score FROM silver
    ORDER BY "timestamp" DESC, """ + hash32("event_id") + """ // 4096 DESC, event_id DESC LIMIT 40000"""), source="none")(
    lambda spark, sf_dir: trends.newest(silver(spark, sf_dir), 40000, seconds(spark, sf_dir)).select("event_id", "timestamp", "risk_score"))

# --- samples and projections ------------------------------------------------------------------
_HASH = "md5(event_id || '#42'), event_id"
register("m01_uniform_sample", on_silver(
    f"SELECT event_id, risk_score, status FROM silver ORDER BY {_HASH} LIMIT 1000"))(
    lambda df: sampling.uniform_sample(df).select("event_id", "risk_score", "status"))
_IMPORTANT = "status IN ('Critical', 'High Risk', 'Warning')"
_PRIORITY = f"""SELECT event_id, status FROM {{src}} WHERE {_IMPORTANT} UNION ALL SELECT event_id, status FROM (
    SELECT event_id, status, row_number() OVER (ORDER BY {_HASH}) AS r FROM {{src}} WHERE status IN ('Normal', 'Low'))
    WHERE r <= 2500 - (SELECT count(*) FROM {{src}} WHERE {_IMPORTANT})"""
register("m02_priority_sample", on_silver(_PRIORITY.format(src="silver")))(
    lambda df: sampling.priority_sample(df).select("event_id", "status"))
register("u01_priority_sample_filled", on_silver(
    _PRIORITY.format(src="sel"), selection("region = 'ASIA'", 720)))(
    lambda df: sampling.priority_sample(filters.newest_within(df.filter("region = 'ASIA'"), 720)).select(
        "event_id", "status"))


def _txt(c: str, d: int) -> str:
    return f"CAST(CAST({rh(c, d)} AS DECIMAL(20,{d})) AS VARCHAR)"


register("m03_risk_landscape", on_silver(f"""SELECT event_id, status, {rh('voltage_kv', 2)} AS x,
    {rh('temperature_c', 2)} AS y, risk_score AS z, 'Transformer: ' || transformer_id || '<br>Region: ' || region
    || '<br>Voltage: ' || {_txt('voltage_kv', 1)} || ' kV<br>Temperature: ' || {_txt('temperature_c', 1)}
    || '°C<br>Risk: ' || risk_score || '<br>Status: ' || status || '<br>Anomaly: ' || anomaly_type AS hover
    FROM silver"""))(sampling.risk_landscape)
register("m04_load_performance", on_silver(f"""SELECT event_id, status, {rh('load_percent', 2)} AS x,
    {rh('power_factor', 4)} AS y, {rh('temperature_c', 2)} AS z, 'Transformer: ' || transformer_id || '<br>Region: '
    || region || '<br>Load: ' || {_txt('load_percent', 1)} || '%<br>Power Factor: ' || {_txt('power_factor', 3)}
    || '<br>Temperature: ' || {_txt('temperature_c', 1)} || '°C<br>Risk: ' || risk_score || '<br>Status: ' || status
    AS hover FROM silver"""))(sampling.load_performance)
register("m05_energy_space", on_silver(f"""SELECT event_id, region, energy_generated_mwh AS x, energy_consumed_mwh AS y,
    load_percent AS z, '<b>' || transformer_id || '</b><br>Region: ' || region || '<br>Substation: ' || substation_id
    || '<br>Generated: ' || format('{{:,}}', CAST(energy_generated_mwh AS BIGINT)) || ' MWh<br>Consumed: '
    || format('{{:,}}', CAST(energy_consumed_mwh AS BIGINT)) || ' MWh<br>Load: ' || {_txt('load_percent', 1)} || '%'
    AS hover FROM silver"""))(sampling.energy_space)
register("m06_anomaly_space", on_silver(f"""SELECT event_id, status, abs({rh('voltage_kv - 40', 6)}) AS x,
    temperature_c AS y, anomaly_score AS z FROM silver"""))(sampling.anomaly_space)
register("m07_overview_space", on_silver(f"""SELECT event_id, status, load_percent AS x, temperature_c AS y,
    risk_score AS z, 'Transformer: ' || transformer_id || '<br>Substation: ' || substation_id || '<br>Load: '
    || {_txt('load_percent', 1)} || '%<br>Temperature: ' || {_txt('temperature_c', 1)} || '°C<br>Risk Score: '
    || risk_score || '<br>Status: ' || status AS hover FROM silver"""))(sampling.overview_space)

# --- forecasts --------------------------------------------------------------------------------
_SERIES = f"""hs AS (SELECT {HOUR} AS hour, avg(load_percent) AS load, sum(energy_consumed_mwh) AS cons FROM silver GROUP BY 1),
hx AS (SELECT *, row_number() OVER (ORDER BY hour) - 1 AS x FROM hs),
fit AS (SELECT count(*) AS n, max(hour) AS last_hour, regr_slope(load, x) AS ls, regr_intercept(load, x) AS li,
    regr_slope(cons, x) AS cs, regr_intercept(cons, x) AS ci FROM hx)"""
_LOAD_F = "least(100, greatest(0, li + ls * (n - 1 + step)))"
_STEPS = "(SELECT CAST(step AS INTEGER) AS step FROM range(1, 7) r(step))"
register("ml9_load_forecast", on_silver(f"""SELECT step, last_hour + to_hours(step) AS forecast_hour,
    {rs(_LOAD_F, 4)} AS forecast FROM fit, {_STEPS} WHERE n >= 6""", _SERIES), digits=4)(forecast.load_forecast)
register("ml9_forecast_report", on_silver("SELECT " + ", ".join(
    rs(f"max({_LOAD_F}) FILTER (step = {s})", 4) + f" AS in_{s}h" for s in (1, 3, 6)) + f" FROM fit, {_STEPS}", _SERIES),
    digits=4)(forecast.forecast_report)
register("ml9_hourly_series", on_silver(f"""SELECT {HOUR} AS hour, {four({'avg_load': 'avg(load_percent)',
    'total_consumption': 'sum(energy_consumed_mwh)', 'avg_temp': 'avg(temperature_c)'})} FROM silver GROUP BY 1"""),
    digits=4)(forecast.hourly_series)
register("ml10_consumption_forecast", on_silver(f"""SELECT step, last_hour + to_hours(step) AS forecast_hour,
    {rs('greatest(0, ci + cs * (n - 1 + step))', 4)} AS forecast FROM fit, {_STEPS} WHERE n >= 6""", _SERIES), digits=4)(
    forecast.consumption_forecast)
register("ml11_moving_average_forecast", on_silver(f"""SELECT step, CAST((h + step) % 24 AS INTEGER) AS hour_of_day,
    {four({'generation_forecast': 'g', 'consumption_forecast': 'c'})} FROM (SELECT max(h) AS h, avg(g) AS g, avg(c) AS c,
    count(*) AS n FROM (SELECT hour("timestamp") AS h, avg(energy_generated_mwh) AS g, avg(energy_consumed_mwh) AS c
    FROM silver GROUP BY 1 ORDER BY 1 DESC LIMIT 3)), {_STEPS} WHERE n = 3"""), digits=4)(
    lambda df: forecast.moving_average_forecast(service.energy_by_hour(df)))
