"""Gold summaries and their joins."""

from __future__ import annotations

from catalog.base import band, on_silver, register, rs
from wattlake.operators import gold

TK = "transformer_id, substation_id, region"


def a2(fn: str, expr: str, alias: str, digits: int = 2) -> str:
    return f"{rs(f'{fn}({expr})', digits)} AS {alias}"


def avgs(names: dict[str, str], digits: int = 2) -> str:
    return ", ".join(a2("avg", c, a, digits) for a, c in names.items())


def sums(names: dict[str, str], digits: int = 2) -> str:
    return ", ".join(a2("sum", c, a, digits) for a, c in names.items())


FAULTS = "CAST(sum(fault_indicator) AS BIGINT)"


def transformer_sql(digits: int) -> str:
    return f"""SELECT {TK}, {sums({'total_power_mw': 'power_mw'}, digits)}, {avgs({
        'avg_voltage_kv': 'voltage_kv', 'avg_current_amp': 'current_amp', 'avg_power_mw': 'power_mw',
        'avg_frequency_hz': 'frequency_hz', 'avg_load_percent': 'load_percent', 'avg_power_factor': 'power_factor',
        'avg_temperature_c': 'temperature_c'}, digits)}, {a2('max', 'temperature_c', 'max_temperature_c', digits)}, {sums({
        'total_energy_generated_mwh': 'energy_generated_mwh',
        'total_energy_consumed_mwh': 'energy_consumed_mwh'}, digits)},
      {avgs({'avg_latency_ms': 'communication_latency_ms'}, digits)}, {FAULTS} AS total_faults,
      max(risk_score) AS max_risk_score, {avgs({'avg_risk_score': 'risk_score'}, digits)}, count(*) AS record_count,
      count(DISTINCT anomaly_type) AS distinct_anomaly_types, avg(risk_score) AS exact_risk
      FROM {{src}} GROUP BY {TK}"""


DOMINANT = """SELECT transformer_id, anomaly_type AS dominant_anomaly_type FROM (
      SELECT transformer_id, anomaly_type, row_number() OVER (PARTITION BY transformer_id
        ORDER BY count(*) DESC, anomaly_type) AS rn FROM {src} WHERE status <> 'Normal' GROUP BY 1, 2) WHERE rn = 1"""


def transformer_full(src: str, digits: int, score: str) -> str:
    return f"""SELECT t.* EXCLUDE (exact_risk), {band('max_risk_score')} AS worst_status, {band(score)} AS status,
      coalesce(dominant_anomaly_type, 'Normal') AS dominant_anomaly_type
      FROM ({transformer_sql(digits).format(src=src)}) t LEFT JOIN ({DOMINANT.format(src=src)}) USING (transformer_id)"""


REGION_SQL = f"""{sums({'total_power_mw': 'power_mw'})}, {avgs({
    'avg_voltage_kv': 'voltage_kv', 'avg_load_percent': 'load_percent', 'avg_temperature_c': 'temperature_c',
    'avg_power_factor': 'power_factor'})}, {sums({'total_energy_generated_mwh': 'energy_generated_mwh',
    'total_energy_consumed_mwh': 'energy_consumed_mwh'})}, {FAULTS} AS total_faults,
    count(DISTINCT transformer_id) AS transformer_count, {{sub}} max(risk_score) AS max_risk_score,
    {avgs({'avg_risk_score': 'risk_score'})}, count(*) AS record_count"""
HOURLY_SQL = f"""{sums({'total_power_mw': 'power_mw'})}, {avgs({
    'avg_load_percent': 'load_percent', 'avg_temperature_c': 'temperature_c',
    'avg_energy_generated_mwh': 'energy_generated_mwh', 'avg_energy_consumed_mwh': 'energy_consumed_mwh'})},
    {FAULTS} AS total_faults, count(*) AS record_count, {avgs({'avg_risk_score': 'risk_score'})}"""
DAILY_SQL = f"""{sums({'total_power_mw': 'power_mw'})}, {avgs({
    'avg_load_percent': 'load_percent', 'avg_temperature_c': 'temperature_c'})}, {sums({
    'total_energy_generated_mwh': 'energy_generated_mwh', 'total_energy_consumed_mwh': 'energy_consumed_mwh'})},
    {FAULTS} AS total_faults, count(*) AS record_count, {avgs({'avg_risk_score': 'risk_score'})}"""
ANOMALY_SQL = f"""count(*) AS anomaly_count, {avgs({
    'avg_risk_score': 'risk_score', 'avg_load_percent': 'load_percent', 'avg_temperature_c': 'temperature_c',
    'avg_voltage_kv': 'voltage_kv'})}"""

register("a01_transformer_summary", on_silver(transformer_full("silver", 2, "avg_risk_score")))(gold.transformer_summary)
register("a02_substation_summary", on_silver(
    f"SELECT substation_id, region, {REGION_SQL.format(sub='')} FROM silver GROUP BY 1, 2"))(gold.substation_summary)
register("a03_region_summary", on_silver(
    f"SELECT region, {REGION_SQL.format(sub='count(DISTINCT substation_id) AS substation_count,')} "
    "FROM silver GROUP BY 1"))(gold.region_summary)
register("a04_hourly_summary", on_silver(
    f"""SELECT CAST(hour("timestamp") AS INTEGER) AS hour_of_day, {HOURLY_SQL} FROM silver GROUP BY 1""")
)(gold.hourly_summary)
register("a05_daily_summary", on_silver(
    f"""SELECT CAST("timestamp" AS DATE) AS date, {DAILY_SQL} FROM silver GROUP BY 1"""))(gold.daily_summary)
register("a06_anomaly_summary", on_silver(
    f"SELECT anomaly_type, status, {ANOMALY_SQL} FROM silver WHERE status <> 'Normal' GROUP BY 1, 2")
)(gold.anomaly_summary)
_SEVERITY = avgs({"avg_risk_score": "risk_score", "avg_load_percent": "load_percent", "avg_temperature_c": "temperature_c"})
register("a07_severity_summary", on_silver(
    f"""SELECT status, count(*) AS "count", {_SEVERITY} FROM silver GROUP BY 1"""))(gold.severity_summary)
_CRITICAL = avgs({
    "avg_load_percent": "load_percent", "avg_temperature_c": "temperature_c", "avg_voltage_kv": "voltage_kv",
    "avg_power_factor": "power_factor", "avg_risk_score": "risk_score"})
register("a08_critical_transformers", on_silver(
    f"SELECT {TK}, {_CRITICAL}, max(risk_score) AS max_risk_score, "
    f"count(DISTINCT anomaly_type) AS distinct_anomaly_types, {FAULTS} AS total_faults "
    f"FROM silver WHERE risk_score >= 85 GROUP BY {TK}"))(gold.critical_transformers)
register("a09_dominant_anomaly_type", on_silver(DOMINANT.format(src="silver")))(gold.dominant_anomaly_type)


@register("j01_summary_with_dominant_type", on_silver(
    f"""SELECT transformer_id, n, coalesce(dominant_anomaly_type, 'Normal') AS dominant_anomaly_type
      FROM (SELECT transformer_id, count(*) AS n FROM silver GROUP BY 1)
      LEFT JOIN ({DOMINANT.format(src="silver WHERE_CRIT").replace("silver WHERE_CRIT WHERE", "silver WHERE risk_score >= 97 AND")})
      USING (transformer_id)"""))
def _(df):
    from pyspark.sql import functions as F

    counted = df.groupBy("transformer_id").agg(F.count(F.lit(1)).alias("n"))
    return gold.with_dominant_type(counted, df.filter("risk_score >= 97"))


@register("j01_summary_with_dominant_type_all", on_silver(
    f"""SELECT transformer_id, n, coalesce(dominant_anomaly_type, 'Normal') AS dominant_anomaly_type
      FROM (SELECT transformer_id, count(*) AS n FROM silver GROUP BY 1) LEFT JOIN ({DOMINANT.format(src="silver")}) USING (transformer_id)"""))
def _(df):
    from pyspark.sql import functions as F

    return gold.with_dominant_type(df.groupBy("transformer_id").agg(F.count(F.lit(1)).alias("n")), df)


@register("q11_critical_subset", on_silver(
    "SELECT event_id, transformer_id, risk_score FROM silver WHERE risk_score >= 85"))
def _(df):
    return gold.critical_rows(df).select("event_id", "transformer_id", "risk_score")


@register("t01_severity_order", on_silver("""SELECT status, count(*) AS n, CAST(row_number() OVER (ORDER BY CASE status
      WHEN 'Critical' THEN 1 WHEN 'High Risk' THEN 2 WHEN 'Warning' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END, status) AS INTEGER)
      AS position FROM silver GROUP BY status"""))
def _(df):
    from pyspark.sql import Window, functions as F

    from wattlake.functions.bands import severity_rank

    counted = df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(severity_rank(F.col("status")), "status")
    return counted.withColumn("position", F.row_number().over(order))
