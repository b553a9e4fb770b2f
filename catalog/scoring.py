"""Scores, bands and labels on every silver row."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import NINE, band, composite, df as fdev, dv, hash32, measured_score, on_clean, pick
from catalog.base import register, rh, type_rules
from wattlake.functions import bands, labels, scoring


def _steps(expr, points, op=">"):
    return "CASE " + " ".join(f"WHEN {expr} {op} {b} THEN {p}" for b, p in points) + " ELSE 0 END"


COMPONENT_SQL = {
    "load_risk_score": _steps("load_percent", [(90, 20), (80, 15), (70, 10), (60, 5)]),
    "temperature_risk_score": _steps("temperature_c", [(75, 20), (70, 15), (65, 10), (60, 5)]),
    "voltage_risk_score": _steps(dv("voltage_kv"), [(4, 15), (3, 12), (2, 8), (1, 4)]),
    "frequency_risk_score": _steps(fdev("frequency_hz"), [("3e-1", 10), ("2e-1", 7), ("15e-2", 5), ("1e-1", 2)]),
    "power_factor_risk_score": _steps(
        "power_factor", [("7e-1", 10), ("75e-2", 7), ("8e-1", 5), ("85e-2", 2)], "<"),
    "fault_risk_score": "CASE WHEN fault_indicator = 1 THEN 15 ELSE 0 END",
    "anomaly_risk_score": _steps("anomaly_score", [("7e-1", 5), ("5e-1", 3), ("3e-1", 1)]),
    "communication_risk_score": _steps("communication_latency_ms", [(50, 5), (30, 3), (15, 1)]),
}
RULE_SUM = " + ".join(COMPONENT_SQL.values())
_IDS = ["f02a_load", "f02b_temperature", "f02c_voltage", "f02d_frequency", "f02e_power_factor", "f02f_fault",
        "f02g_anomaly", "f02h_latency"]

for _id, (_name, _sql) in zip(_IDS, COMPONENT_SQL.items()):

    @register(f"{_id}_component", on_clean(f"SELECT event_id, {_sql} AS {_name} FROM cleaned"))
    def _(df, name=_name):
        return df.select("event_id", scoring.risk_components(df.columns)[name].alias(name))


@register(
    "f02_rule_risk_score",
    on_clean(f"SELECT event_id, {', '.join(f'{e} AS {n}' for n, e in COMPONENT_SQL.items())}, "
             f"CAST(least({RULE_SUM}, 100) AS INTEGER) AS risk_score FROM cleaned"),
)
def _(df):
    return scoring.with_rule_risk(df).select("event_id", *scoring.COMPONENTS, "risk_score")


@register(
    "f02_rule_risk_score_signed",
    on_clean(f"""SELECT event_id, CAST(least({
        RULE_SUM.replace(dv('voltage_kv'), rh('voltage_kv - 40', 2))
                .replace(fdev('frequency_hz'), rh('frequency_hz - 50', 3))}, 100) AS INTEGER) AS risk_score
        FROM cleaned"""),
)
def _(df):
    return scoring.with_rule_risk(df, signed=True).select("event_id", "risk_score")


@register("f01_risk_band", on_clean(f"SELECT event_id, risk_score, {band('risk_score')} AS risk_band FROM cleaned"))
def _(df):
    return df.select("event_id", "risk_score", bands.risk_band(F.col("risk_score")).alias("risk_band"))


_M = ("load_percent", "temperature_c", "voltage_kv", "frequency_hz")


def _c(*names):
    return [F.col(n) for n in names]


@register(
    "f03_composite_risk",
    on_clean(f"SELECT event_id, {composite(*_M, 'fault_indicator')} AS composite_risk FROM cleaned"),
)
def _(df):
    return df.select("event_id", scoring.composite_risk(*_c(*_M, "fault_indicator")).alias("composite_risk"))


@register(
    "f04_measurement_anomaly_score",
    on_clean(f"SELECT event_id, {measured_score(*_M, 'power_factor', 'fault_indicator')} AS score FROM cleaned"),
)
def _(df):
    return df.select(
        "event_id", scoring.measurement_anomaly_score(*_c(*_M, "power_factor", "fault_indicator")).alias("score")
    )


_RULE_ARGS = (*_M, "power_factor", "communication_latency_ms", "fault_indicator", "event_id")


@register(
    "f05_anomaly_type_rules",
    on_clean(f"SELECT event_id, {type_rules(*_RULE_ARGS)} AS rule_type FROM cleaned"),
)
def _(df):
    return df.select("event_id", labels.anomaly_type_rules(*_c(*_RULE_ARGS)).alias("rule_type"))


_TYPES = NINE + ["Compound Anomaly"]
_SEVERE = (f"(CAST(load_percent > 90 AS INT) + CAST(temperature_c > 75 AS INT) + CAST({dv('voltage_kv')} > 4 AS INT)"
           f" + CAST({fdev('frequency_hz')} > 3e-1 AS INT) + CAST(fault_indicator = 1 AS INT))")
_WEIGHTS = {
    "Transformer Fault": "CASE WHEN fault_indicator = 1 AND (load_percent > 82 OR temperature_c > 68) THEN 30 "
                         "WHEN fault_indicator = 1 THEN 10 ELSE 0 END",
    "Overload": "CASE WHEN load_percent > 82 THEN 25 ELSE 0 END",
    "Temperature Spike": "CASE WHEN temperature_c > 68 THEN 20 ELSE 0 END",
    "Voltage Fluctuation": f"CASE WHEN {dv('voltage_kv')} > 35e-1 THEN 22 ELSE 0 END",
    "Frequency Deviation": f"CASE WHEN {fdev('frequency_hz')} > 25e-2 THEN 18 ELSE 0 END",
    "Power Factor Anomaly": "CASE WHEN power_factor < 78e-2 THEN 15 ELSE 0 END",
    "Communication Failure": "CASE WHEN communication_latency_ms > 45 THEN 20 ELSE 0 END",
    "Unexpected Consumption": "CASE WHEN energy_consumed_mwh > 0 AND energy_generated_mwh > 0 AND "
                              "energy_consumed_mwh / greatest(energy_generated_mwh, 1) > 125e-2 THEN 15 ELSE 0 END",
    "Generation Drop": "CASE WHEN energy_generated_mwh > 0 AND energy_generated_mwh < 80 THEN 12 ELSE 0 END",
    "Compound Anomaly": f"CASE WHEN {_SEVERE} >= 2 THEN 25 ELSE 0 END",
}
_ORDERED = list(_WEIGHTS)
_W = [f"w{i}" for i in range(10)]
_FALL = [12, 12, 12, 10, 10, 10, 10, 9, 8, 7]


def _walk(names, weights, total):
    cases, upto = [], []
    for name, weight in zip(names, weights):
        upto.append(str(weight))
        cases.append(f"WHEN h % {total} < {' + '.join(upto)} THEN '{name}'")
    return "CASE " + " ".join(cases) + " END"


@register(
    "f06_anomaly_type_weighted",
    on_clean(f"""SELECT event_id, CASE WHEN severe >= 3 THEN 'Compound Anomaly'
      WHEN {' + '.join(_W)} = 0 THEN {_walk(_TYPES, _FALL, 100)}
      ELSE {_walk(_ORDERED, _W, 'nullif(' + ' + '.join(_W) + ', 0)')} END AS weighted_type
      FROM (SELECT event_id, {hash32('event_id')} AS h, {_SEVERE} AS severe,
        {', '.join(f'{e} AS w{i}' for i, e in enumerate(_WEIGHTS.values()))} FROM cleaned)"""),
)
def _(df):
    return labels.with_weighted_type(df, "weighted_type").select("event_id", "weighted_type")


STREAM_RISK = rh("least(anomaly_score * 40 + greatest(load_percent - 70, 0) * 3e-1 "
                 "+ greatest(temperature_c - 55, 0) * 2e-1 + CASE WHEN fault_indicator = 1 THEN 25 ELSE 0 END, 100)", 2)


def stream_status_sql(risk: str) -> str:
    return (f"CASE WHEN fault_indicator = 1 OR {risk} >= 70 THEN 'Critical' WHEN {risk} >= 50 OR anomaly_score >= 6e-1 "
            f"THEN 'High Risk' WHEN {risk} >= 25 OR anomaly_score >= 2e-1 THEN 'Warning' ELSE 'Normal' END")


def _stream_risk():
    return scoring.stream_risk(*_c("anomaly_score", "load_percent", "temperature_c", "fault_indicator"))


@register("f07_stream_risk", on_clean(f"SELECT event_id, {STREAM_RISK} AS stream_risk FROM cleaned"))
def _(df):
    return df.select("event_id", _stream_risk().alias("stream_risk"))


@register(
    "f08_stream_status", on_clean(f"SELECT event_id, {stream_status_sql(STREAM_RISK)} AS stream_status FROM cleaned")
)
def _(df):
    return df.select("event_id", labels.stream_status(
        _stream_risk(), F.col("anomaly_score"), F.col("fault_indicator")).alias("stream_status"))


LIVE_RISK = "(" + " + ".join([
    _steps("load_percent", [(90, 20), (80, 15), (70, 10)]), _steps("temperature_c", [(75, 20), (70, 15), (65, 10)]),
    _steps(dv("voltage_kv"), [(4, 15), (3, 12)]), "CASE WHEN fault_indicator = 1 THEN 15 ELSE 0 END"]) + ")"
LIVE_STATUS = "CASE WHEN r >= 70 THEN 'Critical' WHEN r >= 50 THEN 'High Risk' WHEN r >= 25 THEN 'Warning' ELSE 'Normal' END"
LIVE_TYPE = f"""CASE WHEN s = 'Normal' THEN 'Normal' WHEN load_percent > 90 AND temperature_c > 70 THEN 'Compound Anomaly'
    WHEN load_percent > 90 THEN 'Overload' WHEN temperature_c > 65 THEN 'Temperature Spike'
    WHEN {dv('voltage_kv')} > 4 THEN 'Voltage Fluctuation' WHEN {fdev('frequency_hz')} > 25e-2 THEN 'Frequency Deviation'
    WHEN power_factor < 75e-2 THEN 'Power Factor Anomaly' ELSE {pick('event_id', [
        "Voltage Fluctuation", "Overload", "Temperature Spike", "Frequency Deviation", "Power Factor Anomaly"])} END"""


def _live_risk():
    return scoring.live_risk(*_c("load_percent", "temperature_c", "voltage_kv", "fault_indicator"))


@register("f09_live_risk", on_clean(f"SELECT event_id, {LIVE_RISK} AS live_risk FROM cleaned"))
def _(df):
    return df.select("event_id", _live_risk().alias("live_risk"))


@register(
    "f10_live_status",
    on_clean(f"SELECT event_id, {LIVE_STATUS} AS live_status FROM (SELECT event_id, {LIVE_RISK} AS r FROM cleaned)"),
)
def _(df):
    return df.select("event_id", labels.live_status(_live_risk()).alias("live_status"))


LIVE_FROM = (f"(SELECT *, {LIVE_STATUS} AS s FROM (SELECT *, {LIVE_RISK} AS r FROM cleaned))")


def with_live(df):
    live = df.withColumn("r", _live_risk()).withColumn("s", labels.live_status(F.col("r")))
    return live.withColumn("t", labels.live_anomaly_type(
        *_c("s", "load_percent", "temperature_c", "voltage_kv", "frequency_hz", "power_factor", "event_id")))


@register("f11_live_anomaly_type", on_clean(f"SELECT event_id, {LIVE_TYPE} AS live_type FROM {LIVE_FROM}"))
def _(df):
    return with_live(df).select("event_id", F.col("t").alias("live_type"))


LIVE_MESSAGE = """CASE s WHEN 'Critical' THEN '⚠ Critical: ' || t || ' at ' || substation_id
    WHEN 'High Risk' THEN 'High Risk: ' || t || ' at ' || substation_id
    WHEN 'Warning' THEN 'Warning: ' || t || ' at ' || substation_id ELSE 'Normal operation at ' || region END"""


@register(
    "f12_live_message",
    on_clean(f"SELECT event_id, {LIVE_MESSAGE} AS message FROM (SELECT *, {LIVE_TYPE} AS t FROM {LIVE_FROM})"),
)
def _(df):
    return with_live(df).select(
        "event_id", labels.live_message(*_c("s", "t", "substation_id", "region")).alias("message"))


_PRODUCER = ["Overload", "Temperature Spike", "Voltage Fluctuation", "Frequency Deviation", "Power Factor Anomaly",
             "Transformer Fault", "Compound Anomaly"]


@register(
    "f13_producer_status_and_type",
    on_clean(f"""SELECT event_id, s AS producer_status, CASE WHEN s = 'Normal' THEN 'Normal'
      WHEN load_percent > 90 THEN CASE WHEN temperature_c < 65 THEN 'Overload' ELSE 'Compound Anomaly' END
      WHEN temperature_c > 65 THEN 'Temperature Spike' WHEN {dv('voltage_kv')} > 4 THEN 'Voltage Fluctuation'
      ELSE {pick('event_id', _PRODUCER)} END AS producer_type
      FROM (SELECT *, CASE WHEN anomaly_score > 7e-1 OR fault_indicator = 1 THEN
        CASE WHEN load_percent > 90 OR temperature_c > 75 THEN 'Critical' WHEN anomaly_score > 5e-1 THEN 'High Risk'
        ELSE 'Warning' END WHEN load_percent > 75 OR temperature_c > 55 THEN 'Warning' ELSE 'Normal' END AS s
        FROM cleaned)"""),
)
def _(df):
    marked = df.withColumn("s", labels.producer_status(
        *_c("anomaly_score", "load_percent", "temperature_c", "fault_indicator")))
    return marked.select("event_id", F.col("s").alias("producer_status"), labels.producer_anomaly_type(
        *_c("s", "load_percent", "temperature_c", "voltage_kv", "event_id")).alias("producer_type"))


@register(
    "f14_four_band",
    on_clean("""SELECT event_id, CASE WHEN risk_score >= 85 THEN 'Critical' WHEN risk_score >= 70 THEN 'High Risk'
      WHEN risk_score >= 50 THEN 'Warning' ELSE 'Normal' END AS four_band FROM cleaned"""),
)
def _(df):
    return df.select("event_id", bands.four_band(F.col("risk_score")).alias("four_band"))


@register(
    "f15_map_status",
    on_clean("""SELECT event_id, CASE WHEN risk_score >= 85 THEN 'Critical'
      WHEN risk_score >= 70 OR load_percent >= 80 THEN 'High Load' ELSE 'Normal' END AS map_status FROM cleaned"""),
)
def _(df):
    return df.select("event_id", bands.map_status(F.col("risk_score"), F.col("load_percent")).alias("map_status"))


@register(
    "f16_health_band",
    on_clean("""SELECT event_id, CASE WHEN h > 0 AND h <= 40 THEN 'Critical' WHEN h > 40 AND h <= 60 THEN 'Poor'
      WHEN h > 60 AND h <= 80 THEN 'Fair' WHEN h > 80 AND h <= 100 THEN 'Good' END AS health_band
      FROM (SELECT event_id, 100 - risk_score AS h FROM cleaned)"""),
)
def _(df):
    return df.select("event_id", bands.health_band(F.lit(100) - F.col("risk_score")).alias("health_band"))


@register(
    "f17_grid_health_label",
    on_clean("""SELECT event_id, CASE WHEN h >= 80 THEN 'Excellent' WHEN h >= 65 THEN 'Healthy' WHEN h >= 50
      THEN 'Warning' ELSE 'Critical' END AS label FROM (SELECT event_id, 100 - risk_score AS h FROM cleaned)"""),
)
def _(df):
    return df.select("event_id", bands.grid_health_label(F.lit(100) - F.col("risk_score")).alias("label"))


EVENT_SQL = """CASE anomaly_type WHEN 'Overload' THEN 'High load detected at'
    WHEN 'Temperature Spike' THEN 'Transformer temperature rising at' WHEN 'Voltage Fluctuation' THEN 'Voltage fluctuation at'
    WHEN 'Frequency Deviation' THEN 'Frequency deviation at' WHEN 'Power Factor Anomaly' THEN 'Power factor anomaly at'
    WHEN 'Transformer Fault' THEN 'Transformer fault at' WHEN 'Communication Failure' THEN 'Communication failure at'
    ELSE anomaly_type || ' at' END || ' ' || substation_id"""


@register("f18_event_description", on_clean(f"SELECT event_id, {EVENT_SQL} AS description FROM cleaned"))
def _(df):
    return df.select("event_id", labels.event_description(*_c("anomaly_type", "substation_id")).alias("description"))


@register(
    "f19_load_bucket",
    on_clean("""SELECT event_id, CASE WHEN load_percent < 30 THEN 'low' WHEN load_percent < 60 THEN 'medium'
      WHEN load_percent < 85 THEN 'high' ELSE 'critical' END AS load_bucket FROM cleaned"""),
)
def _(df):
    return df.select("event_id", bands.load_bucket(F.col("load_percent")).alias("load_bucket"))


@register(
    "f20_temperature_bucket",
    on_clean("""SELECT event_id, CASE WHEN temperature_c < 50 THEN 'normal' WHEN temperature_c < 60 THEN 'elevated'
      WHEN temperature_c < 70 THEN 'high' ELSE 'critical' END AS temperature_bucket FROM cleaned"""),
)
def _(df):
    return df.select("event_id", bands.temperature_bucket(F.col("temperature_c")).alias("temperature_bucket"))


@register(
    "f21_display_tiers",
    on_clean("""SELECT event_id,
      CASE WHEN 100 - risk_score >= 80 THEN 'success' WHEN 100 - risk_score >= 60 THEN 'warning'
        WHEN 100 - risk_score >= 40 THEN 'high_risk' ELSE 'critical' END AS health_tier,
      CASE WHEN load_percent >= 85 THEN 'critical' WHEN load_percent >= 70 THEN 'high_risk'
        WHEN load_percent >= 50 THEN 'warning' ELSE 'success' END AS load_tier,
      CASE WHEN temperature_c >= 70 THEN 'critical' WHEN temperature_c >= 60 THEN 'high_risk'
        WHEN temperature_c >= 50 THEN 'warning' ELSE 'success' END AS temperature_tier,
      CASE WHEN power_factor < 7e-1 THEN 'critical' WHEN power_factor < 8e-1 THEN 'warning' ELSE 'success' END AS pf_tier,
      CASE WHEN risk_score >= 85 THEN 'critical' WHEN risk_score >= 70 THEN 'high_risk'
        WHEN risk_score >= 30 THEN 'warning' ELSE 'success' END AS risk_tier FROM cleaned"""),
)
def _(df):
    return df.select(
        "event_id",
        bands.health_tier(F.lit(100) - F.col("risk_score")).alias("health_tier"),
        bands.load_tier(F.col("load_percent")).alias("load_tier"),
        bands.temperature_tier(F.col("temperature_c")).alias("temperature_tier"),
        bands.power_factor_tier(F.col("power_factor")).alias("pf_tier"),
        bands.risk_tier(F.col("risk_score")).alias("risk_tier"),
    )


PRIORITY = ("CASE status WHEN 'Critical' THEN 4 WHEN 'High Risk' THEN 3 WHEN 'Warning' THEN 2 WHEN 'Low' THEN 1 "
            "ELSE 0 END")


@register("f22_status_priority", on_clean(f"SELECT event_id, status, {PRIORITY} AS priority FROM cleaned"))
def _(df):
    return df.select("event_id", "status", bands.status_priority(F.col("status")).alias("priority"))
