"""Labels: anomaly type, stream and live status, messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.picks import hash32, pick
from wattlake.functions.scoring import frequency_offset, voltage_offset
from wattlake.schema import ANOMALY_TYPES, NORMAL

# --- fixed values -----------------------------------------------------------------------
UNEXPLAINED_TYPES = ANOMALY_TYPES[:9]
LIVE_TYPES = [
    "Voltage Fluctuation", "Overload", "Temperature Spike", "Frequency Deviation", "Power Factor Anomaly",
]
PRODUCER_TYPES = [
    "Overload", "Temperature Spike", "Voltage Fluctuation", "Frequency Deviation", "Power Factor Anomaly",
    "Transformer Fault", "Compound Anomaly",
]
FALLBACK_WEIGHTS = [12, 12, 12, 10, 10, 10, 10, 9, 8, 7]
EVENT_PHRASES = {
    "Overload": "High load detected at",
    "Temperature Spike": "Transformer temperature rising at",
    "Voltage Fluctuation": "Voltage fluctuation at",
    "Frequency Deviation": "Frequency deviation at",
    "Power Factor Anomaly": "Power factor anomaly at",
    "Transformer Fault": "Transformer fault at",
    "Communication Failure": "Communication failure at",
}
# --- end of fixed values ------------------------------------------------------------------


def anomaly_type_rules(
    load: Column, temperature: Column, voltage: Column, frequency: Column,
    pf: Column, latency: Column, fault: Column, key: Column,
) -> Column:
    """First matching rule names the anomaly; unexplained ones get a hash pick."""
    return (
        F.when((load > 90) & (temperature > 70), "Compound Anomaly")
        .when(load > 90, "Overload")
        .when(temperature > 70, "Temperature Spike")
        .when(voltage_offset(voltage) > 4, "Voltage Fluctuation")
        .when(frequency_offset(frequency) > 0.25, "Frequency Deviation")
        .when(pf < 0.75, "Power Factor Anomaly")
        .when(latency > 40, "Communication Failure")
        .when(fault == 1, "Transformer Fault")
        .otherwise(pick(key, UNEXPLAINED_TYPES))
    )


def with_weighted_type(df: DataFrame, alias: str = "anomaly_type") -> DataFrame:
    """Add a weighted choice among the conditions a reading shows.

    Weights and their running sums are plain columns added step by step, so each is
    computed once and inside codegen; the hash of the event id, modulo the total weight,
    falls into exactly one candidate's share.
    """
    c = F.col
    dv, dev = voltage_offset(c("voltage_kv")), frequency_offset(c("frequency_hz"))
    faulty, hot = c("fault_indicator") == 1, (c("load_percent") > 82) | (c("temperature_c") > 68)
    generated, consumed = c("energy_generated_mwh"), c("energy_consumed_mwh")
    surplus = (consumed > 0) & (generated > 0) & (consumed / F.greatest(generated, F.lit(1.0)) > 1.25)
    severe = sum(
        (F.when(x, 1).otherwise(0) for x in (c("load_percent") > 90, c("temperature_c") > 75, dv > 4, dev > 0.3)),
        F.when(faulty, 1).otherwise(0),
    )
    candidates = {
        "Transformer Fault": F.when(faulty & hot, 30).when(faulty, 10),
        "Overload": F.when(c("load_percent") > 82, 25),
        "Temperature Spike": F.when(c("temperature_c") > 68, 20),
        "Voltage Fluctuation": F.when(dv > 3.5, 22),
        "Frequency Deviation": F.when(dev > 0.25, 18),
        "Power Factor Anomaly": F.when(c("power_factor") < 0.78, 15),
        "Communication Failure": F.when(c("communication_latency_ms") > 45, 20),
        "Unexpected Consumption": F.when(surplus, 15),
        "Generation Drop": F.when((generated > 0) & (generated < 80), 12),
        "Compound Anomaly": F.when(c("_severe") >= 2, 25),
    }
    weights = {f"_w{i}": F.coalesce(w, F.lit(0)) for i, w in enumerate(candidates.values())}
    weighed = df.withColumns({"_severe": severe, "_hash": hash32(c("event_id"))}).withColumns(weights)
    last = "0"
    for i in range(len(candidates)):
        weighed = weighed.withColumn(f"_s{i}", c(f"_w{i}") + (c(last) if i else 0))
        last = f"_s{i}"
    weighed = weighed.withColumn("_at", c("_hash") % F.when(c(last) > 0, c(last)).otherwise(sum(FALLBACK_WEIGHTS)))
    chosen = fallback = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(candidates))):
        chosen = F.when(c("_at") < c(f"_s{i}"), name).otherwise(chosen)
    for i, name in reversed(list(enumerate(ANOMALY_TYPES))):
        fallback = F.when(c("_at") < sum(FALLBACK_WEIGHTS[: i + 1]), name).otherwise(fallback)
    kind = F.when(c("_severe") >= 3, "Compound Anomaly").when(c(last) > 0, chosen).otherwise(fallback)
    helpers = [n for n in weighed.columns if n not in df.columns]
    return weighed.withColumn("_kind", kind).drop(*helpers).withColumnRenamed("_kind", alias)


def stream_status(risk: Column, anomaly: Column, fault: Column) -> Column:
    r, a = F.coalesce(risk, F.lit(0.0)), F.coalesce(anomaly, F.lit(0.0))
    return (
        F.when((F.coalesce(fault, F.lit(0)) == 1) | (r >= 70), "Critical")
        .when((r >= 50) | (a >= 0.6), "High Risk")
        .when((r >= 25) | (a >= 0.2), "Warning")
        .otherwise("Normal")
    )


def live_status(risk: Column) -> Column:
    return F.when(risk >= 70, "Critical").when(risk >= 50, "High Risk").when(risk >= 25, "Warning").otherwise("Normal")


def live_anomaly_type(
    status: Column, load: Column, temperature: Column, voltage: Column, frequency: Column, pf: Column, key: Column
) -> Column:
    return (
        F.when(status == NORMAL, NORMAL)
        .when((load > 90) & (temperature > 70), "Compound Anomaly")
        .when(load > 90, "Overload")
        .when(temperature > 65, "Temperature Spike")
        .when(voltage_offset(voltage) > 4, "Voltage Fluctuation")
        .when(frequency_offset(frequency) > 0.25, "Frequency Deviation")
        .when(pf < 0.75, "Power Factor Anomaly")
        .otherwise(pick(key, LIVE_TYPES))
    )


def live_message(status: Column, anomaly_type: Column, substation_id: Column, substation_name: Column) -> Column:
    """Feed text; normal events show the substation's name, alerts its id."""
    where = F.concat(anomaly_type, F.lit(" at "), substation_id)
    return (
        F.when(status == "Critical", F.concat(F.lit("⚠ Critical: "), where))
        .when(status == "High Risk", F.concat(F.lit("High Risk: "), where))
        .when(status == "Warning", F.concat(F.lit("Warning: "), where))
        .when(status == "Normal", F.concat(F.lit("Normal operation at "), substation_name))
        .otherwise("")
    )


def producer_status(anomaly: Column, load: Column, temperature: Column, fault: Column) -> Column:
    return (
        F.when(
            (anomaly > 0.7) | (fault == 1),
            F.when((load > 90) | (temperature > 75), "Critical").when(anomaly > 0.5, "High Risk").otherwise("Warning"),
        )
        .when((load > 75) | (temperature > 55), "Warning")
        .otherwise("Normal")
    )


def producer_anomaly_type(status: Column, load: Column, temperature: Column, voltage: Column, key: Column) -> Column:
    return (
        F.when(status == NORMAL, NORMAL)
        .when(load > 90, F.when(temperature < 65, "Overload").otherwise("Compound Anomaly"))
        .when(temperature > 65, "Temperature Spike")
        .when(voltage_offset(voltage) > 4, "Voltage Fluctuation")
        .otherwise(pick(key, PRODUCER_TYPES))
    )


def event_description(anomaly_type: Column, substation_id: Column) -> Column:
    phrase = F.concat(anomaly_type, F.lit(" at"))
    for name, text in EVENT_PHRASES.items():
        phrase = F.when(anomaly_type == name, text).otherwise(phrase)
    return F.concat(phrase, F.lit(" "), substation_id)
