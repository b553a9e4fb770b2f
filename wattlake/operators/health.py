"""Batch health metrics of grid, regions, substations and transformers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.bands import four_band, health_band, load_bucket, temperature_bucket
from wattlake.operators.rollup import avg, distinct, low, peak, rollup, rows, rows_where, total
from wattlake.operators.trends import day_over_previous
from wattlake.schema import NORMAL, STATUSES, SUBSTATION_KEYS, TRANSFORMER_KEYS
from wattlake.session import work_path

RISKY = 50
SAFE_TEMPERATURE_C = 85


def _count_columns(prefix: str, value, names: list[str]):
    return [rows_where(f"{prefix}{n.lower().replace(' ', '_')}", value == n) for n in names]


def grid_health_metrics(df: DataFrame) -> DataFrame:
    """One row over the whole grid; distributions come as structs of counts."""
    measures = [
        rows("total_records"),
        distinct("total_transformers", "transformer_id"),
        distinct("total_substations", "substation_id"),
        distinct("total_regions", "region"),
        *_count_columns("s_", F.col("status"), STATUSES),
        total("total_faults", "fault_indicator"),
        avg("avg_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"),
        avg("avg_voltage_kv", "voltage_kv"),
        avg("avg_power_factor", "power_factor"),
        avg("avg_risk_score", "risk_score"),
        avg("avg_anomaly_score", "anomaly_score"),
        peak("max_load_percent", "load_percent"),
        peak("max_temperature_c", "temperature_c"),
        peak("max_risk_score", "risk_score"),
        total("total_energy_generated_mwh", "energy_generated_mwh"),
        total("total_energy_consumed_mwh", "energy_consumed_mwh"),
        avg("avg_efficiency", "transmission_efficiency" if "transmission_efficiency" in df.columns else F.lit(0.0)),
        total("anomaly_count", F.col("anomaly_flag") if "anomaly_flag" in df.columns
              else (F.col("risk_score") > RISKY).cast("int")),
        avg("avg_latency_ms", "communication_latency_ms"),
        peak("max_latency_ms", "communication_latency_ms"),
        *_count_columns("l_", load_bucket(F.col("load_percent")), ["low", "medium", "high", "critical"]),
        *_count_columns("t_", temperature_bucket(F.col("temperature_c")), ["normal", "elevated", "high", "critical"]),
        peak("latest_timestamp", "timestamp"),
        low("time_range_start", "timestamp"),
    ]
    facts = rollup(df, [], measures)
    facts = facts.crossJoin(F.broadcast(day_over_previous(df)))
    n = F.col("total_records")

    def percent(c: str):
        return F.coalesce(F.try_divide(F.col(c).cast("double"), n) * 100.0, F.lit(0.0))

    def counts(prefix: str, names: list[str]):
        tags = [x.lower().replace(" ", "_") for x in names]
        return F.struct(*[F.col(f"{prefix}{t}").alias(t) for t in tags])

    return facts.select(
        "total_records", "total_transformers", "total_substations", "total_regions",
        counts("s_", STATUSES).alias("status_distribution"),
        percent("s_normal").alias("health_percentage"),
        "total_faults", percent("total_faults").alias("fault_rate"),
        "avg_load_percent", "avg_temperature_c", "avg_voltage_kv", "avg_power_factor", "avg_risk_score",
        "avg_anomaly_score", "max_load_percent", "max_temperature_c", "max_risk_score",
        "total_energy_generated_mwh", "total_energy_consumed_mwh", "avg_efficiency",
        "anomaly_count", percent("anomaly_count").alias("anomaly_rate"),
        "avg_latency_ms", "max_latency_ms",
        counts("l_", ["low", "medium", "high", "critical"]).alias("load_distribution"),
        counts("t_", ["normal", "elevated", "high", "critical"]).alias("temperature_distribution"),
        "load_trend", "temp_trend", "risk_trend", "latest_timestamp", "time_range_start",
    )


def _status_counts(names: list[str]):
    return [
        F.count_if(F.col("status") == s).alias(f"{s.lower().replace(' ', '_')}_count") for s in names
    ]


def transformer_health(df: DataFrame) -> DataFrame:
    """35 aggregates per transformer and four partial scores adding up to 0-100.

    Partial scores compare with the highest fault count and deviations of all
    transformers.  The per-transformer table (a row each) is written to the shared folder
    when this is called, so the readings are grouped once and both uses read that table.
    """
    c = F.col
    per = df.groupBy(*TRANSFORMER_KEYS).agg(
        F.count("event_id").alias("record_count"),
        F.avg("load_percent").alias("avg_load_percent"), F.max("load_percent").alias("max_load_percent"),
        F.min("load_percent").alias("min_load_percent"), F.stddev_samp("load_percent").alias("load_std"),
        F.avg("temperature_c").alias("avg_temperature_c"), F.max("temperature_c").alias("max_temperature_c"),
        F.stddev_samp("temperature_c").alias("temp_std"),
        F.avg("voltage_kv").alias("avg_voltage_kv"), F.stddev_samp("voltage_kv").alias("voltage_std"),
        F.min("voltage_kv").alias("min_voltage_kv"), F.max("voltage_kv").alias("max_voltage_kv"),
        F.avg("frequency_hz").alias("avg_frequency_hz"), F.stddev_samp("frequency_hz").alias("freq_std"),
        F.avg("power_factor").alias("avg_power_factor"), F.min("power_factor").alias("min_power_factor"),
        F.avg("power_mw").alias("avg_power_mw"),
        F.sum("energy_generated_mwh").alias("total_energy_generated"),
        F.sum("energy_consumed_mwh").alias("total_energy_consumed"),
        F.avg("risk_score").alias("avg_risk_score"), F.max("risk_score").alias("max_risk_score"),
        F.stddev_samp("risk_score").alias("risk_std"),
        F.avg("anomaly_score").alias("avg_anomaly_score"), F.max("anomaly_score").alias("max_anomaly_score"),
        F.count_if(c("risk_score") > RISKY).alias("anomaly_count"),
        F.sum("fault_indicator").alias("fault_count"),
        F.avg("communication_latency_ms").alias("avg_latency_ms"),
        F.max("communication_latency_ms").alias("max_latency_ms"),
        *_status_counts(["Normal", "Warning", "High Risk", "Critical"]),
        F.count_distinct(F.when(c("anomaly_type") != NORMAL, c("anomaly_type"))).alias("distinct_anomaly_types"),
        F.max("timestamp").alias("last_seen"), F.min("timestamp").alias("first_seen"),
    )
    spark, per = df.sparkSession, per.na.fill(0)
    path = work_path(spark, "transformer-health", uuid.uuid4().hex)
    per.write.parquet(path)
    per = spark.read.schema(per.schema).parquet(path)
    tops = per.agg(
        F.max("fault_count").alias("_faults"), F.max("voltage_std").alias("_vstd"), F.max("freq_std").alias("_fstd")
    )
    scored = per.crossJoin(F.broadcast(tops))

    def against(value: str, top: str):
        """25 for the steadiest; when nobody varies the term is 0."""
        return F.when(c(top) > 0, (F.lit(1.0) - F.try_divide(c(value), c(top))) * 25.0).otherwise(0.0)

    reliability = F.when(
        c("_faults") > 0, (F.lit(1.0) - F.try_divide(c("fault_count").cast("double"), c("_faults"))) * 25.0
    ).otherwise(25.0)
    efficiency = (c("avg_power_factor") - 0.7) * 25.0 / 0.3
    safety = (
        (F.lit(1.0) - c("max_temperature_c") / SAFE_TEMPERATURE_C) * 25.0
        + (F.lit(1.0) - c("max_risk_score") / 100.0) * 25.0
    ) / 2.0
    scored = scored.withColumns(
        {
            "reliability_score": reliability,
            "stability_score": (against("voltage_std", "_vstd") + against("freq_std", "_fstd")) / 2.0,
            "efficiency_score": F.least(F.greatest(efficiency, F.lit(0.0)), F.lit(25.0)),
            "safety_score": safety,
        }
    )
    together = c("reliability_score") + c("stability_score") + c("efficiency_score") + c("safety_score")
    return (
        scored.withColumn("health_score", F.least(F.greatest(together, F.lit(0.0)), F.lit(100.0)))
        .withColumn("health_status", health_band(c("health_score")))
        .drop("_faults", "_vstd", "_fstd")
        .orderBy(F.desc("health_score"), "transformer_id")
    )


def _place_measures():
    return [
        rows("record_count"),
        avg("avg_load_percent", "load_percent"), peak("max_load_percent", "load_percent"),
        avg("avg_temperature_c", "temperature_c"), peak("max_temperature_c", "temperature_c"),
        avg("avg_voltage_kv", "voltage_kv"), avg("avg_power_factor", "power_factor"),
        avg("avg_risk_score", "risk_score"), peak("max_risk_score", "risk_score"),
    ]


def _place_counts(fault_alias: str):
    return [
        total(fault_alias, "fault_indicator"),
        rows_where("anomaly_count", F.col("risk_score") > RISKY),
        *[rows_where(f"{s.lower().replace(' ', '_')}_count", F.col("status") == s)
          for s in ("Normal", "Warning", "High Risk", "Critical")],
    ]


def substation_health(df: DataFrame) -> DataFrame:
    measures = [distinct("transformer_count", "transformer_id"), *_place_measures(), *_place_counts("fault_count"),
                total("total_energy_generated", "energy_generated_mwh"),
                total("total_energy_consumed", "energy_consumed_mwh")]
    grouped = rollup(df, SUBSTATION_KEYS, measures).na.fill(0)
    return grouped.withColumn("health_status", four_band(F.col("max_risk_score"))).orderBy(
        F.desc("max_risk_score"), *SUBSTATION_KEYS
    )


def region_health(df: DataFrame) -> DataFrame:
    efficiency = "transmission_efficiency" if "transmission_efficiency" in df.columns else F.lit(0.0)
    measures = [distinct("substation_count", "substation_id"), distinct("transformer_count", "transformer_id"),
                *_place_measures(), *_place_counts("total_faults"),
                total("total_generation", "energy_generated_mwh"),
                total("total_consumption", "energy_consumed_mwh"), avg("avg_efficiency", efficiency)]
    grouped = rollup(df, ["region"], measures).na.fill(0)
    return grouped.withColumns(
        {
            "health_status": four_band(F.col("max_risk_score")),
            "health_percentage": F.col("normal_count") / F.col("record_count") * 100.0,
        }
    ).orderBy(F.desc("avg_risk_score"), "region")


def health_extremes(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` healthiest and the ``n`` most stressed transformers, ranked within each group."""
    scored = transformer_health(df).select(
        "transformer_id", "health_score", "avg_load_percent", "avg_temperature_c", "fault_count"
    )
    best = scored.orderBy(F.desc("health_score"), "transformer_id").limit(n)
    worst = scored.orderBy("health_score", F.desc("transformer_id")).limit(n)
    return best.withColumn("extreme", F.lit("healthiest")).unionByName(worst.withColumn("extreme", F.lit("most stressed")))


def health_score_distribution(df: DataFrame) -> DataFrame:
    """Transformers per score range; open at 80, 60 and 40 from above."""
    score = F.col("health_score")
    label = F.when(score >= 80, "Good").when(score >= 60, "Fair").when(score >= 40, "Poor").otherwise("Critical")
    return transformer_health(df).groupBy(label.alias("health_range")).agg(F.count(F.lit(1)).alias("transformers"))
