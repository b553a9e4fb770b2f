"""Layer exports, loading and the report bundle."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import ORACLE, on_silver, register, rs, selection, silver, work
from catalog.gold import _SEVERITY, FAULTS
from catalog.health import spread_metrics
from wattlake.operators import gold, health
from wattlake.operators.filters import FilterSpec
from wattlake.plans import report
from wattlake.sources import layers

_BUILT: set[tuple[str, str]] = set()
_SEV = f"""SELECT status, count(*) AS "count", {_SEVERITY} FROM silver GROUP BY 1"""


def gold_folder(spark, sf_dir):
    """Gold tables and CSV copies, written once per application."""
    folder = work(spark, sf_dir, "gold")
    key = (spark.sparkContext.applicationId, folder)
    if key not in _BUILT:
        report.build_gold(silver(spark, sf_dir), folder, f"{folder}_csv")
        _BUILT.add(key)
    return folder


@register("s06_export_csv", on_silver(_SEV), source="none")
def _(spark, sf_dir):
    folder = gold_folder(spark, sf_dir)
    schema = spark.read.parquet(f"{folder}/severity_summary").schema
    return spark.read.schema(schema).option("header", True).csv(f"{folder}_csv/severity_summary")


# every table of the export and of the written layer, whole
for _table in gold.GOLD_TABLES:
    _twin = next(sql for name, sql in ORACLE.items() if name.startswith("a0") and name.endswith(f"_{_table}"))

    @register(f"s06_exported_{_table}", _twin, source="none")
    def _(spark, sf_dir, table=_table):
        folder = gold_folder(spark, sf_dir)
        schema = spark.read.parquet(f"{folder}/{table}").schema
        return spark.read.schema(schema).option("header", True).csv(f"{folder}_csv/{table}")

    @register(f"s13_loaded_{_table}", _twin, source="none")
    def _(spark, sf_dir, table=_table):
        return layers.load_summary(spark, gold_folder(spark, sf_dir), table)


@register("s10_load_silver", on_silver("SELECT event_id, voltage_deviation_kv, frequency_deviation_hz, anomaly_flag FROM silver"),
          source="none")
def _(spark, sf_dir):
    """The first candidate does not exist; the second lacks the derived columns."""
    path = work(spark, sf_dir, "bare_silver")
    bare = silver(spark, sf_dir).drop("voltage_deviation_kv", "frequency_deviation_hz", "anomaly_flag")
    bare.write.mode("overwrite").parquet(path)
    loaded = layers.load_silver(spark, [work(spark, sf_dir, "no_such_table"), path])
    return loaded.select("event_id", "voltage_deviation_kv", "frequency_deviation_hz", "anomaly_flag")


@register("s12_write_health_json", on_silver(f"""SELECT count(*) AS total_records, {FAULTS} AS total_faults,
    {rs('avg(risk_score)', 4)} AS avg_risk_score FROM silver"""), source="none", digits=4)
def _(spark, sf_dir):
    path = work(spark, sf_dir, "health_json")
    metrics = health.grid_health_metrics(silver(spark, sf_dir))
    layers.write_json(metrics, path)
    return spark.read.schema("total_records bigint, total_faults bigint, avg_risk_score double").json(path)


@register("s12_written_health_json_whole", ORACLE["a19_grid_health_metrics"], source="none", digits=4)
def _(spark, sf_dir):
    path = work(spark, sf_dir, "health_json_whole")
    metrics = health.grid_health_metrics(silver(spark, sf_dir))
    layers.write_json(metrics, path)
    return spread_metrics(spark.read.schema(metrics.schema).json(path))


@register("s13_load_summary", on_silver(_SEV), source="none")
def _(spark, sf_dir):
    return layers.load_summary(spark, gold_folder(spark, sf_dir), "severity_summary")


@register("s13_data_status", on_silver("""SELECT 'region_summary' AS table_name, TRUE AS available,
    count(DISTINCT region) AS record_count, TRUE AS has_update FROM silver UNION ALL
    SELECT 'hourly_summary', TRUE, count(DISTINCT hour("timestamp")), TRUE FROM silver UNION ALL
    SELECT 'forecast_summary', FALSE, 0, FALSE"""), source="none")
def _(spark, sf_dir):
    status = layers.data_status(
        spark, gold_folder(spark, sf_dir), ["region_summary", "hourly_summary", "forecast_summary"])
    return status.withColumn("has_update", F.col("last_update").isNotNull()).drop("last_update")


@register("s07_gold_counts", on_silver("""SELECT 'transformer_summary' AS layer, count(DISTINCT transformer_id) AS record_count
    FROM silver UNION ALL SELECT 'daily_summary', count(DISTINCT CAST("timestamp" AS DATE)) FROM silver UNION ALL
    SELECT 'critical_transformers', count(DISTINCT transformer_id) FROM silver WHERE risk_score >= 85"""), source="none")
def _(spark, sf_dir):
    folder = gold_folder(spark, sf_dir)
    names = ["transformer_summary", "daily_summary", "critical_transformers"]
    return layers.verify_counts({n: layers.load_summary(spark, folder, n) for n in names})


@register("a49_report_bundle", on_silver("""SELECT 'regions' AS section, count(*) AS record_count FROM sel UNION ALL
    SELECT 'anomalies', count(*) FROM sel WHERE anomaly_flag = 1 UNION ALL SELECT 'energy_by_hour', count(*) FROM sel
    UNION ALL SELECT 'grid_health', count(*) FROM sel UNION ALL SELECT 'summary', count(*) FROM sel""",
    selection("region = 'EUROPE'", 168)), source="none")
def _(spark, sf_dir):
    """Rows each section accounts for; the sections are written so the shared rows can be released."""
    folder = work(spark, sf_dir, "report")
    with report.report_bundle(silver(spark, sf_dir), FilterSpec(region="EUROPE", time_range="7d")) as sections:
        for name, frame in sections.items():
            frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
    read = {n: spark.read.parquet(f"{folder}/{n}") for n in ("regions", "anomalies", "energy_by_hour", "grid_health",
                                                            "summary")}
    health_rows = sum((F.col(f"{s}_count") for s in ("low", "warning", "high_risk", "critical")), F.col("normal_count"))
    counted = [
        read["regions"].agg(F.sum("record_count").alias("n")), read["anomalies"].agg(F.sum("anomaly_count").alias("n")),
        read["energy_by_hour"].agg(F.sum("record_count").alias("n")), read["grid_health"].select(health_rows.alias("n")),
        read["summary"].select(F.col("records_today").alias("n")),
    ]
    out = None
    for name, frame in zip(read, counted):
        part = frame.select(F.lit(name).alias("section"), F.col("n").cast("bigint").alias("record_count"))
        out = part if out is None else out.unionByName(part)
    return out
