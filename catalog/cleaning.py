"""Sources, duplicates, gaps, ranges and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import FEATURE_SQL, on_clean, on_distinct, on_raw, on_silver, raw, register, rs, silver
from catalog.base import IMPUTED_CTES, stage, work
from wattlake.operators import cleaning
from wattlake.operators.quantiles import exact_quantiles
from wattlake.plans import batch
from wattlake.schema import IMPUTED_COLUMNS, TELEMETRY_COLUMNS, TELEMETRY_SCHEMA
from wattlake.sources import layers, raw as raw_source

_T = ", ".join(f'"{c}"' if c == "timestamp" else c for c in TELEMETRY_COLUMNS)


@register("s01_read_raw", on_raw(f"SELECT {_T} FROM raw"), source="none")
def _(spark, sf_dir):
    path = work(spark, sf_dir, "raw_csv")
    raw_source.write_raw(raw(spark, sf_dir), path)
    return raw_source.parse_timestamp(raw_source.read_raw(spark, path))


_GONE = ("latitude", "anomaly_type")


@register(
    "s02_validate_schema",
    on_raw(" UNION ALL ".join(
        [f"""SELECT '{c}' AS column_name, 'present' AS state, count("{c}") AS filled FROM raw"""
         for c in TELEMETRY_COLUMNS if c not in _GONE]
        + [f"SELECT '{c}', 'missing', CAST(NULL AS BIGINT)" for c in _GONE]
        + ["SELECT 'feeder', 'extra', count(*) FROM raw"])),
    source="raw",
)
def _(df):
    return raw_source.validate_schema(
        df.drop("latitude", "anomaly_type").withColumn("feeder", F.lit("A")), TELEMETRY_SCHEMA
    )


@register(
    "s03_parse_timestamp",
    on_raw("""SELECT event_id, CAST("timestamp" AS VARCHAR) AS text, "timestamp" AS parsed FROM raw"""),
    source="raw",
)
def _(df):
    text = df.select("event_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.withColumn("parsed", raw_source.to_timestamp_lenient(F.col("text")))


@register(
    "s04_add_ingestion_metadata",
    on_raw("""SELECT event_id, "timestamp", transformer_id, 'batch_001' AS ingestion_batch, TRUE AS has_ingestion_time
      FROM raw"""),
    source="raw",
)
def _(df):
    return batch.add_ingestion_metadata(df).select(
        "event_id", "timestamp", "transformer_id", "ingestion_batch",
        F.col("ingestion_time").isNotNull().alias("has_ingestion_time"),
    )


@register(
    "s05_write_layer",
    on_silver("""SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS n, """
              + rs("sum(power_mw)", 4) + " AS power_mw FROM silver GROUP BY 1"),
    source="none", digits=4,
)
def _(spark, sf_dir):
    path = work(spark, sf_dir, "layer_copy")
    batch.write_layer(silver(spark, sf_dir), path, batch.PARTITION_COLUMN)
    return batch.read_silver(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("power_mw").alias("power_mw"))


@register(
    "s07_verify_counts",
    on_silver("""SELECT 'stage' AS layer, (SELECT count(*) FROM distinct_rows) AS record_count
      UNION ALL SELECT 'silver', (SELECT count(*) FROM silver)
      UNION ALL SELECT 'raw', (SELECT count(*) FROM lineitem)"""),
    source="none",
)
def _(spark, sf_dir):
    return layers.verify_counts(
        {"raw": raw(spark, sf_dir), "stage": stage(spark, sf_dir), "silver": silver(spark, sf_dir)})


@register("p01_dedup", on_distinct(f"SELECT {_T} FROM distinct_rows"), source="raw")
def _(df):
    return cleaning.dedup(df)


register("w01_rank_of_every_copy", on_raw("""SELECT event_id, "timestamp", transformer_id, power_mw, row_number() OVER (
    PARTITION BY event_id ORDER BY "timestamp" NULLS LAST, transformer_id NULLS LAST, power_mw NULLS LAST) AS copy_rank
    FROM raw"""), source="raw")(
    lambda df: cleaning.rank_copies(df.select("event_id", "timestamp", "transformer_id", "power_mw")))


@register("w01_dedup_ranking", on_distinct("""SELECT event_id, "timestamp", transformer_id, power_mw
    FROM distinct_rows"""), source="raw")
def _(df):
    return cleaning.dedup(df.select("event_id", "timestamp", "transformer_id", "power_mw"))


@register(
    "p01_dedup_report",
    on_raw("""SELECT count(*) AS records_before, count(DISTINCT event_id) AS records_kept,
      count(*) - count(DISTINCT event_id) AS duplicates_removed FROM raw"""),
    source="raw",
)
def _(df):
    return cleaning.dedup_report(df)


@register("p02_impute_median", f"WITH {IMPUTED_CTES}\nSELECT {_T} FROM imputed", source="none")
def _(spark, sf_dir):
    return cleaning.impute_median(stage(spark, sf_dir))


@register(
    "p02_exact_medians",
    on_distinct("SELECT " + ", ".join(f"median({c}) AS {c}" for c in IMPUTED_COLUMNS) + " FROM distinct_rows"),
    source="none",
)
def _(spark, sf_dir):
    return exact_quantiles(stage(spark, sf_dir), IMPUTED_COLUMNS)


@register(
    "p03_fill_defaults",
    on_distinct("""SELECT event_id, coalesce(status, 'Normal') AS status,
      coalesce(anomaly_type, 'Normal') AS anomaly_type, coalesce(fault_indicator, 0) AS fault_indicator
      FROM distinct_rows"""),
    source="raw",
)
def _(df):
    return cleaning.fill_defaults(cleaning.dedup(df)).select("event_id", "status", "anomaly_type", "fault_indicator")


def _clip_sql(ranges):
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN CAST(least(greatest({c}, {lo}), {hi}) AS DOUBLE) END AS {c}"
        for c, (lo, hi) in ranges.items()
    )


_DEFAULT = {"voltage_kv": ("28", "52"), "frequency_hz": ("492e-1", "508e-1"), "load_percent": ("0", "100"),
            "power_factor": ("5e-1", "1"), "temperature_c": ("30", "90")}
_STRICT = {"voltage_kv": ("35", "45"), "frequency_hz": ("495e-1", "505e-1"), "load_percent": ("0", "100"),
           "power_factor": ("6e-1", "1"), "temperature_c": ("35", "85")}

for _name, _ranges in (("default", _DEFAULT), ("strict", _STRICT)):

    @register(
        f"p04_clip_ranges_{_name}",
        on_raw(f"""SELECT event_id, "timestamp", transformer_id, {_clip_sql(_ranges)} FROM raw"""), source="raw",
    )
    def _(df, profile=_name, columns=tuple(_ranges)):
        return cleaning.clip_ranges(df, profile).select("event_id", "timestamp", "transformer_id", *columns)

    @register(
        f"p05_clip_report_{_name}",
        on_raw(" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS out_of_range FROM raw"
            for c, (lo, hi) in _ranges.items())),
        source="raw",
    )
    def _(df, profile=_name):
        return cleaning.clip_report(df, profile)


_FEATURE_IDS = {
    "p06_voltage_deviation": "voltage_deviation_kv", "p07_frequency_deviation": "frequency_deviation_hz",
    "p08_power_quality": "power_quality_score", "p09_voltage_stability": "voltage_stability_score",
    "p10_calculated_power": "calculated_power_mw", "p11_transmission_efficiency": "transmission_efficiency",
    "p13_anomaly_flag": "anomaly_flag",
}
for _key, _col in _FEATURE_IDS.items():

    @register(_key, on_clean(f"SELECT event_id, {FEATURE_SQL[_col]} AS {_col} FROM cleaned"))
    def _(df, column=_col):
        return df.select("event_id", cleaning.feature_expressions()[column].alias(column))


@register(
    "p11_transmission_efficiency_strict",
    on_clean("SELECT event_id, CAST(coalesce(CASE WHEN energy_consumed_mwh > 0 THEN energy_generated_mwh "
             "/ nullif(energy_consumed_mwh, 0) * 100 END, 100) * 10 AS BIGINT) / 1e1 "
             "AS transmission_efficiency FROM cleaned"),
)
def _(df):
    return df.select(
        "event_id", cleaning.feature_expressions("strict")["transmission_efficiency"].alias("transmission_efficiency")
    )


@register(
    "p12_zscores",
    on_silver("SELECT event_id, load_percent_zscore, temperature_c_zscore, power_mw_zscore FROM silver"),
)
def _(df):
    names = [f"{c}_zscore" for c in ("load_percent", "temperature_c", "power_mw")]
    return cleaning.add_zscores(df.drop(*names)).select("event_id", *names)


@register(
    "p14_silver_metadata",
    on_silver("SELECT event_id, '1.0' AS silver_version, TRUE AS has_transformation_time FROM silver"),
)
def _(df):
    return cleaning.silver_metadata(df).select(
        "event_id", "silver_version", F.col("transformation_time").isNotNull().alias("has_transformation_time")
    )


_FINAL = TELEMETRY_COLUMNS + list(FEATURE_SQL)[:6] + [
    "load_percent_zscore", "temperature_c_zscore", "power_mw_zscore", "anomaly_flag"]


@register(
    "p15_project_final",
    on_silver("SELECT " + ", ".join(f'"{c}"' for c in _FINAL) + ", '1.0' AS silver_version FROM silver"),
)
def _(df):
    return cleaning.project_final(df).drop("transformation_time")
