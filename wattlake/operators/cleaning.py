"""Silver layer: duplicates, gaps, ranges and derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.rounding import round_half_even, round_stable
from wattlake.operators.quantiles import exact_quantiles
from wattlake.schema import (
    CLIP_PROFILES, IMPUTED_COLUMNS, NOMINAL_FREQUENCY_HZ, NOMINAL_VOLTAGE_KV, NORMAL, SILVER_COLUMNS,
    ZSCORE_COLUMNS,
)

#: total order among copies of one event; the first is kept
DEDUP_ORDER = ["timestamp", "transformer_id", "power_mw"]


def rank_copies(df: DataFrame, key: str = "event_id", order: list[str] | None = None) -> DataFrame:
    """Add ``copy_rank``: 1 for the copy of a key that ``dedup`` keeps, then the others in order."""
    window = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order or DEDUP_ORDER])
    return df.withColumn("copy_rank", F.row_number().over(window))


def dedup(df: DataFrame, key: str = "event_id", order: list[str] | None = None) -> DataFrame:
    """Keep one row per key.

    Filtering on ``row_number() = 1`` lets Spark keep only the best row per key in every
    map task before the shuffle, so a key holding a third of all rows sends one row per task.
    """
    return rank_copies(df, key, order).filter("copy_rank = 1").drop("copy_rank")


def dedup_report(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows before, rows kept, rows removed."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_before"),
        F.count(F.lit(1)).alias("records_kept"),
    ).withColumn("duplicates_removed", F.col("records_before") - F.col("records_kept"))


def impute(df: DataFrame, medians: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill nulls from a one-row frame of per-column fill values."""
    names = [c for c in columns or IMPUTED_COLUMNS if c in df.columns]
    fill = medians.select(*[F.col(c).alias(f"_fill_{c}") for c in names])
    filled = df.crossJoin(F.broadcast(fill)).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in names}
    )
    return filled.select(*df.columns)


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = [c for c in columns or IMPUTED_COLUMNS if c in df.columns]
    return impute(df, exact_quantiles(df, names), names)


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "status": F.coalesce("status", F.lit(NORMAL)),
            "anomaly_type": F.coalesce("anomaly_type", F.lit(NORMAL)),
            "fault_indicator": F.coalesce("fault_indicator", F.lit(0)),
        }
    )


def clip_expressions(columns: list[str], profile: str = "default") -> dict[str, Column]:
    """Clipped value per ranged column; null stays null."""
    return {
        c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))
        for c, (lo, hi) in CLIP_PROFILES[profile].items()
        if c in columns
    }


def clip_ranges(df: DataFrame, profile: str = "default") -> DataFrame:
    return df.withColumns(clip_expressions(df.columns, profile))


def clip_report(df: DataFrame, profile: str = "default") -> DataFrame:
    """(column_name, out_of_range): how many values each clip will move."""
    ranges = {c: r for c, r in CLIP_PROFILES[profile].items() if c in df.columns}
    counted = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in ranges.items()])
    return counted.unpivot([], list(ranges), "column_name", "out_of_range")


def feature_expressions(profile: str = "default") -> dict[str, Column]:
    """Row-level features from already cleaned readings."""
    dv = round_half_even(F.col("voltage_kv") - NOMINAL_VOLTAGE_KV, 2)
    generated, consumed = F.col("energy_generated_mwh"), F.col("energy_consumed_mwh")
    ratio = F.try_divide(generated, consumed) * 100.0
    if profile == "strict":
        ratio = F.when(consumed > 0, ratio)
    return {
        "voltage_deviation_kv": dv,
        "frequency_deviation_hz": round_half_even(F.col("frequency_hz") - NOMINAL_FREQUENCY_HZ, 3),
        "power_quality_score": round_half_even((F.col("power_factor") - 0.6) / 0.4 * 100.0, 1),
        "voltage_stability_score": round_half_even(F.lit(100.0) - F.abs(dv) * 5.0, 1),
        "calculated_power_mw": round_half_even(
            F.col("voltage_kv") * F.col("current_amp") * F.col("power_factor") / 1000.0, 2
        ),
        "transmission_efficiency": round_half_even(F.coalesce(ratio, F.lit(100.0)), 1),
        "anomaly_flag": (F.col("status") != NORMAL).cast("int"),
    }


def add_features(df: DataFrame, profile: str = "default") -> DataFrame:
    return df.withColumns(feature_expressions(profile))


def zscore_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with mean and sample deviation of each column."""
    names = columns or ZSCORE_COLUMNS
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in names], *[F.stddev_samp(c).alias(f"{c}_std") for c in names]
    )


def add_zscores(df: DataFrame, statistics: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """Add ``<column>_zscore``; null where the deviation is zero or undefined."""
    names = columns or ZSCORE_COLUMNS
    stats = statistics if statistics is not None else zscore_statistics(df, names)
    scored = {
        f"{c}_zscore": F.when(
            F.col(f"{c}_std") > 0,
            round_stable((F.col(c) - F.col(f"{c}_mean")) / F.nullif(F.col(f"{c}_std"), F.lit(0.0)), 3),
        )
        for c in names
    }
    return df.crossJoin(F.broadcast(stats)).withColumns(scored).select(*df.columns, *scored)


def silver_metadata(df: DataFrame, version: str = "1.0") -> DataFrame:
    return df.withColumns({"transformation_time": F.current_timestamp(), "silver_version": F.lit(version)})


def project_final(df: DataFrame) -> DataFrame:
    """The silver columns in their published order, those present only."""
    return df.select(*[c for c in SILVER_COLUMNS if c in df.columns])


def clean(df: DataFrame, medians: DataFrame, profile: str = "default") -> DataFrame:
    """Fill, clip and derive row features; input is already free of duplicates."""
    return add_features(clip_ranges(fill_defaults(impute(df, medians)), profile), profile)


def silver(df: DataFrame, profile: str = "default") -> DataFrame:
    """The whole silver transformation as one lazy plan.

    ``wattlake.plans.batch.build_silver`` computes the same with a written stage in
    between, which is the cheaper choice on data that does not fit a cache.
    """
    distinct = dedup(df)
    cleaned = clean(distinct, exact_quantiles(distinct, IMPUTED_COLUMNS), profile)
    return project_final(silver_metadata(add_zscores(cleaned)))
