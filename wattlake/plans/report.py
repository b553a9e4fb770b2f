"""Report bundle and gold export."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from wattlake.operators import gold, service
from wattlake.operators.filters import FilterSpec, apply_service_filters
from wattlake.plans.batch import write_layer
from wattlake.sources.layers import export_csv


@contextmanager
def report_bundle(df: DataFrame, spec: FilterSpec) -> Iterator[dict[str, DataFrame]]:
    """The report's sections over one filtered frame.

    All sections read the same rows, so those are kept (spilling to disk) while the block
    lasts.  Losing an executor recomputes its part from the table.
    """
    filtered = apply_service_filters(df, spec).persist(StorageLevel.MEMORY_AND_DISK)
    everything = FilterSpec()
    try:
        yield {
            "grid_health": service.grid_health(filtered, everything),
            "summary": service.summary(filtered, everything),
            "energy_by_hour": service.energy_by_hour(filtered, everything),
            "energy_totals": service.energy_totals(filtered, everything),
            "anomalies": service.anomalies(filtered, everything),
            "regions": service.regions(filtered, everything),
        }
    finally:
        filtered.unpersist()


def build_gold(silver: DataFrame, folder: str, csv_folder: str | None = None) -> None:
    """Write the eight gold tables, and their CSV copies if asked for.

    Five tables come from one written table of partial sums, the other three each from
    their own pass.  The CSV copies are made from the written tables.
    """
    spark = silver.sparkSession
    write_layer(gold.gold_grain(silver), f"{folder}/grain")
    tables = gold.tables_from_grain(spark.read.parquet(f"{folder}/grain"))
    tables["hourly_summary"] = gold.hourly_summary(silver)
    tables["daily_summary"] = gold.daily_summary(silver)
    tables["critical_transformers"] = gold.critical_transformers(silver)
    for name, table in tables.items():
        write_layer(table, f"{folder}/{name}")
    if csv_folder is not None:
        bounded = ["region_summary", "hourly_summary", "daily_summary", "anomaly_summary", "severity_summary"]
        export_csv({n: spark.read.parquet(f"{folder}/{n}") for n in gold.GOLD_TABLES}, csv_folder, bounded)
