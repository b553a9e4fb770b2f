"""Joins with the grid hierarchy: places, lines, parents and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.bands import four_band, map_status
from wattlake.operators.rollup import avg, distinct, peak, rollup, total
from wattlake.schema import SUBSTATION_KEYS
from wattlake.sources.dimensions import DEFAULT_LATITUDE, DEFAULT_LONGITUDE


def with_coordinates(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach ``lat`` and ``lon`` of the substation, or the map centre where it is unknown.

    The dimension has one row per substation; Spark broadcasts it when its size allows.
    """
    places = dimension.select("substation_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    joined = df.join(places, "substation_id", "left")
    return joined.withColumns(
        {"lat": F.coalesce("lat", F.lit(DEFAULT_LATITUDE)), "lon": F.coalesce("lon", F.lit(DEFAULT_LONGITUDE))}
    )


def map_substations(df: DataFrame, dimension: DataFrame) -> DataFrame:
    measures = [
        avg("avg_load", "load_percent"), peak("max_risk", "risk_score"),
        total("fault_count", "fault_indicator"), distinct("transformer_count", "transformer_id"),
    ]
    grouped = rollup(df, SUBSTATION_KEYS, measures)
    marked = grouped.withColumn("status", map_status(F.col("max_risk"), F.col("avg_load")))
    return with_coordinates(marked, dimension).orderBy("substation_id")


def map_substations_from_transformers(transformers: DataFrame) -> DataFrame:
    """Second-level roll-up of the transformer table; risk is the transformers' average risk."""
    return transformers.groupBy("substation_id").agg(
        F.count(F.lit(1)).alias("transformer_count"),
        F.sum("total_faults").alias("total_faults"),
        F.avg("avg_load_percent").alias("avg_load"),
        F.avg("avg_temperature_c").alias("avg_temp"),
        F.avg("avg_risk_score").alias("avg_risk"),
        F.max("avg_risk_score").alias("max_risk"),
        four_band(F.max("avg_risk_score")).alias("status"),
    )


def neighbour_links(substations: DataFrame) -> DataFrame:
    """Consecutive substations of a region from west to east, given (substation_id, region, lat, lon)."""
    order = Window.partitionBy("region").orderBy("lon", "substation_id")
    return substations.select(
        "region",
        F.col("substation_id").alias("src"), F.col("lat").alias("src_lat"), F.col("lon").alias("src_lon"),
        F.lead("substation_id").over(order).alias("dst"),
        F.lead("lat").over(order).alias("dst_lat"), F.lead("lon").over(order).alias("dst_lon"),
    ).filter(F.col("dst").isNotNull())


def visible_lines(df: DataFrame, lines: DataFrame, dimension: DataFrame) -> DataFrame:
    """Lines with both ends among the substations of ``df``; all lines when none is visible."""
    visible = df.select("substation_id").distinct().join(dimension, "substation_id", "left_semi")
    kept = lines.join(visible, lines["src"] == visible["substation_id"], "left_semi")
    ends = visible.select(F.col("substation_id").alias("end"))
    kept = kept.join(ends, kept["dst"] == ends["end"], "left_semi")
    nothing = visible.agg(F.count(F.lit(1))).scalar() == 0
    return kept.unionByName(lines.filter(nothing))


def map_bounds(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """South-west and north-east corner of the visible substations with padding."""
    places = df.select("substation_id").distinct().join(dimension, "substation_id")
    box = places.agg(
        F.min("latitude").alias("s"), F.max("latitude").alias("n"),
        F.min("longitude").alias("w"), F.max("longitude").alias("e"),
    )
    lat_pad = F.greatest((F.col("n") - F.col("s")) * 0.08, F.lit(0.7))
    lon_pad = F.greatest((F.col("e") - F.col("w")) * 0.08, F.lit(0.7))
    return box.select(
        (F.col("s") - lat_pad).alias("south"), (F.col("w") - lon_pad).alias("west"),
        (F.col("n") + lat_pad).alias("north"), (F.col("e") + lon_pad).alias("east"),
    )


def referential_violations(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """(substation_id, region, problem, records): unknown substations and wrong regions."""
    seen = df.groupBy("substation_id", "region").agg(F.count(F.lit(1)).alias("records"))
    known = dimension.select("substation_id", F.col("region").alias("expected"))
    joined = seen.join(known, "substation_id", "left")
    problem = F.when(F.col("expected").isNull(), "unknown substation").when(
        F.col("expected") != F.col("region"), "wrong region"
    )
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).drop("expected")


def missing_members(df: DataFrame, expected: dict[str, DataFrame]) -> DataFrame:
    """(level, member): expected values of each column that ``df`` never shows."""
    out = None
    for column, members in expected.items():
        absent = members.select(column).distinct().join(df.select(column).distinct(), column, "left_anti")
        part = absent.select(F.lit(column).alias("level"), F.col(column).alias("member"))
        out = part if out is None else out.unionByName(part)
    return out


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of ``expected`` not in ``actual``, without duplicates."""
    return expected.distinct().exceptAll(actual.distinct())


def enrich_parents(df: DataFrame, transformers: DataFrame, substations: DataFrame) -> DataFrame:
    """Derive substation and region of bare readings from the hierarchy."""
    bare = df.drop("substation_id", "region")
    return bare.join(transformers.select("transformer_id", "substation_id"), "transformer_id").join(
        substations.select("substation_id", "region"), "substation_id"
    )
