"""Band edges, score steps and labels, value by value."""

import pytest
from pyspark.sql import functions as F

from wattlake.functions import bands, labels, scoring
from wattlake.functions.rounding import round_half_even, round_stable


def values(spark, data, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


@pytest.mark.parametrize("fn, edges", [
    (bands.risk_band, {29: "Normal", 30: "Low", 49: "Low", 50: "Warning", 69: "Warning", 70: "High Risk",
                       84: "High Risk", 85: "Critical", 100: "Critical"}),
    (bands.four_band, {30: "Normal", 49: "Normal", 50: "Warning", 70: "High Risk", 85: "Critical"}),
    (bands.health_band, {0: None, 1: "Critical", 40: "Critical", 41: "Poor", 60: "Poor", 61: "Fair", 80: "Fair",
                         81: "Good", 100: "Good"}),
    (bands.grid_health_label, {49: "Critical", 50: "Warning", 65: "Healthy", 80: "Excellent"}),
    (bands.load_bucket, {29: "low", 30: "medium", 59: "medium", 60: "high", 84: "high", 85: "critical"}),
    (bands.temperature_bucket, {49: "normal", 50: "elevated", 60: "high", 69: "high", 70: "critical"}),
    (scoring.load_points, {60: 0, 61: 5, 70: 5, 71: 10, 80: 10, 81: 15, 90: 15, 91: 20}),
    (scoring.temperature_points, {60: 0, 61: 5, 65: 5, 66: 10, 70: 10, 71: 15, 75: 15, 76: 20}),
    (scoring.latency_points, {15: 0, 16: 1, 30: 1, 31: 3, 50: 3, 51: 5}),
])
def test_edges(spark, fn, edges):
    assert values(spark, list(edges), "int", fn) == list(edges.values())


def test_deviation_points_take_either_sign(spark):
    volts = [40.0, 41.0, 41.01, 42.0, 42.01, 43.01, 44.0, 44.01, 38.99, 35.5]
    points = values(spark, volts, "double", lambda c: scoring.voltage_points(scoring.voltage_offset(c)))
    assert points == [0, 0, 4, 4, 8, 12, 12, 15, 4, 15]
    hertz = [50.1, 50.11, 50.15, 50.16, 50.2, 50.21, 50.3, 50.31, 49.89, 49.69]
    points = values(spark, hertz, "double", lambda c: scoring.frequency_points(scoring.frequency_offset(c)))
    assert points == [0, 2, 2, 5, 5, 7, 7, 10, 2, 10]


def test_power_factor_points(spark):
    got = values(spark, [0.69, 0.7, 0.75, 0.8, 0.85], "double", scoring.power_factor_points)
    assert got == [10, 7, 5, 2, 0]


def test_unknown_status(spark):
    assert values(spark, ["Critical", "Low", "odd", None], "string", bands.status_priority) == [4, 1, 0, 0]
    assert values(spark, ["Critical", "Low", "odd", None], "string", bands.severity_rank) == [1, 4, 5, 5]


def test_stream_risk_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(None, None, None, None), (1.0, 100.0, 90.0, 1)],
                               "a double, l double, t double, f int")
    risk = scoring.stream_risk(F.col("a"), F.col("l"), F.col("t"), F.col("f"))
    rows = df.select(risk.alias("r"), labels.stream_status(risk, F.col("a"), F.col("f")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [(0.0, "Normal"), (81.0, "Critical")]


def test_rounding(spark):
    half_even = values(spark, [0.125, 0.375, -0.125, -0.001], "double", lambda c: round_half_even(c, 2))
    assert half_even == [0.12, 0.38, -0.12, 0.0] and str(half_even[3]) == "0.0"
    noisy = values(spark, [1.2349999999999, 1.2350000000001], "double", lambda c: round_stable(c, 2))
    assert noisy[0] == noisy[1]


def test_weighted_type(spark, frame):
    from readings import reading

    rows = [
        reading(0, load_percent=95.0, temperature_c=80.0, fault_indicator=1),
        reading(1, energy_generated_mwh=0.0, energy_consumed_mwh=0.0),
        reading(2, energy_generated_mwh=100.0, energy_consumed_mwh=126.0),
        reading(3, load_percent=85.0, energy_generated_mwh=100.0),
    ]
    got = labels.with_weighted_type(frame(rows), "k").orderBy("event_id").collect()
    assert got[0]["k"] == "Compound Anomaly"
    assert got[1]["k"] in labels.ANOMALY_TYPES
    assert [got[2]["k"], got[3]["k"]] == ["Unexpected Consumption", "Overload"]


def test_weighted_type_follows_the_weights(spark, frame):
    from readings import reading

    rows = [reading(i, load_percent=85.0, energy_generated_mwh=50.0) for i in range(4000)]
    counts = {r["k"]: r["count"] for r in labels.with_weighted_type(frame(rows), "k").groupBy("k").count().collect()}
    assert set(counts) == {"Overload", "Generation Drop"}
    assert abs(counts["Overload"] / 4000 - 25 / 37) < 0.03


def test_grid_coordinates_are_the_published_ones(spark):
    """A few fixed places, written out here, so that a wrong coordinate is seen outside the package's own list."""
    from wattlake.sources.dimensions import substation_dimension

    places = {r["substation_id"]: (r["latitude"], r["longitude"], r["name"]) for r in substation_dimension(spark).collect()}
    assert len(places) == 29 and all(8 < lat < 35 and 68 < lon < 97 for lat, lon, _ in places.values())
    for name, place in {"SUB-001": (28.6139, 77.2090, "Delhi"), "SUB-008": (13.0827, 80.2707, "Chennai"),
                        "SUB-011": (22.5726, 88.3639, "Kolkata"), "SUB-029": (26.9124, 75.7873, "Jaipur")}.items():
        assert places[name] == place
