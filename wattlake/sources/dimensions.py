"""Fixed grid dimensions: the 29 substations and the transmission lines between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: id, latitude, longitude, region, name -------------------------------------
SUBSTATIONS = [
    ("SUB-001", 28.6139, 77.2090, "North", "Delhi"),
    ("SUB-002", 26.9124, 75.7873, "North", "Jaipur"),
    ("SUB-003", 32.3246, 74.7901, "North", "Jammu"),
    ("SUB-004", 25.2048, 77.3948, "North", "Lucknow"),
    ("SUB-005", 19.0760, 72.8777, "West", "Mumbai"),
    ("SUB-006", 23.0225, 72.5799, "West", "Ahmedabad"),
    ("SUB-007", 18.5204, 73.8567, "West", "Pune"),
    ("SUB-008", 13.0827, 80.2707, "South", "Chennai"),
    ("SUB-009", 17.3850, 78.4867, "South", "Hyderabad"),
    ("SUB-010", 12.9716, 77.5946, "South", "Bengaluru"),
    ("SUB-011", 22.5726, 88.3639, "East", "Kolkata"),
    ("SUB-012", 23.2599, 77.4126, "East", "Bhopal"),
    ("SUB-013", 21.1466, 79.0882, "East", "Nagpur"),
    ("SUB-014", 26.8206, 80.2701, "Central", "Varanasi"),
    ("SUB-015", 25.3948, 79.4625, "Central", "Prayagraj"),
    ("SUB-016", 24.8688, 76.6562, "Central", "Jhansi"),
    ("SUB-017", 28.2960, 76.5920, "North-East", "Meerut"),
    ("SUB-018", 29.0588, 76.0231, "North-East", "Panipat"),
    ("SUB-019", 22.3167, 78.0300, "West", "Indore"),
    ("SUB-020", 25.5941, 82.4720, "East", "Varanasi East"),
    ("SUB-021", 19.6776, 72.7323, "West", "Thane"),
    ("SUB-022", 15.2993, 74.1240, "South", "Hubli"),
    ("SUB-023", 21.2787, 82.1406, "East", "Jabalpur"),
    ("SUB-024", 26.7461, 78.9824, "North", "Bareilly"),
    ("SUB-025", 24.4781, 73.3114, "West", "Jaipur West"),
    ("SUB-026", 17.3618, 78.5310, "South", "Warangal"),
    ("SUB-027", 28.5355, 76.2346, "North-East", "Rohtak"),
    ("SUB-028", 20.2884, 76.2009, "Central", "Raipur"),
    ("SUB-029", 26.9124, 75.7873, "North", "Jaipur"),
]
TRANSMISSION_LINES = [
    ("SUB-001", "SUB-002"), ("SUB-001", "SUB-004"), ("SUB-002", "SUB-024"), ("SUB-004", "SUB-014"),
    ("SUB-005", "SUB-007"), ("SUB-005", "SUB-021"), ("SUB-006", "SUB-019"), ("SUB-006", "SUB-025"),
    ("SUB-007", "SUB-019"), ("SUB-008", "SUB-010"), ("SUB-009", "SUB-010"), ("SUB-009", "SUB-026"),
    ("SUB-011", "SUB-012"), ("SUB-012", "SUB-023"), ("SUB-013", "SUB-023"), ("SUB-014", "SUB-015"),
    ("SUB-015", "SUB-016"), ("SUB-016", "SUB-028"), ("SUB-017", "SUB-027"), ("SUB-018", "SUB-027"),
    ("SUB-020", "SUB-011"), ("SUB-022", "SUB-010"),
]
DEFAULT_LATITUDE, DEFAULT_LONGITUDE = 22.0, 78.0
# --- end of fixed values ----------------------------------------------------------------------


def constant_frame(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A small table written into the plan, whose size Spark therefore knows when it picks joins."""

    def literal(value) -> str:
        if value is None:
            return "CAST(NULL AS DOUBLE)"
        if isinstance(value, float):
            return f"CAST('{value!r}' AS DOUBLE)"
        return f"'{value}'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def settled(df: DataFrame) -> DataFrame:
    """Run a one-row aggregate of doubles now and put its values into later plans as constants."""
    row = df.first()
    return constant_frame(df.sparkSession, [tuple(row)], df.columns)


def substation_dimension(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, SUBSTATIONS, ["substation_id", "latitude", "longitude", "region", "name"])


def transmission_lines(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, TRANSMISSION_LINES, ["src", "dst"])
