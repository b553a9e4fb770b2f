"""Row filters of the service and the dashboard."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.times import hours
from wattlake.operators.ranks import with_position
from wattlake.schema import NORMAL
from wattlake.sources.dimensions import constant_frame

# --- fixed values -----------------------------------------------------------------------
SERVICE_RANGES = {"6h": 6, "12h": 12, "24h": 24, "48h": 48, "72h": 72, "7d": 168, "30d": 720, "90d": 2160}
SERVICE_DEFAULT_HOURS = 2160
DASHBOARD_RANGES = {
    "Last 1 Hour": 1, "Last 6 Hours": 6, "Last 12 Hours": 12, "Last 24 Hours": 24,
    "Last 7 Days": 168, "Last 30 Days": 720,
}
# --- end of fixed values ------------------------------------------------------------------
RISK_LEVELS = ["critical", "high", "high_risk", "high risk", "warning", "low", "normal"]


def risk_level_predicate(level: str) -> Column | None:
    """Score range of a level name; an unknown name filters nothing."""
    score = F.col("risk_score")
    ranges = {
        "critical": score >= 85,
        "high": (score >= 70) & (score < 85),
        "warning": (score >= 50) & (score < 70),
        "low": (score >= 30) & (score < 50),
        "normal": score < 30,
    }
    name = level.lower().replace("_", " ")
    return ranges.get("high" if name == "high risk" else name)


def parse_anomaly_types(text: str | None) -> list[str]:
    return [t.strip() for t in (text or "").split(",") if t.strip()]


@dataclass(frozen=True)
class FilterSpec:
    """What a request narrows down to; ``None``, empty and "All" mean no filter."""

    region: str | None = None
    substation_id: str | None = None
    transformer_id: str | None = None
    status: str | None = None
    anomaly_type: str | None = None
    risk_level: str | None = None
    time_range: str | None = None

    def cleaned(self) -> FilterSpec:
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        return FilterSpec(**{k: None if v in ("", "All") else v for k, v in values.items()})


def apply_equality(df: DataFrame, spec: FilterSpec) -> DataFrame:
    for column in ("region", "substation_id", "transformer_id", "status"):
        wanted = getattr(spec.cleaned(), column)
        if wanted is not None and column in df.columns:
            df = df.filter(F.col(column) == wanted)
    return df


def newest_within(df: DataFrame, n_hours: int) -> DataFrame:
    """Rows not older than ``n_hours`` before the newest row of ``df``.

    The cutoff is a scalar subquery over the timestamp column alone.  Comparing the bare
    columns with it lets the Parquet reader skip row groups and, on a day-partitioned
    table, skip whole days once the subquery has run.
    """
    cutoff = df.agg(F.max("timestamp") - hours(n_hours)).scalar()
    recent = df.filter(F.col("timestamp") >= cutoff)
    if "event_date" in df.columns:
        recent = recent.filter(F.col("event_date") >= cutoff.cast("date"))
    return recent


def apply_service_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """All request filters; the time range is anchored to the newest row left by the others."""
    spec = spec.cleaned()
    df = apply_equality(df, spec)
    types = parse_anomaly_types(spec.anomaly_type)
    if types:
        df = df.filter(F.col("anomaly_type").isin(types))
    if spec.risk_level:
        predicate = risk_level_predicate(spec.risk_level)
        df = df if predicate is None else df.filter(predicate)
    if spec.time_range:
        df = newest_within(df, SERVICE_RANGES.get(spec.time_range, SERVICE_DEFAULT_HOURS))
    return df


def apply_dashboard_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Region, substation, transformer and named time range; default range is 24 hours."""
    spec_clean = spec.cleaned()
    df = apply_equality(df, FilterSpec(spec_clean.region, spec_clean.substation_id, spec_clean.transformer_id))
    wanted = DASHBOARD_RANGES.get(spec.time_range or "Last 24 Hours")
    return df if wanted is None else newest_within(df, wanted)


def filter_options(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """(filter, position, option): "All" first, then the sorted values open to the user.

    The raw rows are read once and reduced to the distinct paths of the hierarchy; each
    path then offers its values and only the small result is sorted.
    """
    spec = spec.cleaned()
    paths = df.select("region", "substation_id", "transformer_id").distinct()
    in_region = F.lit(True) if spec.region is None else F.col("region") == spec.region
    scope = in_region if spec.substation_id is None else F.col("substation_id") == spec.substation_id
    open_to = {"region": F.lit(True), "substation_id": in_region, "transformer_id": scope}
    offers = F.array(*[
        F.struct(F.lit(name).alias("filter"), F.lit(1).alias("position"), F.when(shown, F.col(name)).alias("option"))
        for name, shown in open_to.items()
    ])
    values = paths.select(F.inline(offers)).filter(F.col("option").isNotNull()).distinct()
    everything = constant_frame(
        df.sparkSession, [(name, 0, "All") for name in open_to], ["filter", "position", "option"]
    )
    return everything.unionByName(values).orderBy("filter", "position", "option")


def check_consistency(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """(is_valid, message): does every chosen value exist within its parents?"""
    spec = spec.cleaned()
    in_region = F.lit(True) if spec.region is None else F.col("region") == spec.region
    region_ok = F.lit(True) if spec.region is None else F.bool_or(F.col("region") == spec.region)
    if spec.substation_id is None:
        substation_ok, scope = F.lit(True), in_region
    else:
        chosen = F.col("substation_id") == spec.substation_id
        substation_ok, scope = F.bool_or(in_region & chosen), chosen
    if spec.transformer_id is None:
        transformer_ok = F.lit(True)
    else:
        transformer_ok = F.bool_or(scope & (F.col("transformer_id") == spec.transformer_id))
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), region_ok.alias("r"), substation_ok.alias("s"), transformer_ok.alias("t")
    )
    message = (
        F.when(F.col("n") == 0, "No data to validate")
        .when(~F.col("r"), f"Region '{spec.region}' not found in data")
        .when(~F.col("s"), f"Substation '{spec.substation_id}' not found in selected region")
        .when(~F.col("t"), f"Transformer '{spec.transformer_id}' not found in selected scope")
        .otherwise("Filters are valid")
    )
    valid = (F.col("n") == 0) | (F.col("r") & F.col("s") & F.col("t"))
    return facts.select(valid.alias("is_valid"), message.alias("message"))


def search_transformers(df: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring search on the transformer id."""
    return df.filter(F.lower("transformer_id").contains(text.lower())) if text else df


def _display_order(by: str, ascending: bool) -> list[Column]:
    columns = {
        "ID": "transformer_id", "Risk": "max_risk", "Load": "avg_load", "Temperature": "avg_temp", "Status": "status",
    }
    key = F.col(columns.get(by, "max_risk"))
    return [key.asc() if ascending else key.desc(), F.col("transformer_id").asc()]


def sort_table(df: DataFrame, by: str = "Risk", ascending: bool = False) -> DataFrame:
    """Sort by a display name; unknown names sort by risk. Ties follow the id."""
    return df.orderBy(*_display_order(by, ascending))


def positioned(df: DataFrame, by: str = "Risk", ascending: bool = False) -> DataFrame:
    """The same order as a column ``position``, for tables of any size; rows come in no order."""
    return with_position(df, _display_order(by, ascending)).withColumn("position", F.col("position").cast("long"))


def anomalous_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") != NORMAL)


def flagged_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("anomaly_flag") == 1)
