"""Tables, cards and feeds of the dashboard, as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.bands import risk_band, status_of_priority, status_priority
from wattlake.functions.labels import event_description
from wattlake.functions.rounding import round_stable
from wattlake.functions.times import floor_hour
from wattlake.operators.filters import anomalous_rows
from wattlake.operators.rollup import avg, distinct, distinct_where, low, peak, rollup, rows, rows_where, total
from wattlake.operators.trends import period_columns, with_latest
from wattlake.schema import NORMAL, STATUSES, SUBSTATION_KEYS, TRANSFORMER_KEYS


def _tag(status: str) -> str:
    return status.lower().replace(" ", "_")


# --- distributions ----------------------------------------------------------------------------

def share_of_total(counted: DataFrame, value: str = "records", alias: str = "percent") -> DataFrame:
    """Add the percentage of the column total to an already aggregated frame."""
    return counted.crossJoin(F.broadcast(counted.agg(F.sum(value).alias("_total")))).withColumn(
        alias, F.try_divide(F.col(value) * 100.0, F.col("_total"))
    ).drop("_total")


def status_distribution(df: DataFrame) -> DataFrame:
    """(status, records, percent of all rows), zeros kept."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])
    long = counts.unpivot(["_n"], [F.col(f"`{s}`") for s in STATUSES], "status", "records")
    return long.select(
        "status", "records", F.coalesce(F.try_divide(F.col("records") * 100.0, F.col("_n")), F.lit(0.0)).alias("percent")
    )


def anomaly_type_distribution(df: DataFrame) -> DataFrame:
    """(anomaly_type, records, percent of the non-normal rows)."""
    counted = anomalous_rows(df).groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("records"))
    return share_of_total(counted).orderBy(F.desc("records"), "anomaly_type")


def region_energy_report(df: DataFrame) -> DataFrame:
    """Rows and energy per region with a TOTAL row, and each region's share of the rows."""
    per_region = df.groupBy("region").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("energy_generated_mwh").alias("total_energy_generated_mwh"),
        F.sum("energy_consumed_mwh").alias("total_energy_consumed_mwh"),
    )
    rolled = per_region.rollup("region").agg(
        F.grouping("region").alias("_all"),
        *[F.sum(c).alias(c) for c in per_region.columns if c != "region"],
    )
    # one row per region and one total: small enough for a single window
    whole = F.max(F.when(F.col("_all") == 1, F.col("record_count"))).over(Window.partitionBy())
    return rolled.select(
        F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("region")).alias("region"),
        "record_count", (F.col("record_count") * 100.0 / whole).alias("percent"),
        "total_energy_generated_mwh", "total_energy_consumed_mwh",
    )


def coverage_counts(df: DataFrame) -> DataFrame:
    return rollup(df, [], [
        rows("record_count"), distinct("transformers", "transformer_id"), distinct("substations", "substation_id"),
        distinct("regions", "region"), low("first_timestamp", "timestamp"), peak("last_timestamp", "timestamp"),
    ])


def correlations(df: DataFrame) -> DataFrame:
    """One row of correlations; null when a side does not vary."""
    pairs = {
        "load_current": ("load_percent", "current_amp"), "load_temperature": ("load_percent", "temperature_c"),
        "risk_load": ("risk_score", "load_percent"), "risk_temperature": ("risk_score", "temperature_c"),
    }
    return df.agg(*[F.corr(a, b).alias(name) for name, (a, b) in pairs.items()])


# --- charts -----------------------------------------------------------------------------------

def worst_status_per_transformer(df: DataFrame) -> DataFrame:
    worst = df.groupBy("transformer_id").agg(F.max(status_priority(F.col("status"))).alias("p"))
    return worst.select("transformer_id", status_of_priority(F.col("p")).alias("status"))


def health_donut_by_transformer(df: DataFrame) -> DataFrame:
    """Transformers per worst status; the four shown statuses leave out Low."""
    shown = ["Normal", "Warning", "High Risk", "Critical"]
    counted = worst_status_per_transformer(df).agg(
        *[F.count_if(F.col("status") == s).alias(f"{_tag(s)}_count") for s in shown]
    )
    return counted.withColumn("total", sum((F.col(f"{_tag(s)}_count") for s in shown[1:]), F.col("normal_count")))


def health_donut_by_record(df: DataFrame) -> DataFrame:
    """Rows per status with Low counted as Normal."""
    status = F.col("status")
    counted = df.agg(
        F.count_if(status.isin("Normal", "Low")).alias("normal_count"),
        *[F.count_if(status == s).alias(f"{_tag(s)}_count") for s in ("Warning", "High Risk", "Critical")],
    )
    return counted.withColumn(
        "total", F.col("normal_count") + F.col("warning_count") + F.col("high_risk_count") + F.col("critical_count")
    )


def energy_by_region(df: DataFrame, by: str = "total_power_mw") -> DataFrame:
    """Ordered by power, or by ``total_generation``."""
    grouped = rollup(df, ["region"], [
        total("total_power_mw", "power_mw"), avg("avg_load", "load_percent"),
        total("total_generation", "energy_generated_mwh"), total("total_consumption", "energy_consumed_mwh"),
    ])
    return grouped.orderBy(F.desc(by), "region")


def top_anomaly_types(df: DataFrame, n: int = 8) -> DataFrame:
    counted = anomalous_rows(df).groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("anomaly_count"))
    return counted.orderBy(F.desc("anomaly_count"), "anomaly_type").limit(n)


def top_anomaly_groups(anomalies: DataFrame, n: int = 5) -> DataFrame:
    """Largest (type, status) groups with their length relative to the largest."""
    top = (
        anomalies.filter(F.col("anomaly_type") != NORMAL)
        .select("anomaly_type", "status", "anomaly_count")
        .orderBy(F.desc("anomaly_count"), "anomaly_type", "status")
        .limit(n)
    )
    longest = F.max("anomaly_count").over(Window.partitionBy())
    return top.withColumn("percent_of_max", F.col("anomaly_count") * 100.0 / longest)


def generation_vs_consumption(df: DataFrame) -> DataFrame:
    hourly = df.withColumn("hour", floor_hour(F.col("timestamp")))
    return rollup(hourly, ["hour"], [
        total("total_generation", "energy_generated_mwh"), total("total_consumption", "energy_consumed_mwh"),
        avg("avg_power", "power_mw"),
    ]).orderBy("hour")


# --- headline cards ---------------------------------------------------------------------------

def trend_text(change: Column, digits: int) -> Column:
    """Arrow, absolute change and the comparison period; no change points down."""
    number = round_stable(F.abs(change), digits).cast(f"decimal(20,{digits})").cast("string")
    arrow = F.when(change > 0, "↑ ").otherwise("↓ ")
    return F.concat(arrow, number, F.lit("% vs last 24h"))


def kpi_metrics(df: DataFrame) -> DataFrame:
    """Last 24 hours against the 24 hours before: values, changes and their text."""
    now, before = period_columns(24, 24)

    def when(side: Column, c: str) -> Column:
        return F.when(side, F.col(c))

    off = (F.col("status") != NORMAL).cast("int")
    facts = rollup(with_latest(df), [], [
        rows_where("n_before", before),
        total("gen_now", when(now, "energy_generated_mwh")), total("gen_before", when(before, "energy_generated_mwh")),
        total("cons_now", when(now, "energy_consumed_mwh")), total("cons_before", when(before, "energy_consumed_mwh")),
        avg("load_now", when(now, "load_percent")), avg("load_before", when(before, "load_percent")),
        distinct("all_transformers", "transformer_id"),
        distinct_where("tran_now", "transformer_id", now), distinct_where("tran_before", "transformer_id", before),
        total("fault_now", when(now, "fault_indicator")), total("fault_before", when(before, "fault_indicator")),
        total("anom_now", F.when(now, off)), total("anom_before", F.when(before, off)),
    ])
    zero = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in facts.columns}

    def change(name: str) -> Column:
        current, previous = zero[f"{name}_now"], zero[f"{name}_before"]
        return F.when(previous > 0, (current - previous) / (previous + 1.0) * 100.0).otherwise(0.0)

    load_change = zero["load_now"] - zero["load_before"]
    return facts.select(
        zero["gen_now"].alias("total_generation_mw"),
        zero["cons_now"].alias("total_consumption_mwh"),
        zero["load_now"].alias("avg_load_percent"),
        F.col("all_transformers").alias("total_transformers"),
        F.col("tran_now").alias("active_transformers"),
        zero["fault_now"].cast("bigint").alias("total_faults"),
        zero["anom_now"].cast("bigint").alias("anomaly_count"),
        trend_text(change("gen"), 1).alias("generation_trend"),
        trend_text(change("cons"), 1).alias("consumption_trend"),
        trend_text(load_change, 1).alias("load_trend"),
        trend_text(change("tran"), 1).alias("transformers_trend"),
        trend_text(change("fault"), 0).alias("faults_trend"),
        trend_text(change("anom"), 0).alias("anomalies_trend"),
    )


def kpi_sparklines(df: DataFrame) -> DataFrame:
    """Hourly series of the last 24 hours, four of them scaled to 0-1."""
    now, _ = period_columns(24, 24)
    hourly = rollup(with_latest(df).filter(now).withColumn("hour", floor_hour(F.col("timestamp"))), ["hour"], [
        total("generation", "energy_generated_mwh"), total("consumption", "energy_consumed_mwh"),
        avg("load", "load_percent"), total("faults", "fault_indicator"),
        rows_where("anomalies", F.col("status") != NORMAL), distinct("transformers", "transformer_id"),
    ])
    tops = hourly.agg(F.max("faults").alias("_f"), F.max("anomalies").alias("_a"))
    everyone = df.agg(F.count_distinct("transformer_id").alias("_t"))
    return hourly.crossJoin(F.broadcast(tops)).crossJoin(F.broadcast(everyone)).select(
        "hour", "generation", "consumption", (F.col("load") / 100.0).alias("load"),
        (F.col("faults") / (F.col("_f") + 1.0)).alias("faults"),
        (F.col("anomalies") / (F.col("_a") + 1.0)).alias("anomalies"),
        (F.col("transformers") / F.col("_t")).alias("transformers"),
    ).orderBy("hour")


def system_status(df: DataFrame) -> DataFrame:
    facts = rollup(df, [], [
        rows("record_count"), distinct("transformer_count", "transformer_id"), peak("latest_timestamp", "timestamp")
    ])
    some = F.col("record_count") > 0
    return facts.select(
        F.when(some, "All Systems Operational").otherwise("No Data Available").alias("system_status"),
        "record_count", "transformer_count", "latest_timestamp", some.alias("loaded"),
    )


# --- tables -----------------------------------------------------------------------------------

def regional_overview(df: DataFrame) -> DataFrame:
    grouped = rollup(df, ["region"], [
        distinct("substation_count", "substation_id"), distinct("transformer_count", "transformer_id"),
        avg("avg_load", "load_percent"), peak("max_load", "load_percent"), avg("avg_temp", "temperature_c"),
        avg("avg_risk", "risk_score"), peak("max_risk", "risk_score"), total("fault_count", "fault_indicator"),
        rows_where("normal_count", F.col("status") == NORMAL), rows("total_count"),
    ])
    return grouped.withColumn("health_pct", F.col("normal_count") * 100.0 / F.col("total_count")).orderBy("region")


def substation_performance(df: DataFrame, n: int = 20) -> DataFrame:
    grouped = rollup(df, SUBSTATION_KEYS, [
        distinct("transformers", "transformer_id"), avg("avg_load", "load_percent"), peak("max_load", "load_percent"),
        avg("avg_temp", "temperature_c"), avg("avg_voltage", "voltage_kv"), avg("avg_risk", "risk_score"),
        peak("max_risk", "risk_score"), total("faults", "fault_indicator"), rows("records"),
    ])
    return grouped.orderBy(F.desc("max_risk"), *SUBSTATION_KEYS).limit(n)


def status_counts_over_transformers(transformers: DataFrame) -> DataFrame:
    """Transformers per representative status, active ones, and their faults."""
    status = F.coalesce("status", "worst_status")
    return transformers.agg(
        *[F.count_if(status == s).alias(f"{_tag(s)}_count") for s in STATUSES],
        F.count_if(status != "Critical").alias("active_count"),
        F.coalesce(F.sum("total_faults"), F.lit(0)).alias("total_faults"),
    )


def anomaly_totals(anomalies: DataFrame) -> DataFrame:
    """Total, critical, high and warning counts over the (type, status) rows."""
    count, status = F.col("anomaly_count"), F.col("status")

    def summed(condition: Column | None = None) -> Column:
        return F.coalesce(F.sum(count if condition is None else F.when(condition, count)), F.lit(0))

    return anomalies.agg(
        summed().alias("total"), summed(status == "Critical").alias("critical"),
        summed(status == "High Risk").alias("high"), summed(status == "Warning").alias("warning"),
    )


def anomalies_by_type(anomalies: DataFrame) -> DataFrame:
    grouped = anomalies.groupBy("anomaly_type").agg(F.sum("anomaly_count").alias("anomaly_count"))
    return grouped.orderBy(F.desc("anomaly_count"), "anomaly_type")


def top_risk_transformers(df: DataFrame, n: int = 5) -> DataFrame:
    grouped = rollup(df, TRANSFORMER_KEYS, [
        avg("avg_risk", "risk_score"), peak("max_risk", "risk_score"), avg("avg_load", "load_percent"),
        avg("avg_temp", "temperature_c"), avg("avg_voltage", "voltage_kv"), avg("avg_pf", "power_factor"),
    ])
    banded = grouped.withColumn("status", risk_band(F.col("max_risk")))
    return banded.orderBy(F.desc("max_risk"), "transformer_id").limit(n)


def transformer_table(df: DataFrame) -> DataFrame:
    grouped = rollup(df, TRANSFORMER_KEYS, [
        avg("avg_load", "load_percent"), avg("avg_temp", "temperature_c"), avg("avg_voltage", "voltage_kv"),
        avg("avg_pf", "power_factor"), peak("max_risk", "risk_score"), avg("avg_risk", "risk_score"),
        peak("_worst", status_priority(F.col("status"))),
    ])
    return grouped.withColumn("status", status_of_priority(F.col("_worst"))).drop("_worst")


# --- feeds ------------------------------------------------------------------------------------

def recent_alerts(df: DataFrame, n: int = 5) -> DataFrame:
    """Newest non-normal rows, riskiest first among equals."""
    return anomalous_rows(df).orderBy(F.desc("timestamp"), F.desc("risk_score"), "event_id").limit(n).select(
        "event_id", "timestamp", "transformer_id", "substation_id", "anomaly_type", "anomaly_score", "risk_score", "status"
    )


def ticker(df: DataFrame, n: int = 5) -> DataFrame:
    """The newest anomalies as "HH:mm description"."""
    newest = anomalous_rows(df).orderBy(F.desc("timestamp"), "event_id").limit(n)
    text = F.concat(
        F.date_format("timestamp", "HH:mm"), F.lit(" "),
        event_description(F.col("anomaly_type"), F.col("substation_id")),
    )
    return newest.select("event_id", "timestamp", text.alias("ticker_text"))


def top_transformers(transformers: DataFrame, n: int = 10) -> DataFrame:
    return transformers.orderBy(F.desc("avg_risk_score"), "transformer_id").limit(n)


def live_feed(events: DataFrame, keep: int = 50, show: int = 10) -> DataFrame:
    """Of the newest ``keep`` events, the first ``show`` that carry a message."""
    newest = events.orderBy(F.desc("timestamp"), "event_id").limit(keep)
    return newest.filter(F.length("message") > 0).orderBy(F.desc("timestamp"), "event_id").limit(show)
