"""Anomaly detection, on the fitted forest and on given scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import band, on_silver, register, rs, silver, type_rules, work
from catalog.dashboard import four
from catalog.scoring import COMPONENT_SQL
from wattlake.operators import filters, isolation
from wattlake.operators.isolation import ForestParams
from wattlake.plans import ml
from wattlake.schema import FEATURE_COLUMNS

_RUNS: dict[tuple[str, str], str] = {}


def detected(spark, sf_dir):
    """Detections of the fitted forest, scored once per application and labelled as a query reads them."""
    folder = work(spark, sf_dir, "forest")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        ml.fit_and_detect(spark, silver(spark, sf_dir), folder)
        _RUNS[key] = folder
    return ml.detections(spark, folder)


register("ml1_feature_matrix", on_silver(
    f"SELECT event_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in FEATURE_COLUMNS)} FROM silver"))(
    isolation.feature_matrix)
register("ml2_standard_scaler", on_silver("SELECT event_id, " + ", ".join(
    f"{rs(f'({c} - {c}_m) / {c}_s', 4)} AS {c}" for c in FEATURE_COLUMNS) + " FROM silver, (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in FEATURE_COLUMNS) + " FROM silver)"),
    digits=4)(lambda df: isolation.standardise(
        isolation.feature_matrix(df), isolation.scaler_statistics(isolation.feature_matrix(df))))


@register("ml3_isolation_forest_nodes", source="none")
def _(spark, sf_dir):
    detected(spark, sf_dir)
    return spark.read.parquet(work(spark, sf_dir, "forest/model/nodes"))


register("ml3_tree_sample_sizes", on_silver("""SELECT CAST(t AS INTEGER) AS tree, least(256, (SELECT count(*) FROM silver))
    AS sampled FROM range(200) r(t)"""))(
    lambda df: isolation.tree_samples(isolation.feature_matrix(df), ForestParams()).groupBy("tree").agg(
        F.count(F.lit(1)).alias("sampled")))


def loaded_scores(spark, sf_dir):
    """Scores of the model as it is read back, written once per application: the one pass beside that of the fit."""
    detected(spark, sf_dir)
    folder = work(spark, sf_dir, "forest/loaded")
    key = (spark.sparkContext.applicationId, folder)
    if key not in _RUNS:
        forest = isolation.load(spark, work(spark, sf_dir, "forest/model"))
        ml.write_scores(spark, silver(spark, sf_dir).select("event_id", *FEATURE_COLUMNS), forest, folder)
        _RUNS[key] = folder
    return spark.read.parquet(f"{folder}/scored")


@register("ml4_isolation_scores", source="none")
def _(spark, sf_dir):
    return detected(spark, sf_dir).select("event_id", "anomaly_prediction", "anomaly_flag", "anomaly_score_ml")


@register("ml8_model_save_and_load", source="none")
def _(spark, sf_dir):
    return loaded_scores(spark, sf_dir).select("event_id", "iso_score")


@register("a29_ml_anomaly_summary", source="none", digits=4)
def _(spark, sf_dir):
    return isolation.anomaly_report(detected(spark, sf_dir))


@register("a30_ml_severity_summary", source="none", digits=4)
def _(spark, sf_dir):
    return isolation.severity_report(detected(spark, sf_dir))


@register("a30_ml_score_statistics", source="none", digits=4)
def _(spark, sf_dir):
    return isolation.score_statistics(detected(spark, sf_dir))


# --- facts about the forest that SQL can state --------------------------------------------------
@register("ml3_forest_facts", """SELECT CAST(t AS INTEGER) AS tree, TRUE AS odd_nodes, TRUE AS leaves_fit, TRUE AS all_reached,
    TRUE AS paths_fit FROM range(200) r(t)""", source="none")
def _(spark, sf_dir):
    """Per tree: an odd number of nodes, one leaf more than inner nodes, every node reached from the root in at
    most 8 steps, and no leaf's path shorter than its depth."""
    detected(spark, sf_dir)
    nodes = spark.read.parquet(work(spark, sf_dir, "forest/model/nodes"))
    level = nodes.where("node = 0").select("tree", "node", F.lit(0).alias("depth"))
    reached = level
    for depth in range(1, 9):
        inner = nodes.where("feature >= 0").join(level, ["tree", "node"])
        level = inner.select("tree", F.explode(F.array("left", "right")).alias("node"), F.lit(depth).alias("depth"))
        reached = reached.union(level)
    leaf = F.col("feature") < 0
    return nodes.join(reached, ["tree", "node"], "left").groupBy("tree").agg(
        (F.count(F.lit(1)) % 2 == 1).alias("odd_nodes"),
        (F.count_if(leaf) == F.count_if(~leaf) + 1).alias("leaves_fit"),
        ((F.count("depth") == F.count(F.lit(1))) & (F.count("depth") == F.count_distinct("node"))).alias("all_reached"),
        F.bool_and(~leaf | (F.col("path") >= F.col("depth"))).alias("paths_fit"),
    )


@register("ml4_score_facts", on_silver("""SELECT count(*) AS scored, count(DISTINCT event_id) AS events, TRUE AS in_range,
    TRUE AS share_fits FROM silver"""), source="none")
def _(spark, sf_dir):
    """Every event scored once, scores from 0 to 1, and a share of 0.12 flagged but for ties at the cut."""
    rows = detected(spark, sf_dir)
    flagged, score = F.col("anomaly_flag") == 1, F.col("anomaly_score_ml")
    facts = rows.agg(
        F.count(F.lit(1)).alias("scored"), F.count_distinct("event_id").alias("events"), F.count_if(flagged).alias("flagged"),
        F.coalesce(F.bool_and(score.between(0, 1)), F.lit(True)).alias("in_range"), F.max(F.when(~flagged, score)).alias("below"),
    )
    ties = rows.crossJoin(F.broadcast(facts.select("below"))).agg(F.count_if(score == F.col("below")).alias("ties"))
    share = F.col("flagged").between(F.col("scored") * 0.12 - F.col("ties") - 1, F.col("scored") * 0.12 + 1)
    return facts.crossJoin(F.broadcast(ties)).select("scored", "events", "in_range", share.alias("share_fits"))


@register("ml8_loaded_equals_fitted", on_silver("SELECT count(*) AS compared, 0 AS differences FROM silver"), source="none")
def _(spark, sf_dir):
    fitted = detected(spark, sf_dir).select("event_id", F.col("anomaly_score_ml").alias("a"), F.col("anomaly_flag").alias("f"))
    scores, bounds = loaded_scores(spark, sf_dir), ml.bounds(spark, work(spark, sf_dir, "forest/loaded"))
    loaded = isolation.flag_scores(scores, bounds=bounds).select("event_id", "anomaly_score_ml", "anomaly_flag")
    same = F.col("a").eqNullSafe(F.col("anomaly_score_ml")) & F.col("f").eqNullSafe(F.col("anomaly_flag"))
    return loaded.join(fitted, "event_id").agg(F.count(F.lit(1)).alias("compared"), F.count_if(~same).cast("int").alias("differences"))


@register("a29_a30_counts_add_up", on_silver("SELECT count(*) AS in_all, TRUE AS flagged_fit FROM silver"), source="none")
def _(spark, sf_dir):
    """The severity table counts every row, the anomaly table every flagged one."""
    rows = detected(spark, sf_dir)
    flagged = rows.agg(F.count_if(F.col("anomaly_flag") == 1).alias("flagged"))
    anomalies = isolation.anomaly_report(rows).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("anomalies"))
    severities = isolation.severity_report(rows).agg(F.sum("count").alias("in_all"))
    both = severities.crossJoin(F.broadcast(flagged)).crossJoin(F.broadcast(anomalies))
    return both.select("in_all", (F.col("flagged") == F.col("anomalies")).alias("flagged_fit"))


# --- the same steps on scores both engines know -----------------------------------------------
_GIVEN = f"""g AS (SELECT *, risk_score / 128e0 + anomaly_score / 16e0 AS iso FROM silver),
ge AS (SELECT quantile_cont(iso, 1 - 12e-2) AS cut, min(iso) AS lo, max(iso) AS hi FROM g),
fl AS (SELECT g.* REPLACE (CAST(iso > cut AS INTEGER) AS anomaly_flag), CASE WHEN iso > cut THEN -1 ELSE 1 END
    AS anomaly_prediction, least(1, greatest(0, 1 - (hi - iso) / (hi - lo + 1e-10))) AS anomaly_score_ml FROM g, ge),
bl AS (SELECT * REPLACE (anomaly_score * 3e-1 + anomaly_score_ml * 7e-1 AS anomaly_score) FROM fl),
rl AS (SELECT * REPLACE (CASE WHEN anomaly_flag = 1 THEN {type_rules('load_percent', 'temperature_c', 'voltage_kv',
    'frequency_hz', 'power_factor', 'communication_latency_ms', 'fault_indicator', 'event_id')} ELSE 'Normal' END
    AS anomaly_type) FROM bl),
rk AS (SELECT * REPLACE (CAST(least({' + '.join(COMPONENT_SQL.values())}, 100) AS INTEGER) AS risk_score) FROM rl),
dt AS (SELECT * REPLACE ({band('risk_score')} AS status) FROM rk)"""


def _given(df):
    return df.withColumn("iso_score", F.col("risk_score") / 128.0 + F.col("anomaly_score") / 16.0)


register("ml4_flag_given_scores", on_silver(
    f"SELECT event_id, anomaly_prediction, anomaly_flag, {four({'anomaly_score_ml': 'anomaly_score_ml'})} FROM fl",
    _GIVEN), digits=4)(lambda df: isolation.flag_scores(_given(df)).select(
        "event_id", "anomaly_prediction", "anomaly_flag", "anomaly_score_ml"))
register("q12_flagged_after_detection", on_silver(
    "SELECT event_id, status FROM fl WHERE anomaly_flag = 1", _GIVEN))(
    lambda df: filters.flagged_rows(isolation.flag_scores(_given(df))).select("event_id", "status"))
register("ml5_blend_given_scores", on_silver(
    f"SELECT event_id, {four({'anomaly_score': 'anomaly_score'})} FROM bl", _GIVEN), digits=4)(
    lambda df: isolation.blend_scores(isolation.flag_scores(_given(df))).select("event_id", "anomaly_score"))
register("ml6_relabel_given_flags", on_silver("SELECT event_id, anomaly_flag, anomaly_type FROM rl", _GIVEN))(
    lambda df: isolation.relabel(isolation.flag_scores(_given(df))).select("event_id", "anomaly_flag", "anomaly_type"))
register("ml7_rescore_given_scores", on_silver("SELECT event_id, risk_score, status FROM dt", _GIVEN))(
    lambda df: isolation.apply_scores(_given(df)).select("event_id", "risk_score", "status"))
register("a29_anomaly_summary_given_scores", on_silver(f"""SELECT anomaly_type, status, count(*) AS "count", {four({
    'avg_score': 'avg(anomaly_score)', 'avg_risk': 'avg(risk_score)', 'avg_load': 'avg(load_percent)',
    'avg_temp': 'avg(temperature_c)'})} FROM dt WHERE anomaly_flag = 1 GROUP BY 1, 2""", _GIVEN), digits=4)(
    lambda df: isolation.anomaly_report(isolation.apply_scores(_given(df))))
register("a30_severity_summary_given_scores", on_silver(f"""SELECT status, count(*) AS "count", {four({
    'avg_risk': 'avg(risk_score)', 'avg_score': 'avg(anomaly_score)'})} FROM dt GROUP BY 1""", _GIVEN), digits=4)(
    lambda df: isolation.severity_report(isolation.apply_scores(_given(df))))
