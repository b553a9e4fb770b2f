"""Anomaly detection run: fit, score once to a written table, then label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators import isolation
from wattlake.operators.isolation import Forest, ForestParams
from wattlake.plans.batch import write_layer


def write_scores(spark: SparkSession, silver: DataFrame, forest: Forest, folder: str) -> DataFrame:
    """Score ``silver`` once, to ``folder/scored``, and keep the cut and the ends of the scores in ``folder/bounds``.

    Everything after reads these two: the forest walks over each row once, whatever is asked of its
    scores later.  ``silver`` itself is never overwritten, so a rerun gives the same result.
    """
    write_layer(isolation.score_rows(silver, forest), f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    write_layer(isolation.score_bounds(scored, forest.params.contamination).coalesce(1), f"{folder}/bounds")
    return scored


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    """The one row of cut, least and greatest score written with the scores."""
    return spark.read.parquet(f"{folder}/bounds")


def detect(spark: SparkSession, silver: DataFrame, forest: Forest, folder: str) -> DataFrame:
    """Score ``silver`` with a fitted forest and label the rows."""
    write_scores(spark, silver, forest, folder)
    return detections(spark, folder, forest.params)


def detections(spark: SparkSession, folder: str, params: ForestParams = ForestParams()) -> DataFrame:
    """The labelled rows of written scores; a query computes only the labels it reads."""
    return isolation.apply_scores(spark.read.parquet(f"{folder}/scored"), params.contamination, bounds(spark, folder))


def fit_and_detect(
    spark: SparkSession, silver: DataFrame, folder: str, params: ForestParams = ForestParams()
) -> DataFrame:
    """Fit on ``silver``, keep model and scores under ``folder`` and return the detections, which are not written again."""
    forest = isolation.fit(silver, params)
    isolation.save(spark, forest, f"{folder}/model")
    return detect(spark, silver, forest, folder)


def run_detection(
    spark: SparkSession, silver: DataFrame, folder: str, params: ForestParams = ForestParams()
) -> DataFrame:
    """Fit on ``silver``, keep the model under ``folder`` and return the written detections."""
    write_layer(fit_and_detect(spark, silver, folder, params), f"{folder}/detected")
    return spark.read.parquet(f"{folder}/detected")
