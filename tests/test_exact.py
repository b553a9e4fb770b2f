"""Totals that do not depend on partitions, and one scoring pass for the forest."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wattlake.functions.exact import exact_avg, exact_sum
from wattlake.operators import gold, isolation
from wattlake.operators.rollup import avg, combine, distinct, partials, rollup, total
from wattlake.plans import ml
from wattlake.schema import TELEMETRY_SCHEMA


def test_large_sums_have_equal_digits_on_any_partitions(spark):
    """200,000 readings with eight digits each; the sum is near 1e11, so a double step is 1.5e-5."""
    rows = spark.range(200_000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(10**14)).cast("double") / 1e8).alias("v"))
    want = sum((Fraction(round(r["v"] * 1e8), 10**8) for r in rows.collect()), Fraction(0))
    assert want > 9e10
    found = set()
    for parts in (1, 7, 200):
        for order in ("id", F.desc("v")):
            found.add(rows.repartition(parts, "id").sortWithinPartitions(order).agg(exact_sum(F.col("v"))).first()[0])
    assert found == {float(want)}


def test_nulls_negatives_and_readings_that_do_not_fit(spark):
    def of(values):
        row = spark.createDataFrame([(v,) for v in values], "v double").agg(
            exact_sum(F.col("v")).alias("s"), exact_avg(F.col("v")).alias("a")).first()
        return row["s"], row["a"]

    assert of([]) == (None, None) and of([None, None]) == (None, None)
    assert of([-0.1, 0.3, None, -0.2]) == (0.0, 0.0)
    assert of([0.1] * 10) == (1.0, 0.1)
    assert of([-1e-8, 5e-9 - 1e-8, -1.00001]) == (pytest.approx(-1.00001002, abs=2e-8), pytest.approx(-0.33333667, abs=2e-8))
    assert of([1e12, 2.5]) == (1e12 + 2.5, (1e12 + 2.5) / 2)
    assert of([math.inf, 1.0])[0] == math.inf and math.isnan(of([math.nan, 1.0])[0])


def test_rollup_from_parts_equals_rollup_of_rows(spark):
    rows = spark.range(5_000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 11).alias("c"), (F.col("id") % 7).alias("n"),
        F.when(F.col("id") % 5 > 0, (F.pmod(F.xxhash64("id"), F.lit(10**7)) / 1e3)).alias("v"))
    measures = [total("s", "v"), avg("a", "v"), total("whole", "n"), distinct("d", "c")]
    direct = sorted(rollup(rows, ["k"], measures).collect())
    finer = partials(rows, ["k", "c", "n"], measures)
    assert sorted(combine(finer, ["k"], measures).collect()) == direct
    assert sorted(rollup(rows.repartition(50), ["k"], measures[:3]).collect()) == [r[:4] for r in direct]
    assert dict(rollup(rows, ["k"], measures).dtypes) == {"k": "bigint", "s": "double", "a": "double", "whole": "bigint", "d": "bigint"}


def test_gold_sums_as_whole_numbers(spark):
    """No double is added up in the plan of a gold table but those readings that do not fit."""
    empty = spark.createDataFrame([], TELEMETRY_SCHEMA)
    plan = gold.region_summary(empty)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(power_mw" not in plan and "avg(voltage_kv" not in plan


def test_scored_once_with_bounds_written(spark, tmp_path, frame, monkeypatch):
    from readings import reading
    from wattlake.operators import cleaning

    rows = cleaning.add_features(frame([reading(i, load_percent=float(30 + i % 41), power_mw=float(i % 13)) for i in range(400)]))
    calls = []
    score = isolation.score_rows
    monkeypatch.setattr(isolation, "score_rows", lambda *a: calls.append(1) or score(*a))
    params = isolation.ForestParams(trees=10, sample_size=32)
    found = ml.run_detection(spark, rows, str(tmp_path), params)
    assert len(calls) == 1 and "MapInArrow" not in found._jdf.queryExecution().toString()
    scored = spark.read.parquet(f"{tmp_path}/scored")
    assert ml.bounds(spark, str(tmp_path)).first() == isolation.score_bounds(scored).first()
    again = score(rows, isolation.load(spark, f"{tmp_path}/model")).select("event_id", "iso_score")
    assert sorted(again.collect()) == sorted(scored.select("event_id", "iso_score").collect())
