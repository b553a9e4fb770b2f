import numpy as np
import pytest
from readings import reading
from pyspark.sql import functions as F

from wattlake.operators import cleaning
from wattlake.operators.quantiles import exact_quantiles
from wattlake.plans.batch import build_silver
from wattlake.schema import SILVER_COLUMNS, TELEMETRY_SCHEMA


def test_dedup_keeps_the_first_and_cuts_hot_keys_before_the_shuffle(frame):
    rows = [reading(0, power_mw=float(i)) for i in range(300)] + [reading(i) for i in range(1, 50)]
    kept = cleaning.dedup(frame(rows).repartition(6))
    assert kept.count() == 50
    assert kept.filter("event_id = 'EVT-000000'").first()["power_mw"] == 0.0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Partial")
    report = cleaning.dedup_report(frame(rows)).first()
    assert tuple(report) == (349, 50, 299)


def test_impute_clip_and_features(frame):
    rows = [reading(0, voltage_kv=None, energy_consumed_mwh=0.0), reading(1, voltage_kv=60.0, energy_consumed_mwh=-2.0),
            reading(2, voltage_kv=30.0, power_factor=None, status=None, anomaly_type=None, fault_indicator=None),
            reading(3, voltage_kv=20.0, temperature_c=95.0)]
    df = frame(rows)
    medians = exact_quantiles(df, ["voltage_kv", "power_factor"])
    assert medians.first()["voltage_kv"] == 30.0
    done = cleaning.add_features(cleaning.clip_ranges(cleaning.fill_defaults(cleaning.impute_median(df))))
    got = {r["event_id"][-1]: r for r in done.collect()}
    assert [got[k]["voltage_kv"] for k in "0123"] == [30.0, 52.0, 30.0, 28.0]
    assert got["0"]["transmission_efficiency"] == 100.0 and got["1"]["transmission_efficiency"] == -500.0
    assert (got["2"]["status"], got["2"]["anomaly_type"], got["2"]["fault_indicator"]) == ("Normal", "Normal", 0)
    assert got["3"]["voltage_deviation_kv"] == -12.0 and got["3"]["voltage_stability_score"] == 40.0
    strict = cleaning.feature_expressions("strict")["transmission_efficiency"]
    assert {r[0] for r in df.select(strict).collect()} == {100.0, 125.0}
    report = {r["column_name"]: r["out_of_range"] for r in cleaning.clip_report(df).collect()}
    assert report["voltage_kv"] == 2 and report["temperature_c"] == 1


def test_clip_keeps_nulls(frame):
    assert cleaning.clip_ranges(frame([reading(0, voltage_kv=None)])).first()["voltage_kv"] is None


def test_zscore_is_null_without_spread(frame):
    row = cleaning.add_zscores(frame([reading(0), reading(1)])).first()
    assert row["load_percent_zscore"] is None
    rows = cleaning.add_zscores(frame([reading(0, load_percent=40.0), reading(1, load_percent=60.0)])).collect()
    assert sorted(r["load_percent_zscore"] for r in rows) == [-0.707, 0.707]


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 9, [0.0] * 1000 + [1e300, -1e300],
    list(np.random.default_rng(3).normal(size=2001).round(3)), list(np.random.default_rng(4).lognormal(8, 4, 3000)),
])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.88, 1.0])
def test_exact_quantiles(spark, values, fraction):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    got = exact_quantiles(df, ["x"], fraction).first()["x"]
    ordered = sorted(values)
    at = (len(values) - 1) * fraction
    low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
    assert got == low + (high - low) * (at - np.floor(at))


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert tuple(exact_quantiles(df, ["x", "y"]).first()) == (None, 2.0)


def test_lazy_and_written_silver_agree(spark, frame, tmp_path):
    rows = [reading(i, load_percent=float(i % 90), power_mw=i / 7, temperature_c=None if i % 9 == 0 else 40.0 + i % 40)
            for i in range(400)] + [reading(5)]
    df = frame(rows)
    written = build_silver(spark, df, f"{tmp_path}/stage", f"{tmp_path}/silver")
    assert set(SILVER_COLUMNS) <= set(written.columns)
    names = [c for c in SILVER_COLUMNS if c != "transformation_time"]
    lazy = cleaning.silver(df)
    assert written.count() == 400
    assert sorted(map(repr, written.select(names).collect())) == sorted(map(repr, lazy.select(names).collect()))
    days = [p.name for p in (tmp_path / "silver").iterdir() if p.name.startswith("event_date=")]
    assert days == ["event_date=2025-04-01"]


def test_empty_input(spark):
    empty = spark.createDataFrame([], TELEMETRY_SCHEMA)
    assert cleaning.silver(empty).count() == 0
    assert cleaning.dedup_report(empty).first()["records_kept"] == 0


def test_schema_report(frame):
    from wattlake.sources.raw import validate_schema

    df = frame([reading(0, voltage_kv=None), reading(1)]).drop("latitude").withColumn("feeder", F.lit(1))
    got = {r["column_name"]: (r["state"], r["filled"]) for r in validate_schema(df, TELEMETRY_SCHEMA).collect()}
    assert got["latitude"] == ("missing", None) and got["feeder"] == ("extra", 2) and got["voltage_kv"] == ("present", 1)


def test_timestamps_that_cannot_be_read_become_null(spark):
    from wattlake.sources.raw import parse_timestamp

    df = spark.createDataFrame([("2025-04-01 10:00:00",), ("2025-04-01T10:00:00.5",), ("soon",)], "timestamp string")
    got = [r[0] for r in parse_timestamp(df).collect()]
    assert got[0].hour == 10 and got[1].microsecond == 500000 and got[2] is None


def test_brackets_stay_small_on_skewed_values(spark):
    from wattlake.operators.quantiles import MOST, bracket_values, brackets

    n = 120_000
    df = spark.range(n).select(
        F.exp(F.randn(3) * 3).alias("lognormal"),
        F.when(F.col("id") == 7, 1e15).when(F.col("id") == 8, -1e300).otherwise(F.rand(4)).alias("outliers"),
        F.when(F.col("id") % 3 == 0, float("inf")).otherwise(F.rand(5)).alias("infinite"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.0).alias("two"),
        F.when(F.col("id") % 10 == 0, F.lit(None).cast("double")).when(F.col("id") % 10 == 1, float("nan")).otherwise(F.col("id") * 0.5).alias("gaps"),
    ).persist()
    names = df.columns
    for fraction in (0.5, 0.88, 0.0, 1.0):
        exact = df.select(*[F.expr(f"percentile(CASE WHEN NOT isnan({c}) THEN {c} END, {fraction})").alias(c) for c in names]).first()
        assert tuple(exact_quantiles(df, names, fraction).first()) == pytest.approx(tuple(exact), rel=1e-12)
        found = brackets(df, names, fraction)
        ranked = bracket_values(df, found).groupBy("name").count().collect()
        assert all(r["count"] <= MOST for r in ranked)
    df.unpersist()


def test_brackets_between_heavy_ends(spark):
    """Half zeros, half ones and few values between them: the last window sees few values, and the quantile is exact."""
    from pyspark.sql import functions as F

    from wattlake.operators.quantiles import bracket_values, brackets, exact_quantiles

    import numpy as np

    n = 40_000
    between = (F.col("id") - 19_900) / 1000.0
    shapes = {
        "middle": F.when(F.col("id") < 19_900, 0.0).when(F.col("id") >= 20_100, 1.0).otherwise(between),
        "low_end": F.when(F.col("id") < 20_000, 0.0).otherwise(1.0 + F.col("id") % 7),
        "high_end": F.when(F.col("id") < 19_999, F.col("id") % 5 - 9.0).otherwise(3.0),
        "steps": F.floor(F.col("id") / 400).cast("double"),
        "one": F.lit(2.5),
    }
    df = spark.range(n).select(*[c.alias(name) for name, c in shapes.items()]).repartition(4)
    found = brackets(df, list(shapes), 0.5, most=50)
    seen = {r["name"]: r["count"] for r in bracket_values(df, found).groupBy("name").count().collect()}
    assert all(k <= 50 for k in seen.values()), seen
    for fraction in (0.0, 0.25, 0.4975, 0.5, 0.9, 1.0):
        got = exact_quantiles(df, list(shapes), fraction).first()
        want = df.toPandas()
        for name in shapes:
            assert got[name] == float(np.quantile(want[name], fraction)), (name, fraction)
