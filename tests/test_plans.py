"""Plans that matter at scale, and results that do not depend on partitioning."""

import contextlib
import io

import pytest
from readings import SF

from catalog.base import silver
from wattlake.operators import filters, gold, sampling, service, trends
from wattlake.operators.filters import FilterSpec
from wattlake.plans import report


@pytest.fixture(scope="module")
def rows(spark):
    return silver(spark, SF)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_filters_and_columns_reach_the_scan(rows):
    text = plan(service.regions(rows, FilterSpec(region="ASIA", risk_level="critical")))
    assert "EqualTo(region,ASIA)" in text and "GreaterThanOrEqual(risk_score,85)" in text
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "current_amp" not in schema and "load_percent_zscore" not in schema


def test_time_range_prunes_days(rows):
    recent = filters.newest_within(rows, 24)
    recent.count()
    text = plan(recent)
    assert "event_date" in text[text.index("PartitionFilters"):].split("\n")[0]


def test_distinct_counts_do_not_expand_raw_rows(rows):
    text = plan(gold.region_summary(rows))
    tree = text[: text.index("(1) Scan")]
    assert tree.index("Expand") < tree.rindex("HashAggregate") < tree.index("Scan")
    between = tree[tree.index("Expand"):]
    assert between.count("Exchange") == 1


def test_transformer_summary_reads_once(rows):
    text = plan(gold.transformer_summary(rows))
    assert text[: text.index("(1) Scan")].count("Scan parquet") == 1


@pytest.mark.parametrize("make", [
    gold.transformer_summary, gold.region_summary, service.summary, trends.trends,
    lambda df: sampling.uniform_sample(df, 50).select("event_id"),
])
def test_same_result_on_one_and_many_partitions(rows, make):
    one, many = (sorted(map(repr, make(df).collect())) for df in (rows.coalesce(1), rows.repartition(8)))
    assert one == many


def test_written_gold_equals_the_single_plans(spark, rows, tmp_path):
    report.build_gold(rows, str(tmp_path), f"{tmp_path}/csv")
    for name, table in gold.gold_tables(rows).items():
        written = spark.read.parquet(f"{tmp_path}/{name}")
        assert written.columns == table.columns
        assert sorted(map(repr, written.collect())) == sorted(map(repr, table.collect())), name
        assert spark.read.option("header", True).csv(f"{tmp_path}/csv/{name}").count() == table.count()


def test_invariants(rows):
    assert rows.filter("risk_score < 0 OR risk_score > 100 OR anomaly_score < 0 OR anomaly_score > 1").count() == 0
    assert rows.filter("status NOT IN ('Normal', 'Low', 'Warning', 'High Risk', 'Critical')").count() == 0
    per_status = {r["status"]: r["avg_risk_score"] for r in gold.severity_summary(rows).collect()}
    assert per_status["Critical"] > per_status["High Risk"] > per_status["Warning"] > per_status["Low"]
    total = rows.count()
    assert sum(r["count"] for r in gold.severity_summary(rows).collect()) == total
    assert sum(r["record_count"] for r in gold.transformer_summary(rows).collect()) == total
    assert sum(r["record_count"] for r in gold.hourly_summary(rows).collect()) == total
