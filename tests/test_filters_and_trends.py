import math
from datetime import timedelta
from hashlib import md5

import pytest
from readings import START, reading
from pyspark.sql import functions as F

from wattlake.operators import cleaning, dashboard, filters, gold, service, trends
from wattlake.operators.filters import FilterSpec


@pytest.fixture(scope="module")
def grid(frame):
    regions = ["North", "South", "East"]
    return cleaning.add_features(frame([
        reading(i, timestamp=START + timedelta(hours=i), region=regions[i % 3], substation_id=f"SUB-{i % 20:03d}",
                transformer_id=f"TR-{i % 100:03d}", load_percent=30.0 + i % 60, risk_score=i % 101,
                status="Critical" if i % 101 >= 85 else "Warning" if i % 101 >= 50 else "Normal",
                anomaly_type="Overload" if i % 2 else "Temperature Spike")
        for i in range(1000)
    ])).cache()


def test_equality_and_empty_results(grid):
    assert filters.apply_service_filters(grid, FilterSpec(region="North")).count() == 334
    assert filters.apply_service_filters(grid, FilterSpec("North", "SUB-003", status="Critical")).count() > 0
    assert filters.apply_service_filters(grid, FilterSpec(region="NonExistentRegion")).count() == 0
    assert service.regions(grid, FilterSpec(region="NonExistentRegion", time_range="24h")).count() == 0


def test_time_range_is_anchored_after_the_other_filters(grid):
    spec = FilterSpec(region="South", time_range="24h")
    got = filters.apply_service_filters(grid, spec).agg(F.min("timestamp"), F.max("timestamp")).first()
    last = START + timedelta(hours=997)
    assert got[1] == last and got[0] == last - timedelta(hours=24)
    assert filters.apply_dashboard_filters(grid, FilterSpec()).count() == 25
    assert filters.apply_dashboard_filters(grid, FilterSpec(time_range="All Time")).count() == 1000


@pytest.mark.parametrize("name", ["high", "high_risk", "HIGH RISK"])
def test_high_risk_spellings(grid, name):
    got = filters.apply_service_filters(grid, FilterSpec(risk_level=name)).agg(F.min("risk_score"), F.max("risk_score"))
    assert tuple(got.first()) == (70, 84)


def test_unknown_level_filters_nothing(grid):
    assert filters.apply_service_filters(grid, FilterSpec(risk_level="odd")).count() == 1000


def test_options_cascade(grid):
    def options(spec, name):
        rows = filters.filter_options(grid, spec).filter(F.col("filter") == name).orderBy("position", "option")
        return [r["option"] for r in rows.collect()]

    assert options(FilterSpec(), "region") == ["All", "East", "North", "South"]
    narrowed = options(FilterSpec(substation_id="SUB-003"), "transformer_id")
    assert narrowed[0] == "All" and narrowed[1:] == sorted(narrowed[1:]) and len(narrowed) == 6


def test_consistency_messages(grid):
    def message(*spec):
        return tuple(filters.check_consistency(grid, FilterSpec(*spec)).first())

    assert message("North") == (True, "Filters are valid")
    assert message("West") == (False, "Region 'West' not found in data")
    assert message(None, "SUB-099") == (False, "Substation 'SUB-099' not found in selected region")
    assert message(None, None, "TR-999") == (False, "Transformer 'TR-999' not found in selected scope")
    empty = filters.check_consistency(grid.limit(0), FilterSpec("West")).first()
    assert tuple(empty) == (True, "No data to validate")


def _brute_order(rows):
    def key(r):
        return r["timestamp"], int(md5(r["event_id"].encode()).hexdigest()[:8], 16) >> 12, r["event_id"]

    return sorted(rows, key=key)


@pytest.mark.parametrize("spread", [1, 7, 1000])
def test_recent_split_against_brute_force(frame, spread):
    """Spread 1 puts every row on one timestamp, 7 leaves a hot one."""
    df = frame([reading(i, timestamp=START + timedelta(minutes=(i * 37) % spread)) for i in range(700)])
    marked = trends.mark_recent(df.repartition(5)).collect()
    ordered = _brute_order(marked)
    cut = int(700 * 0.8)
    assert [r["is_recent"] for r in ordered] == [False] * cut + [True] * (700 - cut)


def test_rows_without_a_timestamp_are_kept_and_recent(frame):
    rows = [reading(i) for i in range(10)] + [reading(i, timestamp=None) for i in range(10, 13)]
    marked = {r["event_id"][-2:]: r["is_recent"] for r in trends.mark_recent(frame(rows)).collect()}
    assert len(marked) == 13 and [k for k in sorted(marked) if marked[k]] == ["08", "09", "10", "11", "12"]
    assert trends.mark_recent(frame(rows[10:])).count() == 3


@pytest.mark.parametrize("n", [1, 123, 700, 5000])
def test_newest_against_brute_force(frame, n):
    df = frame([reading(i, timestamp=START + timedelta(minutes=(i * 37) % 11)) for i in range(700)])
    got = {r["event_id"] for r in trends.newest(df, n).collect()}
    assert got == {r["event_id"] for r in _brute_order(df.collect())[-n:]}


def test_trends_by_hand(grid):
    rows = _brute_order(grid.collect())
    early, late = rows[:800], rows[800:]
    got = trends.trends(grid).first()

    def mean(part):
        return sum(r["load_percent"] for r in part) / len(part)

    assert got["load_trend"] == round((mean(late) - mean(early)) / mean(early) * 100, 1)
    flags = [sum(r["anomaly_flag"] for r in part) for part in (late, early)]
    assert got["anomaly_trend"] == max(-50, round((flags[0] - flags[1]) / flags[1] * 100, 1))


def test_trends_are_zero_for_few_or_no_rows(grid):
    assert set(trends.trends(grid.limit(9)).first()) == {0.0}
    assert set(trends.trends(grid.limit(0)).first()) == {0.0}


def test_answers_for_no_rows(grid):
    nothing = FilterSpec(region="Atlantis")
    health = service.grid_health(grid, nothing).first()
    assert (health["health_score"], health["status"], health["overload_rate"]) == (50.0, "Unknown", 0.0)
    assert service.summary(grid, nothing).first()["records_today"] == 0
    assert tuple(service.energy_totals(grid, nothing).first()) == (0.0, 0.0)
    assert dashboard.system_status(grid.limit(0)).first()["system_status"] == "No Data Available"
    assert dashboard.kpi_metrics(grid.limit(0)).first()["total_faults"] == 0
    assert gold.critical_transformers(grid.limit(0)).count() == 0


def test_band_differs_between_rounded_and_unrounded_average(frame):
    """An average of 84.996 is Critical once rounded to 85.00 and High Risk as it is."""
    scores = [85] * 249 + [84]
    df = cleaning.add_features(frame([reading(i, risk_score=s) for i, s in enumerate(scores)]))
    assert gold.transformer_summary(df).first()["status"] == "Critical"
    assert service.transformers(df).first()["status"] == "High Risk"


def test_dominant_type_ties_and_absence(frame):
    rows = [reading(0, status="Warning", anomaly_type="Overload"), reading(1, status="Warning", anomaly_type="Generation Drop"),
            reading(2), reading(3, transformer_id="TR-2")]
    got = {r["transformer_id"]: r["dominant_anomaly_type"] for r in gold.transformer_summary(frame(rows)).collect()}
    assert got == {"TR-001001": "Generation Drop", "TR-2": "Normal"}


def test_worst_status_and_donut_leave_out_low(frame):
    rows = [reading(0, status="Low"), reading(1, transformer_id="TR-2", status="Warning"),
            reading(2, transformer_id="TR-2", status="High Risk"), reading(3, transformer_id="TR-3")]
    donut = dashboard.health_donut_by_transformer(frame(rows)).first()
    assert tuple(donut) == (1, 0, 1, 0, 2)
    assert tuple(dashboard.health_donut_by_record(frame(rows)).first()) == (2, 1, 1, 0, 4)


def test_single_row_groups_have_zero_deviation(frame):
    from wattlake.operators import health, risk

    df = cleaning.add_features(frame([reading(0)]))
    row = health.transformer_health(df).first()
    assert row["load_std"] == 0.0 and row["stability_score"] == 0.0 and row["reliability_score"] == 25.0
    assert risk.transformer_risk_summary(df).first()["risk_score_std"] == 0.0
    assert not math.isnan(row["health_score"])


def test_forecast_needs_six_hours_and_wraps(frame):
    from wattlake.operators import forecast

    def hourly(n, start=0):
        return cleaning.add_features(frame([
            reading(i, timestamp=START + timedelta(hours=start + i), load_percent=10.0 * i, energy_consumed_mwh=5.0 - i)
            for i in range(n)]))

    assert forecast.load_forecast(hourly(5)).count() == 0
    got = [r["forecast"] for r in forecast.load_forecast(hourly(8)).collect()]
    assert got == pytest.approx([80, 90, 100, 100, 100, 100])
    assert [r["forecast"] for r in forecast.consumption_forecast(hourly(8)).collect()] == pytest.approx([0] * 6, abs=1e-9)
    moving = forecast.moving_average_forecast(service.energy_by_hour(hourly(4, start=20))).collect()
    assert [r["hour_of_day"] for r in moving] == [0, 1, 2, 3, 4, 5]
    assert forecast.moving_average_forecast(service.energy_by_hour(hourly(2))).count() == 0
